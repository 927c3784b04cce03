"""Exact hard negatives through rotated one-bit codes.

A row's vector is turned by a random rotation and reduced to the signs of its components, one bit
each. Stored beside the code are the vector's alignment with its code (their inner product) and the
length of the residual that is orthogonal to the code. For an anchor, whose rotated components are
rounded to bytes, popcounts over its bit planes give the inner product with the code; times the
alignment, that estimates the score. What the residual can add is bounded by the Cauchy-Schwarz
inequality, so each score lies in a known interval. Only rows whose interval can still matter are
scored in integers: the result is exact, whatever the rotation is.

Rows lie in blocks and anchors in packs, both dealt by hash. Positives are searched where label
buckets agree; then every pack meets every block for the negatives. A task keeps a pack while blocks
pass by, carries what it has found from block to block, and the few best of all tasks are kept at the
end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from shelfwise.llm.scratch import stored
from shelfwise.llm.vectors import clamped, largest, matrix, sound, whole_numbers

SCALE = 256
EVERY = 50  # ids divisible by it are anchors
POSITIVES = 5
NEGATIVES = 3
LEAST, MOST = 50, 95  # a negative's score as percentage of the positive's
BLOCK = 4096  # rows of a block, anchors of a pack
BYTES = 32 << 20  # of the components of a block, if vectors are long
CHUNK = 256  # anchors whose intervals with a block are held at once
SEED = 12
PLANES = 8  # bits of an anchor's rounded components
LONG = 2.0**63

_ARRAYS = ("ids", "labels", "v", "codes", "align", "residual")


@cache
def rotation(width: int) -> np.ndarray:
    """A random rotation; results don't depend on which, only the lengths of the intervals do."""
    q, _ = np.linalg.qr(np.random.default_rng(SEED).standard_normal((width, width)))
    return q


def _codes(signs: np.ndarray) -> np.ndarray:
    """Rows of booleans as 64-bit words."""
    packed = np.packbits(signs, axis=1, bitorder="little")
    padded = np.zeros((len(signs), -(-max(1, packed.shape[1]) // 8) * 8), np.uint8)
    padded[:, : packed.shape[1]] = packed
    return padded.view(np.uint64)


class Rows:
    """A block of rows: whole numbers, one-bit codes, alignments and residuals."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray) -> None:
        self.ids, self.labels, self.v = ids, labels, v
        turned = v.astype(float) @ rotation(v.shape[1])
        self.codes = _codes(turned > 0)
        self.align = np.abs(turned).sum(1) / np.sqrt(v.shape[1])
        self.residual = np.sqrt(np.maximum((turned**2).sum(1) - self.align**2, 0))

    def pack(self) -> dict:
        size = largest(self.v)
        kind = next((k for k in ("<i2", "<i4") if size < 2 ** (8 * int(k[2]) - 1)), "<i8")
        arrays = {"ids": self.ids, "labels": self.labels, "codes": self.codes, "align": self.align, "residual": self.residual}
        return {"width": self.v.shape[1], "kind": kind, "v": self.v.astype(kind).tobytes()} | {n: a.tobytes() for n, a in arrays.items()}

    @classmethod
    def unpack(cls, row: dict) -> Rows:
        self, width = cls.__new__(cls), row["width"]
        self.ids, self.labels = (np.frombuffer(row[n], np.int64) for n in ("ids", "labels"))
        v = np.frombuffer(row["v"], row["kind"]).reshape(len(self.ids), width)
        # Doubles as long as all scores are exact in them, else Python's integers.
        self.size = largest(v)
        self.v = v.astype(float if width * self.size**2 < 2**53 else object)
        self.codes = np.frombuffer(row["codes"], np.uint64).reshape(len(self.ids), -1)
        self.align, self.residual = (np.frombuffer(row[n], float) for n in ("align", "residual"))
        return self


def intervals(anchors: np.ndarray, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the score of each anchor with each row."""
    width = anchors.shape[1]
    turned = anchors.astype(float) @ rotation(width)
    low = turned.min(1, keepdims=True)
    step = np.maximum((turned.max(1, keepdims=True) - low) / (2**PLANES - 1), np.finfo(float).tiny)
    rounded = np.clip(np.rint((turned - low) / step), 0, 2**PLANES - 1).astype(np.uint8)
    # sum(u * b) over bits b = +-1 is twice the sum over the set bits less the sum over all.
    agree = np.zeros((len(turned), len(rows.ids)), np.int64)
    for plane in range(PLANES):
        words = _codes((rounded >> plane) & 1 > 0)
        for w in range(words.shape[1]):
            agree += np.bitwise_count(words[:, w, None] & rows.codes[None, :, w]).astype(np.int64) << plane
    ones = np.bitwise_count(rows.codes).sum(1, dtype=np.int64)
    signed = low * (2 * ones - width)[None] + step * (2 * agree - rounded.sum(1, dtype=np.int64)[:, None])
    root = np.sqrt(width)
    estimate = signed / root
    off = np.abs(turned - (low + step * rounded)).sum(1, keepdims=True) / root
    square = (turned**2).sum(1, keepdims=True)
    rest = np.sqrt(np.maximum(square - np.maximum(np.abs(estimate) - off, 0) ** 2, 0))
    middle = rows.align[None] * estimate
    # The last term is for rounding in doubles.
    length = np.sqrt(square) * np.sqrt(rows.align**2 + rows.residual**2)[None]
    reach = rows.align[None] * off + rest * rows.residual[None] + 1e-9 * length + 1e-6
    return np.clip(middle - reach, -LONG, LONG), np.clip(middle + reach, -LONG, LONG)


def _scores(rows: Rows, chosen: np.ndarray, anchors: Rows, i: int) -> np.ndarray:
    if rows.v.dtype != object and anchors.v.dtype != object and rows.v.shape[1] * anchors.size * rows.size < 2**53:
        return (rows.v[chosen] @ anchors.v[i]).astype(np.int64)
    anchor = [int(x) for x in anchors.v[i]]
    return clamped(np.array([sum(a * int(x) for a, x in zip(anchor, r, strict=True)) for r in rows.v[chosen]], object))


def _kth(values: np.ndarray, k: int) -> float:
    """The k-th largest value; none below it is among the k best."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


Found = list[tuple[int, int]]  # (score, -id), best first


def _merged(found: Found, scores: np.ndarray, ids: np.ndarray, k: int) -> Found:
    if len(scores) > k:
        some = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, ids = scores[some], ids[some]
    return sorted(found + [(int(s), -int(i)) for s, i in zip(scores, ids, strict=True)], reverse=True)[:k]


def _likely(able: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` rows with the highest estimates. Their scores are known first, as a bar for all others."""
    rows = np.flatnonzero(able)
    if len(rows) <= k:
        return rows
    return rows[np.argpartition((low + high)[rows], len(rows) - k)[len(rows) - k :]]


def positives_of(i: int, anchors: Rows, rows: Rows, low: np.ndarray, high: np.ndarray, found: Found, k: int) -> tuple[Found, int]:
    """The ``k`` best rows of the anchor's label, and how many were scored."""
    able = (rows.labels == anchors.labels[i]) & (rows.ids != anchors.ids[i])
    likely = _scores(rows, _likely(able, low, high, k), anchors, i)
    bar = _kth(np.concatenate([likely, [s for s, _ in found]]), k)
    chosen = np.flatnonzero(able & (high >= bar))
    return _merged(found, _scores(rows, chosen, anchors, i), rows.ids[chosen], k), len(chosen)


def _within(scores: np.ndarray, p: int, least: int, most: int) -> np.ndarray:
    wide = scores.astype(object) if largest(scores) >= 2**55 else scores
    return ((100 * wide >= least * p) & (100 * wide <= most * p)).astype(bool)


def negatives_of(
    i: int, anchors: Rows, rows: Rows, low: np.ndarray, high: np.ndarray, scores: list[int], found: list[Found], k: int, least: int, most: int,
) -> tuple[list[Found], int]:
    """Per positive score, the ``k`` best rows of other labels between ``least`` and ``most`` percent of it."""
    able = rows.labels != anchors.labels[i]
    wanted = np.zeros(len(able), bool)
    for p, best in zip(scores, found, strict=True):
        bottom, top, slack = least * p / 100, most * p / 100, 1e-9 * abs(p)
        middle = (low + high) / 2
        likely = _scores(rows, _likely(able & (middle >= bottom) & (middle <= top), low, high, 2 * k), anchors, i)
        known = likely[_within(likely, p, least, most)]
        bar = max(_kth(np.concatenate([known, [s for s, _ in best]]), k), bottom - slack)
        wanted |= able & (high >= bar) & (low <= top + slack)
    chosen = np.flatnonzero(wanted)
    exact, ids, out = _scores(rows, chosen, anchors, i), rows.ids[chosen], []
    for p, best in zip(scores, found, strict=True):
        fits = _within(exact, p, least, most)
        out.append(_merged(best, exact[fits], ids[fits], k))
    return out, len(chosen)


# --- tasks


def _schema(groups: list[str], anchors: bool) -> pa.Schema:
    fields = [("width", pa.int32()), ("kind", pa.string()), *((n, pa.binary()) for n in _ARRAYS), *((g, pa.int64()) for g in groups)]
    return pa.schema(fields + [("key", pa.list_(pa.int64())), ("positives", pa.list_(pa.list_(pa.int64())))][: 2 * anchors])


def _build(groups: list[str], width: int, anchors: bool):
    """A group of rows (id, label, v; of anchors also key and positives) as one packed row."""

    def run(table: pa.Table) -> pa.Table:
        rows = Rows(table["id"].to_numpy(), table["label"].to_numpy(), matrix(table["v"].combine_chunks(), width))
        more = {n: table[n].to_pylist() for n in ("key", "positives")} if anchors else {}
        out = rows.pack() | {g: table[g][0].as_py() for g in groups} | more
        return pa.Table.from_pylist([out], schema=_schema(groups, anchors))

    return run


class Pack(NamedTuple):
    keys: list[int]
    positives: list[list[int]]
    rows: Rows


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Pack, bool, Rows]]:
    """Packs of anchors with each block that they meet, and whether a pack is a new one."""
    last, pack = None, None
    for batch in batches:
        packs, blocks = batch.column(0), batch.column(1)
        names = list(zip(packs.field("g0").to_pylist(), packs.field("g1").to_pylist(), strict=True))
        for i, name in enumerate(names):
            if new := name != last:
                row = packs[i].as_py()
                last, pack = name, Pack(row["key"], row["positives"], Rows.unpack(row))
            yield pack, new, Rows.unpack(blocks[i].as_py())


def _chunks(anchors: Rows, rows: Rows) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for at in range(0, len(anchors.ids), CHUNK):
        low, high = intervals(anchors.v[at : at + CHUNK], rows)
        yield from zip(range(at, at + len(low)), low, high, strict=True)


def _search(find: Callable[[int, Pack, Rows, np.ndarray, np.ndarray, list[Found]], list[Found]]):
    """The best of each anchor and place in the blocks of a task."""

    def rows_of(pack: Pack, best: list[list[Found]]) -> pa.RecordBatch:
        rows = [(key, j, -i, s) for key, each in zip(pack.keys, best, strict=True) for j, found in enumerate(each) for s, i in found]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        names = ["anchor", "place", "other", "score"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, best = None, []
        for pack, new, rows in _meetings(batches):
            if new:
                if held:
                    yield rows_of(held, best)
                held, best = pack, [[[] for _ in p] for p in pack.positives]
            for i, low, high in _chunks(pack.rows, rows):
                best[i] = find(i, pack, rows, low, high, best[i])
        if held:
            yield rows_of(held, best)

    return run


FOUND = "anchor long, place int, other long, score long"


def _find_positives(k: int):
    return _search(lambda i, pack, rows, low, high, best: [positives_of(i, pack.rows, rows, low, high, best[0], k)[0]])


def _find_negatives(k: int, least: int, most: int):
    return _search(
        lambda i, pack, rows, low, high, best: negatives_of(i, pack.rows, rows, low, high, pack.positives[i], best, k, least, most)[0]
    )


# --- plans


def _packed(rows: DataFrame, groups: dict[str, Column], width: int, anchors: bool = False) -> DataFrame:
    """Rows in one packed row for each combination of the numbers ``groups``."""
    schema = _schema(list(groups), anchors)
    named = rows.withColumns({g: c.cast("long") for g, c in groups.items()})
    return named.groupBy(*groups).applyInArrow(_build(list(groups), width, anchors), from_arrow_schema(schema))


def _met(packs: DataFrame, blocks: DataFrame, n_packs: int, n_blocks: int) -> DataFrame:
    """Rows of pack and block. ``blocks`` come once for each pack (g0, g1) that they meet. If there are few packs, the blocks
    of each are dealt to several tasks."""
    tasks = 2 * packs.sparkSession.sparkContext.defaultParallelism
    slices = max(1, min(n_blocks, -(-tasks // n_packs)))
    n = max(1, min(n_packs * slices, 10_000))
    block = F.struct("width", "kind", *_ARRAYS).alias("block")
    right = blocks.select("g0", "g1", F.pmod(F.xxhash64("bucket", "part"), F.lit(slices)).alias("slice"), block)
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("slice")
    left = packs.select("g0", "g1", copies, F.struct("*").alias("pack"))
    on = ["g0", "g1", "slice"]
    joined = left.repartition(n, *on).join(right.repartition(n, *on), on)
    return joined.sortWithinPartitions("g0", "g1").select("pack", "block")


def mined(
    vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST,
    every: int = EVERY, scale: int = SCALE, block: int = BLOCK,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``. A score is the inner product of the
    components floor(scale * x); higher scores come first, ties by the smaller id. An anchor's positives
    are the best ``positives`` rows of its label and another id. For each, the best ``negatives``
    rows of other labels with ``least`` to ``most`` percent of the positive's score are returned.

    Labels are whole numbers. Rows without id or label, and those without a vector or with a null,
    infinite or NaN component take no part. Shorter vectors count as padded with zeros. Rows that repeat
    id, label and vector are one row; rows that only share an id are rows of their own, and no positives of
    each other. Components and scores beyond LONG count as its limits. Fewer rows than asked for give
    fewer; an empty table gives none.
    """
    x = F.col(vector_col)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        whole_numbers(x, scale).alias("v"), sound(x).alias("ok"),
    )
    rows = rows.where("id is not null and label is not null and ok").drop("ok").distinct()
    rows = stored(rows.withColumn("key", F.monotonically_increasing_id()), "mined_vectors")
    width, count = rows.agg(F.max(F.size("v")), F.count("*")).first()
    width = max(1, width or 0)
    size = max(1, min(block, BYTES // (8 * width)))
    is_anchor = F.col("id") % every == 0

    # Labels share buckets of about a block; large buckets are split by hash. A block meets all packs of its bucket.
    bucket = F.pmod(F.xxhash64("label"), F.lit(max(1, -(-count // size))))
    rows_of = rows.withColumn("bucket", bucket).groupBy("bucket")
    parts = stored(
        rows_of.agg(F.ceil(F.count("*") / size).alias("parts"), F.ceil(F.count_if(is_anchor) / size).alias("packs")), "label_buckets"
    )
    n_blocks, n_packs = parts.agg(F.coalesce(F.sum("parts"), F.lit(0)), F.coalesce(F.sum("packs"), F.lit(0))).first()
    if not n_packs:
        return _result(rows.limit(0), "key", "key", "key", "key", "key", "key")
    named = rows.withColumn("bucket", bucket).join(parts, "bucket")

    def dealt(n: str) -> Column:
        return F.pmod(F.xxhash64("key"), F.col(n))

    groups = {"bucket": F.col("bucket"), "part": dealt("parts"), "packs": F.col("packs")}
    blocks = stored(_packed(named.select("id", "label", "v", "key", "bucket", "parts", "packs"), groups, width), "mined_blocks")
    single = named.where(is_anchor).withColumn("positives", F.array(F.lit(0).cast("long")))
    packs = _packed(single, {"g0": F.col("bucket"), "g1": dealt("packs")}, width, anchors=True)
    own = blocks.withColumn("g0", F.col("bucket"))
    own = own.where("packs > 0").withColumn("g1", F.explode(F.sequence(F.lit(0).cast("long"), F.col("packs") - 1)))
    found = _met(packs, own, n_packs, n_blocks).mapInArrow(_find_positives(positives), FOUND)
    best = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "other")
    ranked = found.withColumn("place", F.row_number().over(best) - 1).where(F.col("place") < positives)
    chosen = stored(ranked.select("anchor", "place", F.col("other").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    scores = chosen.groupBy(F.col("anchor").alias("key")).agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("p"))
    asked = rows.where(is_anchor).join(scores, "key").withColumn("positives", F.transform("p", lambda p: p["positive_score"])).drop("p")
    asked = stored(asked, "mined_anchors")
    n_packs = max(1, -(-asked.count() // size))
    numbered = {"g0": F.lit(0), "g1": F.pmod(F.xxhash64("key"), F.lit(n_packs))}
    every_pack = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_packs - 1).cast("long")))
    far = blocks.withColumn("g0", F.lit(0).cast("long")).withColumn("g1", every_pack)
    found = _met(_packed(asked, numbered, width, anchors=True), far, n_packs, n_blocks)
    found = found.mapInArrow(_find_negatives(negatives, least, most), FOUND)
    best = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), "other")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    ids = asked.select(F.col("key").alias("anchor"), F.col("id").alias("anchor_id"))
    joined = ranked.join(chosen, ["anchor", "place"]).join(ids, "anchor")
    return _result(joined, "anchor_id", "positive_id", "rank", "other", "positive_score", "score")


def _result(found: DataFrame, *columns: str) -> DataFrame:
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    kinds = {"rank": "int"}
    return found.select([F.col(c).cast(kinds.get(n, "long")).alias(n) for c, n in zip(columns, names, strict=True)])
