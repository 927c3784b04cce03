"""Near-duplicate documents: many universal hash minima, banding, verification, components.

1. One pass over the texts gives each document the minima of 128 universal hash functions over its
   shingles, as 32 band keys (4 minima each), and 8 bits of each minimum for verification.
2. Documents with the same words are one class; only the representative (least id) goes on.
3. The least member of a bucket is its centre. All that share a bucket with a centre are its group,
   whatever the band, so two documents that share any bucket meet in a group. Of a group of two, the
   size bound and the signatures tell whether the texts have to be compared.
4. Groups are compared on the exact sets of whole texts, in blocks of bounded size (large groups: each
   block with each). No pairs are emitted: inverted lists of the blocks give the intersection sizes,
   and only the links of a spanning forest come out. Then components of these links.

At a similarity of 0.75 a pair shares no band with probability 5e-6, and falls below the estimate's
bound (0.55) with less than 1e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from shelfwise.llm.components import components
from shelfwise.llm.scratch import stored
from shelfwise.llm.words import blank_words, shingles

WORDS = 5
SIMILARITY = 75  # of 100
BANDS, ROWS = 32, 4
BOUND = 0.55
BLOCK = 4 << 20  # bytes of text of a block

SKETCH = "doc_id long, n_shingles long, words_hash binary, minima binary, bands array<long>"

_RANDOM = np.random.default_rng(20_240_229)
_A = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_MIX = _RANDOM.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """The least hash of each non-empty set under each function (multiply, add, take the high half)."""
    starts = np.cumsum([0, *map(len, sets[:-1])])
    values = np.concatenate(sets) >> np.uint64(32)
    out = np.empty((len(sets), len(_A)), np.uint32)
    for i, (a, b) in enumerate(zip(_A, _B, strict=True)):
        out[:, i] = np.minimum.reduceat(((values * a + b) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    parts = least.reshape(-1, BANDS, ROWS).astype(np.uint64) + np.uint64(1)
    keys = (parts * _MIX).sum(2, dtype=np.uint64)
    keys ^= keys >> np.uint64(29)
    return (keys * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def sketches(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: set size, hash of the word sequence, bits of the minima, band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            i = 0
            while i < len(ids):
                j, sets, hashed, size = i, [], [], 0
                while j < len(ids) and size < 40_000:
                    found = blank_words(texts[j].as_py())
                    sets.append(shingles(found, words))
                    hashed.append(xxhash.xxh3_128_digest(b" ".join(found)) if found else None)
                    size += len(found)
                    j += 1
                full = [s for s in sets if len(s)]
                least = minima(full) if full else np.empty((0, len(_A)), np.uint32)
                bits, keys = iter(least.astype(np.uint8)), iter(band_keys(least))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(i, j - i),
                        pa.array(list(map(len, sets)), pa.int64()),
                        pa.array(hashed, pa.binary()),
                        pa.array([next(bits).tobytes() if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "words_hash", "minima", "bands"],
                )
                i = j

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, SKETCH)


@F.pandas_udf(BooleanType())
def _alike(a: pd.Series, b: pd.Series) -> pd.Series:
    """Whether the minima agree often enough."""
    x, y = (np.frombuffer(b"".join(s), np.uint8).reshape(len(s), -1) for s in (a, b))
    return pd.Series((x == y).mean(1) >= BOUND)


def _forest(sets: list[np.ndarray], similarity: int) -> list[tuple[int, int]]:
    """Links that join the members whose sets are similar enough, by position; a spanning forest.

    The first member is compared with all, then each that is not yet joined to it. Intersection
    sizes with all members come from the members' inverted lists.
    """
    sizes = np.array(list(map(len, sets)))
    _, places, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owners = np.repeat(np.arange(len(sets)), sizes)[np.argsort(places, kind="stable")]
    ends = np.cumsum(counts)
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for x in range(len(sets)):
        if x and root(x) == root(0):
            continue
        mine = places[cuts[x] : cuts[x + 1]]
        taken = counts[mine]
        # Positions of all entries of the lists of x's shingles.
        at = np.arange(taken.sum()) + np.repeat(ends[mine] - np.cumsum(taken), taken)
        both = np.bincount(owners[at], minlength=len(sets))
        both[x] = 0
        for y in np.flatnonzero((both > 0) & (100 * both >= similarity * (sizes + sizes[x] - both))).tolist():
            if root(x) != root(y):
                parent[root(y)] = root(x)
                links.append((x, y))
    return links


def _compare(words: int, similarity: int):
    """Rows come sorted by group; a group is two blocks at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, sets, found = None, [], [], []
        for batch in batches:
            keys = zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)
            for (centre, i, j, doc_id), text in zip(keys, batch.column(4), strict=True):
                if (centre, i, j) != key:
                    found += [(ids[x], ids[y]) for x, y in _forest(sets, similarity)] if len(ids) > 1 else []
                    key, ids, sets = (centre, i, j), [], []
                ids.append(doc_id)
                sets.append(shingles(blank_words(text.as_py()), words))
            if found:
                yield _pairs(found)
                found = []
        if len(ids) > 1:
            yield _pairs([(ids[x], ids[y]) for x, y in _forest(sets, similarity)])

    return run


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    u, v = zip(*found, strict=True) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (u, v)], names=["u", "v"])


def _links(groups: DataFrame, texts: DataFrame, words: int, similarity: int) -> DataFrame:
    """Similar members of the same group (centre, doc_id), as links of a spanning forest."""
    sized = groups.join(texts.select("doc_id", F.length("text").alias("bytes")), "doc_id")
    blocks = sized.groupBy("centre").agg(F.ceil(F.sum("bytes") / BLOCK).alias("blocks"))
    b = F.pmod(F.xxhash64("doc_id"), F.col("blocks"))
    placed = (
        groups.join(blocks, "centre")
        .select("centre", "doc_id", b.alias("b"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("k"))
        .select("centre", F.least("b", "k").alias("i"), F.greatest("b", "k").alias("j"), "doc_id")
    )
    rows = placed.join(texts, "doc_id").select("centre", "i", "j", "doc_id", "text")
    ordered = rows.repartition("centre", "i", "j").sortWithinPartitions("centre", "i", "j", "doc_id")
    return ordered.mapInArrow(_compare(words, similarity), "u long, v long")


def near_duplicates(
    docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Texts that are null, empty or blank are linked with nothing. Rows without an id get no
    component, are linked with nothing and are kept. Rows that repeat an id are one node of the
    links, with the links of all their texts, and each comes back. Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    sketch = stored(sketches(rows, words), "sketches")
    worded = sketch.where("doc_id is not null and words_hash is not null")
    classes = stored(worded.groupBy("words_hash").agg(F.min("doc_id").alias("class_id")), "classes")
    reps = stored(
        worded.join(classes, (worded.doc_id == classes.class_id) & (worded.words_hash == classes.words_hash), "left_semi")
        .dropDuplicates(["doc_id", "words_hash"]), "representatives",
    )

    entries = reps.select("doc_id", F.explode("bands").alias("key"))
    buckets = entries.groupBy("key").agg(F.min("doc_id").alias("centre"), F.count("*").alias("n")).where("n > 1")
    star = entries.join(buckets, "key").where("doc_id <> centre").select("centre", "doc_id").distinct()
    star = stored(star, "stars")
    sizes = star.groupBy("centre").agg(F.count("*").alias("others"))
    ends = [
        reps.select(F.col("doc_id").alias(k), F.col("n_shingles").alias(f"n_{k}"), F.col("minima").alias(f"m_{k}"))
        for k in ("doc_id", "centre")
    ]
    single = (
        star.join(sizes.where("others = 1").select("centre"), "centre").join(ends[0], "doc_id").join(ends[1], "centre")
        .where(F.lit(100) * F.least("n_doc_id", "n_centre") >= F.lit(similarity) * F.greatest("n_doc_id", "n_centre"))
        .where(_alike("m_doc_id", "m_centre")).select("centre", "doc_id")
    )
    spokes = single.unionAll(star.join(sizes.where("others > 1").select("centre"), "centre").select("centre", "doc_id"))
    groups = spokes.unionAll(spokes.select("centre", F.col("centre").alias("doc_id")).distinct())
    groups = stored(groups, "groups")
    texts = rows.join(groups.select("doc_id").distinct(), "doc_id", "left_semi")
    texts = stored(texts, "group-texts")
    final = stored(components(_links(groups, texts, words, similarity)), "components")

    known = classes.join(final, classes.class_id == final.node, "left").select(
        "words_hash", F.coalesce("component", "class_id").alias("component_id")
    )
    out = sketch.join(known, "words_hash", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
