"""Stupid-backoff language-model scores of documents, with counts over all other documents.

1. Documents are dealt by hash into chunks of bounded size. A chunk sends each distinct n-gram of its
   documents once, with its count, to the hash partition of the n-gram: frequent n-grams cost one
   entry a chunk, not one a document, so none is a hot key.
2. Each hash partition sums its count table and joins it back to the chunks' n-grams: a chunk gets the
   counts of its n-grams in the other chunks, where there are any.
3. Each chunk scores the n-grams of its documents and sums them per document. A document's own
   n-grams are taken out of the counts, else every n-gram would be known and nothing backed off.

Score of a word: count(n-gram) / count(its context) for the longest n-gram that other documents hold,
times 0.4 for each shorter step; a word that no other document holds counts as half a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.words import blank_words, hashes, mix, runs

ORDER = 2
ALPHA = 0.4
UNKNOWN = 0.5
CHUNK = 8 << 20  # bytes of text of a chunk
PARTITION = 8 << 20  # bytes of text whose n-grams share a hash partition

GRAMS = "part long, chunk long, grams binary, counts binary"
COUNTS = "chunk long, part long, places binary, others binary"
SCORES = "doc_id long, n_words long, score double"


class Chunk:
    """N-grams of some documents: ``at[k]`` has the n-gram (by number) that ends at each word."""

    def __init__(self, texts: list[bytes | None], order: int, parts: int) -> None:
        words = [hashes(blank_words(t)) for t in texts]
        self.sizes = np.array(list(map(len, words)), np.int64)
        self.doc = np.repeat(np.arange(len(words)), self.sizes)
        start = np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.place = np.arange(len(self.doc)) - start
        flat = np.concatenate(words) if words else np.empty(0, np.uint64)
        grams = []
        for k in range(1, order + 1):
            ending = np.zeros(len(flat), np.uint64)
            ending[k - 1 :] = mix(runs(flat, k) + np.uint64(k))
            grams.append(np.where(self.place >= k - 1, ending, np.uint64(0)))
        every = np.stack(grams) if grams else np.empty((0, 0), np.uint64)
        self.known = every != 0
        distinct, number = np.unique(every[self.known], return_inverse=True)
        # Numbers follow the hash partition, then the hash.
        by_part = np.argsort(distinct % np.uint64(parts), kind="stable")
        self.grams = distinct[by_part]
        rank = np.empty(len(distinct), np.int64)
        rank[by_part] = np.arange(len(distinct))
        self.at = np.full(every.shape, -1, np.int64)
        self.at[self.known] = rank[number]
        self.counts = np.bincount(self.at[self.known], minlength=len(distinct))
        part = (self.grams % np.uint64(parts)).astype(np.int64)
        self.parts, self.starts = np.unique(part, return_index=True)

    def own(self, k: int) -> np.ndarray:
        """Per word, how often its document holds the n-gram of ``k`` words that ends there."""
        out, known = np.zeros(len(self.doc), np.int64), self.known[k]
        pairs = self.doc[known] * np.int64(len(self.grams) + 1) + self.at[k][known]
        _, number, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        out[known] = counts[number]
        return out


def _send(order: int, parts: int):
    def run(table: pa.Table) -> pa.Table:
        number = table.column("chunk")[0].as_py()
        chunk = Chunk([t.as_py() for t in table.column("text")], order, parts)
        cuts = [*chunk.starts.tolist(), len(chunk.grams)]
        rows = [
            (p, number, chunk.grams[a:b].tobytes(), chunk.counts[a:b].astype("<u4").tobytes())
            for p, a, b in zip(chunk.parts.tolist(), cuts, cuts[1:], strict=False)
        ]
        return _table(rows, GRAMS)

    return run


def _pack(counts: np.ndarray) -> bytes:
    """A byte for each positive count; those from 255 on follow in eight bytes."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype("<i8").tobytes()


def _unpack(data: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(data, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<i8", offset=n)
    return counts


def _count(table: pa.Table) -> pa.Table:
    """One hash partition's count table, joined back to the chunks."""
    part = table.column("part")[0].as_py()
    sent = [np.frombuffer(g.as_py(), "<u8") for g in table.column("grams")]
    counts = [np.frombuffer(c.as_py(), "<u4").astype(np.int64) for c in table.column("counts")]
    _, number = np.unique(np.concatenate(sent), return_inverse=True)
    totals = np.bincount(number, weights=np.concatenate(counts)).astype(np.int64)
    rows, at = [], 0
    for chunk, own in zip(table.column("chunk").to_pylist(), counts, strict=True):
        others = totals[number[at : at + len(own)]] - own
        at += len(own)
        rows.append((chunk, part, np.packbits(others > 0).tobytes(), _pack(others[others > 0])))
    return _table(rows, COUNTS)


def _score(order: int, parts: int, alpha: float, tokens: int):
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        chunk = Chunk([t.as_py() for t in docs.column("text")], order, parts)
        totals = chunk.counts.copy()
        starts = dict(zip(chunk.parts.tolist(), chunk.starts.tolist(), strict=True))
        for part, places, others in zip(*(found.column(c).to_pylist() for c in ("part", "places", "others")), strict=True):
            at = np.flatnonzero(np.unpackbits(np.frombuffer(places, np.uint8)))
            totals[starts[part] + at] += _unpack(others, len(at))
        left = []
        for k in range(order):
            left.append(np.where(chunk.known[k], totals[chunk.at[k]] - chunk.own(k), 0) if len(totals) else np.zeros(0))
        rest = np.maximum(tokens - chunk.sizes, 1)[chunk.doc]
        score = np.log(np.maximum(left[0], UNKNOWN) / rest)
        for k in range(1, order):
            # The context ends one word earlier and is counted without regard to the word after it.
            context = np.concatenate([[1], left[k - 1][:-1]]) if len(score) else score
            seen = left[k] > 0
            longer = np.log(np.maximum(left[k], 1) / np.maximum(context, 1))
            score = np.where(chunk.known[k], np.where(seen, longer, np.log(alpha) + score), score)
        sums = np.bincount(chunk.doc, weights=score, minlength=len(chunk.sizes))
        return pa.table(
            {"doc_id": docs.column("doc_id"), "n_words": pa.array(chunk.sizes), "score": pa.array(sums[: len(chunk.sizes)], pa.float64())}
        )

    return run


def _table(rows: list[tuple], schema: str) -> pa.Table:
    fields = [c.split() for c in schema.split(", ")]
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    columns = list(zip(*rows, strict=True)) or [[]] * len(fields)
    return pa.table({n: pa.array(c, kinds[t]) for (n, t), c in zip(fields, columns, strict=True)})


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t.as_py() for t in batch.column(0)]
        words, size = sum(len(blank_words(t)) for t in texts), sum(len(t or b"") for t in texts)
        yield pa.RecordBatch.from_pydict({"words": [words], "bytes": [size]})


def scores(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, score (sum of the natural logarithms), mean_score for every row.

    Words stand between ASCII white space, A-Z lower-cased. Null and empty texts have no words, the
    score 0 and no mean. Rows without an id, or that repeat one, are documents of their own. An
    empty table gives no rows.
    """
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col).cast("string").cast("binary")
    rows = docs.select(doc_id.alias("doc_id"), text.alias("text"))
    total = rows.select("text").mapInArrow(_sizes, "words long, bytes long").agg(F.sum("words"), F.sum("bytes")).first()
    tokens, size = total[0] or 0, total[1] or 0
    chunks, parts = 1 + size // CHUNK, 1 + size // PARTITION
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks))).repartition(chunks, "chunk")
    grams = dealt.groupBy("chunk").applyInArrow(_send(order, parts), GRAMS)
    counts = grams.repartition(parts, "part").groupBy("part").applyInArrow(_count, COUNTS)
    found = counts.repartition(chunks, "chunk")
    scored = dealt.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(_score(order, parts, alpha, tokens), SCORES)
    return scored.withColumn("mean_score", F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words")))
