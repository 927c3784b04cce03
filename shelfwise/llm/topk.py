"""Exact top-k inner products by Fagin's threshold algorithm.

Vectors are cut into blocks; a block keeps, per dimension, its rows sorted by value. For a query the
lists are read from the end that its sign prefers, all to the same depth, and each row met is scored in
full. The sum of the products at the depth bounds every row not met yet; once it is below the k-th
score the block is done. The k-th score is carried from block to block of a task, so later blocks
stop sooner. Queries go to the blocks in groups, and the best k of all blocks are kept at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.scratch import stored
from shelfwise.llm.vectors import clamped

K = 5
SCALE = 256
EVERY = 50  # ids divisible by it are queries
BLOCK = 4096  # rows of a block
QUERIES = 1024  # queries that meet a block at once
DEPTH = 16

FOUND = "query_id long, vec_id long, score long"


def _matrix(vectors: list[list[int]], width: int) -> np.ndarray:
    """Rows padded with zeros. Doubles while all sums are exact in them, else Python's integers."""
    largest = max((abs(x) for v in vectors for x in v), default=0)
    out = np.zeros((len(vectors), width), float if width * largest**2 < 2**53 else object)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


class Lists:
    """Rows of a block, and per dimension their order by value."""

    def __init__(self, ids: list[int], rows: np.ndarray) -> None:
        by_id = np.argsort(np.array(ids, np.int64), kind="stable")
        self.ids, self.rows = np.array(ids, np.int64)[by_id], rows[by_id]
        self.order = np.argsort(self.rows, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.rows, self.order, 0)

    def top(self, query_id: int, q: np.ndarray, k: int, found: list[tuple]) -> list[tuple]:
        """The best ``k`` (score, -vec_id) of ``found`` and this block, best first."""
        n, dims = len(self.ids), np.flatnonzero(q != 0)
        met = np.zeros(n, bool)
        depth, done = min(DEPTH, n), 0
        while True:
            up = dims[q[dims] > 0]
            down = dims[q[dims] < 0]
            if not len(dims):
                depth = n
                new = np.arange(n)
            else:
                rows = np.concatenate([self.order[n - depth : n - done, up].ravel(), self.order[done:depth, down].ravel()])
                new = np.unique(rows[~met[rows]])
            met[new] = True
            if len(new):
                scores = self.rows[new] @ q
                if len(found) == k:
                    some = scores >= found[-1][0]
                    new, scores = new[some], scores[some]
                other = self.ids[new] != query_id
                pairs = [(int(s), -int(i)) for s, i in zip(clamped(scores[other]), self.ids[new][other], strict=True)]
                found = sorted(found + pairs, reverse=True)[:k]
            if depth >= n or met.all():
                return found
            bound = (self.sorted[n - depth, up] * q[up]).sum() + (self.sorted[depth - 1, down] * q[down]).sum()
            if len(found) == k and found[-1][0] > bound:
                return found
            done, depth = depth, min(n, depth * 4)


def _search(k: int):
    """Rows: a group of queries and a block of candidates, both packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = {}
        for batch in batches:
            for group, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                vectors = [x["v"] for x in group + block]
                matrix = _matrix(vectors, max(map(len, vectors), default=0))
                lists = Lists([x["id"] for x in block], matrix[len(group) :])
                for x, q in zip(group, matrix, strict=False):
                    best[x["id"]] = lists.top(x["id"], q, k, best.get(x["id"], []))
                if len(best) > 16 * QUERIES:
                    yield _found(best)
                    best = {}
        yield _found(best)

    return run


def _found(best: dict[int, list[tuple]]) -> pa.RecordBatch:
    rows = [(q, -i, s) for q, found in best.items() for s, i in found]
    columns = list(zip(*rows, strict=True)) or [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])


def top_k(
    vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best other rows of each row whose id is divisible by
    ``every``; ties go to the smaller id.

    Components are floor(scale * x). Rows without id or vector, or with a null, infinite or NaN
    component, take no part. Vectors of unequal length are compared as if padded with zeros. Rows
    that repeat an id and a vector are one candidate. Components and scores beyond LONG count as its limits. Fewer than ``k`` other rows give fewer rows.
    """
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("long"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.when(sound, whole).alias("v"))
    rows = stored(rows.where("id is not null and v is not null").distinct(), "vectors")
    blocks, _ = _packed(rows, BLOCK, "block")
    groups, n = _packed(rows.where(F.col("id") % every == 0), QUERIES, "queries")
    # Each block meets each group of queries by its number. A number may have no queries.
    spread = blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("pack"))
    pairs = groups.join(spread, "pack").select("queries", "block").repartition(F.xxhash64("block"), F.xxhash64("queries"))
    found = pairs.mapInArrow(_search(k), FOUND).distinct()
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _packed(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """Rows dealt by their ids' hash into packs of about ``size``, and the number of packs."""
    packs = max(1, -(-rows.count() // size))
    pack = F.pmod(F.xxhash64("id"), F.lit(packs)).cast("int")
    return rows.groupBy(pack.alias("pack")).agg(F.collect_list(F.struct("id", "v")).alias(name)), packs
