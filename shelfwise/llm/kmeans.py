"""Centroid clustering of integer vectors with scalar lookup tables.

Components are small integers that repeat, so a round does not subtract vectors. For a batch of
vectors it tabulates, per dimension, the squared difference of each integer value that occurs there
to each centroid; distances are gathers from these tables and their sums, exact in integers. A task
adds up the components per cluster before anything is shuffled, and the driver gets one sum per
cluster and dimension, which is the size of the model. Rounds read the stored vectors again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.scratch import stored
from shelfwise.llm.vectors import clamped, largest, matrix, sound, whole_numbers

CLUSTERS = 40
ROUNDS = 5
DIMENSIONS = 64
SCALE = 256
SEED = 2
ROWS = 2048  # rows whose tables are built at once
NARROW = 1 << 27  # squares of differences below twice this still add up in 64 bits

Centroids = list[list[int]]


def _values(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values that occur, in order, and each row's place among them."""
    low, high = int(column.min()), int(column.max())
    if column.dtype == object or high - low > 4 * len(column) + 1024:
        return np.unique(column, return_inverse=True)
    shifted = column - low
    seen = np.zeros(high - low + 1, bool)
    seen[shifted] = True
    return np.flatnonzero(seen) + low, (np.cumsum(seen) - 1)[shifted]


def distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distance of each row to each centroid, from one table per dimension."""
    out = np.zeros((len(rows), len(centroids)), rows.dtype)
    for d in range(rows.shape[1] if len(rows) else 0):
        values, place = _values(rows[:, d])
        table = values.astype(rows.dtype)[:, None] - centroids[None, :, d]
        out += (table * table)[place]
    return out


def nearest(rows: np.ndarray, centroids: Centroids) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid, the smaller one of ties, and the squared distance to it."""
    if largest(rows) >= NARROW or any(abs(x) >= NARROW for c in centroids for x in c):
        rows, model = rows.astype(object), np.array(centroids, object)
    else:
        model = np.array(centroids, np.int64)
    numbers, least = [], []
    for at in range(0, len(rows), ROWS):
        found = distances(rows[at : at + ROWS], model)
        best = found.argmin(1)
        numbers.append(best)
        least.append(found[np.arange(len(best)), best])
    return np.concatenate([np.empty(0, np.int64), *numbers]), np.concatenate([rows[:0, 0], *least])


def _sums(centroids: Centroids, width: int):
    """(cluster, dimension, sum) and, as dimension -1, (cluster, -1, number of rows) of a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centroids), width + 1), object)
        for batch in batches:
            rows = matrix(batch.column(0), width)
            cluster, _ = nearest(rows, centroids)
            by_cluster = np.argsort(cluster, kind="stable")
            numbers, starts = np.unique(cluster[by_cluster], return_index=True)
            # Sums of a batch's LONGs may need more than 64 bits.
            ordered = rows[by_cluster].astype(object if largest(rows) >= 1 << 45 else np.int64)
            if len(rows):
                total[numbers, :width] += np.add.reduceat(ordered, starts, axis=0).astype(object)
                total[numbers, width] += np.diff([*starts, len(rows)]).astype(object)
        used = np.flatnonzero(total[:, width])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, width + 1), pa.int32()),
                pa.array(np.tile([*range(width), -1], len(used)), pa.int32()),
                pa.array([Decimal(int(x)) for x in total[used].ravel()], pa.decimal128(38, 0)),
            ],
            names=["cluster", "dimension", "total"],
        )

    return run


def _assigned(centroids: Centroids, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = nearest(matrix(batch.column(1), width), centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster, pa.int32()), pa.array(clamped(distance), pa.int64())],
                names=["vec_id", "cluster", "distance"],
            )

    return run


def first_centroids(rows: DataFrame, clusters: int, seed: int) -> Centroids:
    """The vectors whose ``seed:id`` has the least SHA-256, in that order; as many rows as the model has."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [r["v"] for r in rows.where("vec_id is not null").orderBy(name, "v").limit(clusters).collect()]


def fit(rows: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, width: int = DIMENSIONS, seed: int = SEED) -> Centroids:
    """Centroids after ``rounds``; each round replaces those that have vectors by the exact floor of
    their mean. ``rows`` (vec_id, v) should be a stored table."""
    centroids = first_centroids(rows, clusters, seed)
    for _ in range(rounds if centroids else 0):
        found = rows.select("v").mapInArrow(_sums(centroids, width), "cluster int, dimension int, total decimal(38,0)")
        sums = {(r[0], r[1]): int(r[2]) for r in found.groupBy("cluster", "dimension").agg(F.sum("total")).collect()}
        centroids = [
            [sums[i, d] // sums[i, -1] for d in range(width)] if (i, -1) in sums else c for i, c in enumerate(centroids)
        ]
    return centroids


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, width: int = DIMENSIONS, scale: int = SCALE,
    seed: int = SEED, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: one row per vector.

    Components are floor(scale * x). Vectors with another number of components than ``width``, or
    with a null, infinite or NaN one, are left out. Rows that repeat an id or a vector are rows of
    their own. A row without an id is assigned, but is no first centroid. Fewer vectors than
    ``clusters`` give as many centroids as there are; an empty table, or one without ids, no rows. Components
    and distances beyond LONG count as its limits.
    """
    x = F.col(vector_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), whole_numbers(x, scale).alias("v"), sound(x).alias("ok"))
    rows = stored(rows.where(F.col("ok") & (F.size("v") == width)).select("vec_id", "v"), "cluster_vectors")
    centroids = fit(rows, clusters, rounds, width, seed)
    if not centroids:
        rows = rows.limit(0)
    found = stored(rows.mapInArrow(_assigned(centroids, width), "vec_id long, cluster int, distance long"), "clusters")
    limit = 2**63 - 1
    inertia = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    total = sum(int(r.total) for r in inertia)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    # One row per centroid, so Spark sees its size.
    model = vectors.sparkSession.createDataFrame(
        [(r.cluster, min(int(r.total), limit), min(total, limit), names[r.cluster]) for r in inertia],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return found.join(model, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
