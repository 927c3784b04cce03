"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.sinks.staging import stage


def number_members(members: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """Give distinct members the keys 1..n in the order of ``order_by``.

    The same members always get the same keys. They are split into ranges and written
    once, so that the slice a row belongs to is settled; then the slices are numbered
    side by side, each starting after the rows of the slices before it.
    """
    return _numbered(members, key, order_by, order_by)


def _numbered(rows: DataFrame, key: str, order_by: Sequence[str], deal_by: Sequence[str]) -> DataFrame:
    ordering = [F.asc_nulls_first(c) for c in order_by]
    ranged = rows.repartitionByRange(*[F.asc_nulls_first(c) for c in deal_by])
    sliced = stage(ranged.withColumn("_slice", F.spark_partition_id()), f"{key}_slices")
    # One row per slice.
    starts = (
        sliced.groupBy("_slice")
        .agg(F.count("*").alias("_rows"))
        .select(
            "_slice",
            (F.sum("_rows").over(Window.orderBy("_slice")) - F.col("_rows")).alias("_before"),
        )
    )
    in_slice = F.row_number().over(Window.partitionBy("_slice").orderBy(*ordering))
    return sliced.join(starts, "_slice").select(
        (F.col("_before") + in_slice).alias(key), *rows.columns
    )


def keep_keys(
    members: DataFrame, known: DataFrame | None, key: str, natural: Sequence[str]
) -> DataFrame:
    """Keys for distinct members, of which those in ``known`` (key and natural columns) keep theirs.

    Others are numbered from the largest known key on, in the order of the natural key. Members
    that only ``known`` has stay, too, as earlier facts may refer to them. Without ``known`` all
    are numbered from 1.
    """
    if known is None:
        return number_members(members, key, natural)
    old = known.select(key, *natural)
    other = old.select(*[F.col(c).alias(f"_{c}") for c in natural])
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in natural))
    fresh = number_members(members.join(other, same, "left_anti"), key, natural)
    last = old.agg(F.max(key)).first()[0] or 0
    return old.unionByName(fresh.withColumn(key, F.col(key) + last).select(key, *natural))


def with_row_id(df: DataFrame, key: str) -> DataFrame:
    """Put a unique, otherwise meaningless row id first. It is given while the
    table is written, so every stored row keeps its own."""
    return df.select(F.monotonically_increasing_id().alias(key), *df.columns)


def with_row_numbers(df: DataFrame, key: str) -> DataFrame:
    """Put row ids 1..n in the order of all columns first; the same rows always get the same ids.

    Ranges of rows are numbered side by side, each after the counts of those before. Equal rows are dealt
    to several ranges: which of them has which id makes no difference.
    """
    salted = df.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id()))
    return _numbered(salted, key, df.columns, [*df.columns, "_salt"]).drop("_salt")
