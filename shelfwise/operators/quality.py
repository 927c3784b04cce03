"""Checks of a load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    spark = next(iter(tables.values())).sparkSession
    counts = [
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {{{name}}}" for name in tables
    ]
    return spark.sql(" UNION ALL ".join(counts), **tables)


def column_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column of each table: its place and type. Reads no rows."""
    spark = next(iter(tables.values())).sparkSession
    columns = [
        (name, place, f.name, f.dataType.simpleString())
        for name, df in tables.items()
        for place, f in enumerate(df.schema, 1)
    ]
    return spark.createDataFrame(
        columns, "table_name string, position int, column_name string, data_type string"
    )


def column_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column of each table: its place, type and number of values. Each table is read once."""
    profiles = []
    for name, df in tables.items():
        rows = [
            F.struct(
                F.lit(name).alias("table_name"), F.lit(place).alias("position"), F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"), F.count(F.col(f"`{f.name}`")).alias("value_count"),
            )
            for place, f in enumerate(df.schema, 1)
        ]
        profiles.append(df.agg(F.array(*rows).alias("columns")).select(F.inline("columns")))
    return reduce(DataFrame.unionAll, profiles)


def member_usage(dim: DataFrame, key: str, facts: DataFrame) -> DataFrame:
    """Dimension rows with the number of fact rows that refer to them."""
    # Members without facts count, too, so each is found by equality, also where all facts have one key.
    member = F.col(key).alias("_key")
    marked = dim.select(member, F.lit(0).alias("_n")).unionAll(facts.select(member, F.lit(1).alias("_n")))
    used = marked.groupBy("_key").agg(F.sum("_n").alias("fact_rows"))
    return dim.join(used, F.col(key) == F.col("_key")).drop("_key")


def assert_unique(df: DataFrame, columns: Sequence[str], name: str) -> None:
    """Fail if two rows agree on ``columns``; facts joined on them would multiply."""
    twice = df.groupBy(*columns).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{name} is not unique on {list(columns)}: {twice[0].asDict()}")


def assert_unique_keys(tables: Mapping[str, tuple[DataFrame, str]]) -> None:
    """Fail if a key stands twice in its table; one job for all tables."""
    keys = [
        df.select(F.lit(name).alias("name"), F.col(key).cast("string").alias("key"))
        for name, (df, key) in tables.items()
    ]
    every = reduce(DataFrame.unionAll, keys)
    if rows := every.groupBy("name", "key").count().where("count > 1").take(1):
        raise ValueError(f"{rows[0]['name']} holds {rows[0]['key']} more than once")


def assert_found(df: DataFrame, key: str, dimension: DataFrame, name: str) -> None:
    """Fail if a key of ``df`` is no member of the dimension; one row is fetched at most."""
    missing = df.where(F.col(key).isNotNull()).select(key).distinct().join(dimension, key, "left_anti")
    if rows := missing.take(1):
        raise ValueError(f"{name}: {key} {rows[0][0]} is not in its dimension")
