"""Databases, tables and loads."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.sources.seeds import rows_to_df


def ensure_database(spark: SparkSession, name: str) -> list[str]:
    """Create a database if it is missing, make it current, list all databases."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    spark.catalog.setCurrentDatabase(name)
    return [d.name for d in spark.catalog.listDatabases()]


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")
    if any(c.isPartition for c in spark.catalog.listColumns(new)):
        # Partitions are known by the place they had before.
        spark.sql(f"MSCK REPAIR TABLE {new} SYNC PARTITIONS")


def replace_table(spark: SparkSession, name: str, load: Callable[[str], None]) -> None:
    """Have ``load`` fill a table beside ``name``, and then put it in the place of ``name``.

    While it loads, and if it fails, the old table stays as it is and can be read, also by the load
    itself. What a failed load has left beside goes with the next one.
    """
    loading, replaced = f"{name}__loading", f"{name}__replaced"
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(replaced):
        # An earlier switch was cut short between its two steps.
        _rename(spark, replaced, name)
    drop_table(spark, loading)
    drop_table(spark, replaced)
    load(loading)
    there = spark.catalog.tableExists(name)
    if there:
        _rename(spark, name, replaced)
    try:
        _rename(spark, loading, name)
    except Exception:
        if there:
            _rename(spark, replaced, name)
        raise
    drop_table(spark, replaced)


def overwrite_table(
    df: DataFrame, name: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Replace a managed table, layout included. A failed write leaves the old table."""

    def load(beside: str) -> None:
        writer = df.write.format(fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(beside)

    replace_table(df.sparkSession, name, load)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, fmt: str = "parquet"
) -> None:
    """Create an empty table with a fixed layout, unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}")


def load_table(
    df: DataFrame, name: str, schema: T.StructType, fmt: str = "parquet", append: bool = False
) -> None:
    """Load a query result into a fixed layout, by position.

    Spark's store assignment casts the values and rejects unsafe ones. A load
    replaces the rows, so that running it twice leaves the same table; appending
    has to be asked for. A failed load leaves the old rows.
    """
    spark = df.sparkSession
    if append:
        create_table(spark, name, schema, fmt)
        df.write.insertInto(name)
        return

    def load(beside: str) -> None:
        create_table(spark, beside, schema, fmt)
        df.write.insertInto(beside)

    replace_table(spark, name, load)


def append_rows(
    spark: SparkSession,
    name: str,
    rows: Iterable[Sequence],
    columns: Sequence[str] | None = None,
) -> None:
    """Append literal rows; columns that are not listed become NULL."""
    schema = spark.table(name).schema
    given = schema if columns is None else T.StructType([schema[c] for c in columns])
    df = rows_to_df(spark, rows, given)
    missing = [f for f in schema if f.name not in given.names]
    df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else df
    df.select(*schema.names).write.insertInto(name)


def preview(df: DataFrame, n: int, order_by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows; with an order the choice is the same every time."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
