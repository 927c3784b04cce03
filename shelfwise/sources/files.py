"""File and table readers. Every read is a distributed Spark scan."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.names import normalize_names
from shelfwise.functions.numbers import nan_to_null


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    lower_names: bool = True,
    **options: str,
) -> DataFrame:
    """CSV with a header row. With a schema the file is read once; without one
    Spark infers the types in a pass of its own. Blanks in column names become
    ``_`` and NaN becomes NULL. Values that don't fit their type become NULL, too;
    ``read_csv_checked`` tells them apart."""
    reader = spark.read.options(header=True, **options)
    if schema is None:
        df = reader.option("inferSchema", True).csv(path)
    else:
        df = reader.schema(schema).csv(path)
    return nan_to_null(normalize_names(df, lower=lower_names))


class CheckedRows(NamedTuple):
    """Rows that fit the schema, and those that don't: file, record (as it stands there)."""

    rows: DataFrame
    rejects: DataFrame


_RECORD = "_record"


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType, *, lower_names: bool = True, **options: str
) -> CheckedRows:
    """CSV with a header row; records with a value that does not fit its type, or with too many or too few
    values, are kept apart whole instead of losing values. Both parts are scans of the same files."""
    with_record = T.StructType([*schema.fields, T.StructField(_RECORD, T.StringType())])
    found = spark.read.options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_RECORD, **options)
    df = found.schema(with_record).csv(path)
    columns = [F.col(f"`{c}`") for c in schema.names]
    # Only columns that a query reads are held against their type; this condition, which always
    # holds, reads all of them, whatever is selected later.
    every, record = F.xxhash64(*columns) >= F.lit(-(2**63)), F.col(_RECORD)
    good = df.where(record.isNull() & every).select(columns)
    bad = df.where(record.isNotNull() & every).select(F.col("_metadata.file_path").alias("file"), record.alias("record"))
    return CheckedRows(nan_to_null(normalize_names(good, lower=lower_names)), bad)


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
