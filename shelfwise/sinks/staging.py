"""Intermediate tables in the shared folder the cluster names.

A staged table is written once and read back: later plans start from files that
outlive a lost executor, and Spark knows their size when it chooses joins.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder(app_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"shelfwise-{app_id}-")


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a temporary folder only where a
    local session names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        return _local_folder(spark.conf.get("spark.app.id"))
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def new_place(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/shelfwise/{spark.conf.get('spark.app.id')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to a place of its own under the shared folder and return the
    table read back."""
    spark = df.sparkSession
    path = new_place(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
