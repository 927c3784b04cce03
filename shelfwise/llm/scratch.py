"""Tables and files that later jobs build on, in the folder that the whole cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Without one, as in tests, a temporary folder; only a
    session on one machine gets that."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="shelfwise-")
    return _LOCAL[app]


def new_place(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: a lost executor costs no earlier step, and the
    planner knows the size of what it joins."""
    spark = df.sparkSession
    place = new_place(spark, name)
    df.write.option("compression", "zstd").parquet(place)
    return spark.read.schema(df.schema).parquet(place)
