"""Documents to training sequences: quality, near duplicates, repeated passages, contamination, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import chains, compression, contamination, minhash, packing
from shelfwise.llm.scratch import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _by_row(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply ``stage`` to ``docs`` with an id of the row as ``doc_id``; the rows it returns get their own id back.

    Ids that one row has stay as they are. Rows without an id, and those of a repeated one, get an id of
    2**62 or more from a hash of their id and text: each text is judged on its own, and rows that also agree
    in their text are one document, of which one row stays.
    """
    counted = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    again = stored(counted.where("n > 1 or doc_id is null").select("doc_id"), "repeated-ids")
    if again.isEmpty():
        return stage(docs)  # every id tells its row already
    own, odd = _free("_own_id", docs.columns), _free("_odd", docs.columns)
    hashed = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2).bitwiseOR(F.lit(1 << 62))
    marked = docs.join(again.withColumn(odd, F.lit(True)), "doc_id", "left").withColumn(odd, F.col("doc_id").isNull() | F.col(odd).isNotNull())
    rows = marked.withColumn(own, F.col("doc_id")).withColumn("doc_id", F.when(F.col(odd), hashed).otherwise(F.col("doc_id").cast("long")))
    once = rows.where(~F.col(odd)).unionByName(rows.where(odd).dropDuplicates(["doc_id"]))
    return stage(once.select(*docs.columns, own)).withColumn("doc_id", F.col(own)).select(docs.columns)


def _free(name: str, taken: list[str]) -> str:
    return _free(f"_{name}", taken) if name in taken else name


def _only(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    return docs.join(chosen.select("doc_id").distinct(), "doc_id", "left_semi").select(docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. It is fitted on labelled documents of the whole table."""
    labelled = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = compression.fit(labelled, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return compression.filter_rows(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the least id, stays."""
    return _by_row(docs, lambda rows: _only(rows, minhash.near_duplicates(rows).where("kept")))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go from all documents but their first holder. A document of which no word
    is left goes; others stay, with the number of characters they still have."""
    left = _by_row(docs, lambda rows: chains.without_passages(rows, chains.passages(rows)))
    changed = left.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.lit(0).cast("long")))
    return changed.where(F.coalesce(F.trim("text"), F.lit("")) != "").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _by_row(docs, lambda rows: _only(rows, contamination.contamination(rows, bench).where("not contaminated")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontaminate),
    ("packing", packed),
]

#: Compressed sizes and tokens have no SQL; tests check each stage's rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
