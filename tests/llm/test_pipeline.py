"""The pipeline's stages, each on what its predecessor kept."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from shelfwise.llm import chains, compression, contamination, minhash
from shelfwise.llm.scratch import stored

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], FOLDER), name))
    return out


def test_stages_return_documents_and_shrink(kept):
    for before, after in zip(kept, kept[1:-1]):
        assert after.columns == before.columns and 0 < after.count() <= before.count()


def test_each_stage_leaves_nothing_of_its_kind(spark, kept):
    labelled, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    model = compression.fit(labelled, labels)
    assert compression.score(kept[1], model).where("predicted = 0").count() == 0
    assert minhash.near_duplicates(kept[2]).where("not kept").count() == 0
    assert chains.passages(kept[3]).where("matched = n_words").count() == 0
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    assert contamination.contamination(kept[4], bench).where("contaminated").count() == 0


def test_packing_covers_what_is_left(kept):
    packed = kept[5].groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).toDF("doc_id", "a", "b").collect()
    rows = [(r.doc_id, r.a, r.b) if hasattr(r, "a") else tuple(r) for r in packed]
    assert len(rows) == kept[4].count() and all(a == b for _, a, b in rows)


ODD = "doc_id long, text string, lang string, source string, n_chars long, row long, _odd boolean, _own_id long, spans string"


def _odd(spark, texts):
    rows = [(i, t, "en", "web", len(t or ""), 1, False, 9, "s") for i, t in texts]
    return spark.createDataFrame(rows, ODD).repartition(3)


def _kept(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages_judge_rows_one_by_one(spark):
    """Null, repeated and empty rows, and columns whose names clash."""
    one, two, three = (" ".join(f"{p}{i}" for i in range(120)) for p in "abc")
    near = one.replace("a60 ", "changed ")
    docs = _odd(spark, [
        (1, one), (None, one), (None, near), (None, two), (None, two), (5, three), (5, "quite another text"),
        (5, "quite another text"), (6, three), (7, None), (None, ""), (8, ""),
    ])
    kept = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert kept.columns == docs.columns and {r._own_id for r in kept.collect()} == {9}
    assert _kept(kept) == sorted(
        [(1, one), (None, two), (5, "quite another text"), (6, three), (7, None), (None, ""), (8, "")], key=str
    )
    passage = " ".join(f"p{i}" for i in range(80))
    docs = _odd(spark, [(1, f"{one} {passage}"), (None, f"{two} {passage}"), (2, f"{passage} {three}"), (2, "x y z"), (3, None), (4, "")])
    left = corpus_pipeline.substring_dedup(spark, docs, FOLDER)
    assert left.columns == docs.columns
    assert _kept(left.withColumn("text", F.trim("text"))) == sorted([(1, f"{one} {passage}"), (None, two), (2, three), (2, "x y z")], key=str)
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").where("length(text) > 80").orderBy("item_id").first().text
    docs = _odd(spark, [(None, item), (1, item), (1, one), (None, two), (2, None), (3, ""), (None, two)])
    clean = corpus_pipeline.decontaminate(spark, docs, FOLDER)
    assert clean.columns == docs.columns
    assert _kept(clean) == sorted([(1, one), (None, two), (2, None), (3, "")], key=str)
    none = docs.limit(0)
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.substring_dedup, corpus_pipeline.decontaminate):
        assert stage(spark, none, FOLDER).count() == 0


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert set(entry.oracle_sql()) <= set(names)
