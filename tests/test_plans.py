"""Shape of the physical plans."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import banded, facts, priority
from shelfwise.plans.queries import queries
from shelfwise.sources import retail, seeds
from tests.conftest import FOLDER


def plan(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.mark.parametrize("name", queries())
def test_no_cross_product_and_no_python_rows(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "PythonUDF" not in text and "EvalPython" not in text


@pytest.mark.parametrize(
    "name",
    ["priority_rules_own_price", "markdown_amounts", "banded_recommendation", "pricing_kpis",
     "conformed_sales", "markdown_effectiveness", "feedback_bands", "normalized_columns"],
)
def test_row_by_row_queries_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(queries()[name](spark, FOLDER))


@pytest.mark.parametrize(
    "name, joins",
    [("fact_sales", 7), ("fact_inventory", 4), ("fact_markdown_analytics", 7), ("fact_customer_feedback", 4)],
)
def test_facts_broadcast_dimensions_and_stay_in_place(spark, name, joins):
    text = plan(queries()[name](spark, FOLDER))
    assert text.count("BroadcastHashJoin") == joins
    assert "SortMergeJoin" not in text and "NestedLoop" not in text
    assert "hashpartitioning" not in text and "rangepartitioning" not in text


def test_counting_rows_joins_no_dimension(spark):
    """Only products look up their category and brand, and customers their nation and region."""
    text = plan(queries()["load_row_counts"](spark, FOLDER))
    assert len(re.findall(r"\w*Join\b", text)) <= 4


def test_larger_dimensions_are_not_broadcast(spark, work):
    """Beyond the threshold the same code joins by shuffling, with the same rows."""
    small = facts.fact_customer_feedback(work.retail_b, work.dims, work.as_of)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = facts.fact_customer_feedback(work.retail_b, work.dims, work.as_of)
        assert plan(large).count("SortMergeJoin") == 4
        shuffled = sorted(map(str, large.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert shuffled == sorted(map(str, small.collect()))


def test_hot_keys_are_split(spark, work):
    """A third of the lines on one product and a third on one order."""
    lineitem, orders, part = (work.table(n) for n in ("lineitem", "orders", "part"))
    line = F.col("l_linenumber")
    hot = lineitem.withColumns(
        {
            "l_partkey": F.when(line <= 2, F.lit(2)).otherwise(F.col("l_partkey")),
            "l_orderkey": F.when(line >= 6, F.lit(7)).otherwise(F.col("l_orderkey")),
        }
    ).repartition(8)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        base = retail.retail_base(hot, part, orders)
        assert len(base.collect()) == lineitem.count()
        final = plan(base).split("== Initial Plan ==")[0]
        assert final.count("SortMergeJoin(skew=true)") == 2
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_scans_read_only_what_is_used(spark, work):
    text = plan(work.retail_a.select("category").distinct(), "extended")
    schema = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schema == ["category:string"]
    assert "source" in re.findall(r"PartitionFilters: \[([^\]]*)\]", text)[0]


def test_markdown_columns_are_read_in_one_scan(work):
    from shelfwise.operators.dims import markdown_members

    assert plan(markdown_members(work.retail_a, work.retail_b)).count("FileScan") == 2


def test_preview_keeps_only_the_top_rows(spark):
    assert "TakeOrderedAndProject" in plan(queries()["preview_fact_sales"](spark, FOLDER))


@pytest.mark.parametrize("name", ["banded_recommendation", "pricing_kpis", "banded_rule_prices"])
def test_generated_code_is_small_enough_to_be_compiled(spark, name):
    text = plan(queries()[name](spark, FOLDER), "codegen")
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text))) < 8000


def test_rule_engines_take_streams(spark, work, tmp_path):
    """Rules are row expressions, so a stream is priced by the same calls."""
    source = str(tmp_path / "in")
    work.retail_a.withColumnRenamed("historical_sales", "units_sold").withColumnRenamed(
        "customer_ratings", "product_rating"
    ).write.parquet(source)
    schema = spark.read.parquet(source).schema
    stream = spark.readStream.schema(schema).parquet(source)

    def priced(df):
        signals = banded.measured_signals(df.withColumn("season", F.upper("season")))
        result, _ = banded.apply_banded_rules(signals, seeds.banded_rules(spark, work.as_of.date()))
        named = result.withColumnsRenamed({"original_price": "Our_Price", "product_rating": "Customer_Ratings"})
        return priority.apply_priority_rules(named, seeds.priority_rules(spark)).select(
            "product_id", "recommended_price", "markdown_reason", "Optimal_Discount_Pct"
        )

    query = (
        priced(stream).writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    streamed = sorted(map(str, spark.read.parquet(str(tmp_path / "out")).collect()))
    assert streamed == sorted(map(str, priced(spark.read.parquet(source)).collect()))
