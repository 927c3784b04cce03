"""Keys over loads, failed loads, rejected records, long calendars, repeatable row ids, stored counts."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import dims
from shelfwise.operators.keys import keep_keys, with_row_numbers
from shelfwise.operators.quality import column_profile, row_counts
from shelfwise.plans.star import load_star
from shelfwise.plans.workspace import RawWorkspace
from shelfwise.sinks import staging, tables
from shelfwise.sources.files import read_csv_checked
from shelfwise.types import COUNT, PRICE, TEXT, table
from tests.test_plans import plan
from tests.test_tables import A, B, retail

NOW = dt.datetime(2025, 1, 2)


def test_known_members_keep_their_keys(spark):
    known = spark.createDataFrame([(7, "b"), (2, None)], "k long, name string")
    members = spark.createDataFrame([("a",), ("b",), (None,), ("c",)], "name string")
    got = {r["name"]: r["k"] for r in keep_keys(members, known, "k", ["name"]).collect()}
    assert got == {"b": 7, None: 2, "a": 8, "c": 9}
    assert {r["name"]: r["k"] for r in keep_keys(members.where("name = 'b'"), known, "k", ["name"]).collect()} == {"b": 7, None: 2}
    assert {r["name"]: r["k"] for r in keep_keys(members, known.limit(0), "k", ["name"]).collect()} == {None: 1, "a": 2, "b": 3, "c": 4}


def _star(spark, rows_a, rows_b, products):
    a, b = retail(spark, rows_a, rows_b)
    shop = spark.createDataFrame(products, "product_id string, product_name string, category string, brand string, price decimal(10,2)")
    people = spark.createDataFrame([(1, "c", "s", "l")], "customer_number long, customer_name string, state string, country string")
    return RawWorkspace(a, b, shop, people, NOW)


def test_a_second_load_with_more_members_keeps_every_key(spark):
    ten = Decimal(10)
    first = [("P5", "n", "x", "b1", ten), ("P7", "n", "y", "b1", ten)]
    load_star(_star(spark, [A], [B], first), "lasting")
    names = [*dims.DIMENSIONS, "dim_product"]
    before = {n: set(map(tuple, spark.table(f"lasting.{n}").drop("created_date").collect())) for n in names}
    # Members that sort before the known ones, and one known member fewer.
    more_a = [A | {"category": "a", "brand": "a0", "season": "Autumn", "customer_ratings": Decimal(1), "promotion_type": "Ads"}, A]
    more = [("P1", "n", "a", "a0", ten), *first[:1]]
    load_star(_star(spark, more_a, [B | {"markdown_percentage": Decimal(1)}], more), "lasting")
    for n in names:
        after = set(map(tuple, spark.table(f"lasting.{n}").drop("created_date").collect()))
        assert before[n] <= after, n
        keys = [r[0] for r in after]
        assert len(set(keys)) == len(keys)
        assert len(after) > len(before[n])
    sales = spark.table("lasting.fact_sales")
    assert sales.count() == 3 and sales.where("category_key is null or brand_key is null or season_key is null").count() == 0


def test_all_members_are_numbered_in_one_pass(spark):
    a, b = retail(spark, [A, A | {"category": None, "customer_ratings": None, "promotion_type": None}], [B])
    every = dims.all_members(a, b)
    assert plan(every).count("Exchange hashpartitioning") == 1
    numbered = dims.number_all(every)
    one = {n: sorted(map(str, dims.dimension(numbered, n).collect())) for n in dims.DIMENSIONS}
    members = {
        "dim_category": dims.dim_category(dims.category_members(a, b)), "dim_brand": dims.dim_brand(dims.brand_members(a, b)),
        "dim_season": dims.dim_season(dims.season_members(a, b)), "dim_markdown": dims.dim_markdown(dims.markdown_members(a, b)),
        "dim_customer_rating": dims.dim_customer_rating(dims.rating_members(a, b)),
        "dim_promotion": dims.dim_promotion(dims.promotion_members(a)),
    }
    assert one == {n: sorted(map(str, df.collect())) for n, df in members.items()}


def test_the_six_dimensions_read_the_lines_once_for_each_source(work):
    assert plan(dims.all_members(work.retail_a, work.retail_b)).count("FileScan") == 2


def test_a_failed_load_leaves_the_old_rows(spark):
    tables.ensure_database(spark, "t3")
    schema = table(v=COUNT)
    tables.load_table(spark.range(5).select(F.col("id").cast("int")), "t3.x", schema)
    fails = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 999, F.raise_error(F.lit("midway"))).otherwise(F.col("id")).cast("int"))
    with pytest.raises(Exception, match="midway"):
        tables.load_table(fails, "t3.x", schema)
    assert spark.table("t3.x").count() == 5
    with pytest.raises(Exception, match="midway"):
        tables.overwrite_table(fails.toDF("v"), "t3.x")
    assert spark.table("t3.x").count() == 5
    # A load may read the table that it replaces.
    tables.load_table(spark.table("t3.x").where("v > 2"), "t3.x", schema)
    assert sorted(r[0] for r in spark.table("t3.x").collect()) == [3, 4]
    assert [t.name for t in spark.catalog.listTables("t3")] == ["x"]


def test_partitions_follow_their_table(spark):
    tables.ensure_database(spark, "t6")
    for n in (10, 30):
        rows = spark.range(n).select("id", (F.col("id") % 3).alias("p"))
        tables.overwrite_table(rows, "t6.x", partition_by=["p"])
        assert spark.table("t6.x").where("p = 1").count() == n // 3
    assert [t.name for t in spark.catalog.listTables("t6")] == ["x"]


def test_a_switch_cut_short_is_made_good(spark):
    tables.ensure_database(spark, "t4")
    schema = table(v=COUNT)
    tables.load_table(spark.range(5).select(F.col("id").cast("int")), "t4.x", schema)
    spark.sql("ALTER TABLE t4.x RENAME TO t4.x__replaced")
    with pytest.raises(Exception, match="midway"):
        tables.load_table(spark.range(1).select(F.raise_error(F.lit("midway")).cast("int")), "t4.x", schema)
    assert spark.table("t4.x").count() == 5


def test_records_that_do_not_fit_are_kept_apart(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(
        'Product ID,Price,Stock\nP1,10.50,3\nP2,cheap,4\nP3,7\nP4,8,1,extra\n,,\n"P,5",1,x\nP6,2,2\n'
    )
    schema = table(**{"Product ID": TEXT, "Price": PRICE, "Stock": COUNT})
    checked = read_csv_checked(spark, str(tmp_path), schema)
    assert checked.rows.columns == ["product_id", "price", "stock"]
    assert sorted(str(r[0]) for r in checked.rows.collect()) == ["None", "P1", "P6"]
    # What is selected makes no difference.
    assert checked.rows.count() == 3 and checked.rows.select("product_id").distinct().count() == 3
    assert sorted(r["record"] for r in checked.rejects.collect()) == ['"P,5",1,x', "P2,cheap,4", "P3,7", "P4,8,1,extra"]
    assert checked.rejects.count() == 4 and checked.rejects.select("file").first()[0].endswith("raw.csv")
    tables.ensure_database(spark, "t5")
    for _ in range(2):
        tables.load_table(checked.rejects, "t5.rejects", table(file=TEXT, record=TEXT), append=True)
    assert spark.table("t5.rejects").count() == 8


def test_a_calendar_of_ten_million_days_runs_in_several_tasks(spark):
    days = spark.range(1).select(F.lit(dt.date(1000, 1, 1)).alias("d")).unionAll(spark.range(1).select(F.date_add(F.lit(dt.date(1000, 1, 1)), 9_999_999)))
    found = dims.dim_date_of(days, "d").select("full_date", "date_key", F.spark_partition_id().alias("task"))
    r = found.agg(F.count("*"), F.count_distinct("task"), F.count_distinct("date_key"), F.datediff(F.max("full_date"), F.min("full_date"))).first()
    assert r[0] == r[2] == r[3] + 1 == 10_000_000 and r[1] > 8
    assert dims.dim_date_of(days.limit(0), "d").count() == 0
    assert dims.dim_date(spark, dt.date(1900, 1, 1), dt.date(2899, 12, 31)).rdd.getNumPartitions() > 3
    assert dims.dim_date(spark, dt.date(2024, 1, 2), dt.date(2024, 1, 1)).count() == 0


def test_row_ids_are_the_same_however_rows_are_dealt(spark):
    rows = spark.range(3000).select((F.col("id") % 7).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("b"))
    hot = rows.unionAll(spark.range(2000).select(F.lit(3).alias("a"), F.lit(None).alias("b")))
    one, two = (sorted(map(tuple, with_row_numbers(hot.repartition(n), "k").collect())) for n in (3, 8))
    assert one == two and [r[0] for r in one] == list(range(1, 5001))
    assert [r[1:] for r in one] == sorted([r[1:] for r in one], key=lambda r: (r[0], r[1] is not None, r[1] or 0))


def test_counts_are_those_of_the_stored_rows(spark, work):
    kept = work.stored_facts["fact_sales"]
    assert row_counts({"s": kept}).first()["row_count"] == 6000
    fewer = staging.stage(kept.limit(5999), "test/fewer")
    assert row_counts({"s": fewer}).first()["row_count"] == 5999
    assert "ReadSchema: struct<>" in plan(row_counts({"s": kept}), "formatted")


def test_column_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "k int, `v w` string")
    assert [tuple(r) for r in column_profile({"t": df}).collect()] == [("t", 1, "k", "int", 2), ("t", 2, "v w", "string", 1)]
