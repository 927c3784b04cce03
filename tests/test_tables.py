"""Readers, sinks, keys, dimensions and loads."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import dims, facts
from shelfwise.operators.conform import conformed_sales
from shelfwise.operators.joins import lookup
from shelfwise.operators.keys import number_members, with_row_id
from shelfwise.operators.quality import assert_found, assert_unique, member_usage, row_counts
from shelfwise.plans.queries import queries
from shelfwise.plans.star import load_star
from shelfwise.plans.workspace import Workspace
from shelfwise.sinks import staging, tables
from shelfwise.sources import seeds
from shelfwise.sources.files import read_csv, read_parquet, read_table
from shelfwise.sources.retail import customers
from shelfwise.types import RETAIL_A, RETAIL_B, TABLES, table
from shelfwise.types import COUNT, NUMBER, PRICE, TEXT

NOW = dt.datetime(2025, 1, 2, 3, 4, 5)


@pytest.fixture
def csv(tmp_path):
    (tmp_path / "raw.csv").write_text(
        "Product ID,Original Price,Customer Ratings,Stock\n"
        'P1,10.50,4.5,3\nP2,,NaN,\n"P,3",7,3,0\n'
    )
    return str(tmp_path)


def test_csv_with_schema(spark, csv):
    schema = table(**{"Product ID": TEXT, "Original Price": PRICE, "Customer Ratings": NUMBER, "Stock": COUNT})
    df = read_csv(spark, csv, schema)
    assert df.columns == ["product_id", "original_price", "customer_ratings", "stock"]
    assert sorted(tuple(r) for r in df.collect()) == [
        ("P,3", Decimal("7.00"), 3.0, 0), ("P1", Decimal("10.50"), 4.5, 3), ("P2", None, None, None)
    ]


def test_csv_with_inferred_types(spark, csv):
    df = read_csv(spark, csv, lower_names=False)
    assert df.columns == ["Product_ID", "Original_Price", "Customer_Ratings", "Stock"]
    assert [f.dataType.simpleString() for f in df.schema] == ["string", "double", "double", "int"]
    assert df.where("Customer_Ratings IS NULL").count() == 1


def test_parquet_and_tables(spark, tmp_path):
    tables.ensure_database(spark, "t1")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    tables.overwrite_table(df, "t1.x")
    tables.overwrite_table(df.select("v"), "t1.x")  # a new layout replaces the old one
    assert read_table(spark, "t1.x").columns == ["v"]
    tables.overwrite_table(df, "t1.p", partition_by=["v"])
    assert read_table(spark, "t1.p").where("v = 'a'").count() == 1
    tables.drop_table(spark, "t1.x")
    tables.drop_table(spark, "t1.x")
    assert not spark.catalog.tableExists("t1.x")
    df.write.parquet(str(tmp_path / "f"))
    assert read_parquet(spark, str(tmp_path / "f"), df.schema).count() == 2
    assert "t1" in tables.ensure_database(spark, "t1")


def test_fixed_layout_loads(spark):
    tables.ensure_database(spark, "t2")
    schema = TABLES["dim_store"]
    tables.load_table(seeds.dim_store(spark), "t2.store", schema)
    tables.load_table(seeds.dim_store(spark), "t2.store", schema)
    assert spark.table("t2.store").count() == 3
    tables.append_rows(spark, "t2.store", [(4, "Pop-up")], ["store_key", "store_name"])
    tables.append_rows(spark, "t2.store", [(5, "a", "b", "c", "d", "e")])
    rows = {r["store_key"]: r for r in spark.table("t2.store").collect()}
    assert len(rows) == 5 and rows[4]["city"] is None and rows[5]["country"] == "e"
    with pytest.raises(Exception, match="INCOMPATIBLE_DATA_FOR_TABLE|cannot"):
        tables.load_table(spark.sql("SELECT DATE'2024-01-01' a, 1 b, 1 c, 1 d, 1 e, 1 f"), "t2.store", schema)
    tables.create_table(spark, "t2.money", table(v=PRICE))
    spark.sql("SELECT 1.005D v").write.insertInto("t2.money")
    assert spark.table("t2.money").first()[0] == Decimal("1.01")


def test_preview_is_repeatable(spark):
    df = spark.range(1000).repartition(7)
    assert [r[0] for r in tables.preview(df, 3, [F.desc("id")]).collect()] == [999, 998, 997]
    assert tables.preview(df, 3).count() == 3


def test_staged_tables_lie_in_the_named_folder(spark):
    df = staging.stage(spark.range(10), "test/ids")
    assert staging.shared_folder(spark) in df.inputFiles()[0]
    assert df.count() == 10


def test_keys_follow_the_natural_key_over_slices(spark):
    names = spark.range(5000).select(
        F.when(F.col("id") > 0, F.concat(F.lit("n"), F.xxhash64("id").cast("string"))).alias("name")
    )
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = number_members(names, "k", ["name"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    ordered = sorted((r["name"] for r in names.collect()), key=lambda n: (n is not None, n or ""))
    assert sorted(map(tuple, numbered.collect())) == list(enumerate(ordered, 1))
    # No task numbers the whole table.
    assert len(numbered.inputFiles()) > 4
    assert number_members(names.limit(0), "k", ["name"]).count() == 0


def test_replaced_tables_give_new_rows(spark, tmp_path):
    source = "/root/testdata/sf0.001"
    for name in ("lineitem", "part", "orders"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{source}/{name}.parquet")
    plan = queries()["conformed_sales"]
    rows = plan(spark, str(tmp_path)).count()
    (tmp_path / "lineitem.parquet").unlink()
    spark.read.parquet(f"{source}/lineitem.parquet").limit(100).coalesce(1).write.parquet(
        str(tmp_path / "lineitem.parquet")
    )
    assert plan(spark, str(tmp_path)).count() == 100 < rows


def test_workspace_is_dated_today_unless_told(spark):
    assert Workspace(spark, "/nowhere").as_of.date() == dt.date.today()


def test_missing_members_are_found(spark):
    days = spark.createDataFrame([(20250101,)], "date_key long")
    facts_ = spark.createDataFrame([(20250101,), (None,)], "date_key long")
    assert_found(facts_, "date_key", days, "fact")
    with pytest.raises(ValueError, match="20250102"):
        assert_found(facts_.unionAll(spark.createDataFrame([(20250102,)], "date_key long")), "date_key", days, "fact")


def test_customers_without_a_nation_stay(spark):
    customer = spark.createDataFrame([(1, "c", 9)], "c_custkey long, c_name string, c_nationkey long")
    nation = spark.createDataFrame([], "n_nationkey long, n_name string, n_regionkey long")
    region = spark.createDataFrame([], "r_regionkey long, r_name string")
    assert customers(customer, nation, region).collect()[0].asDict()["state"] is None


def retail(spark, rows_a, rows_b):
    def fill(schema, row):
        return tuple(row.get(f.name) for f in schema)

    return (
        spark.createDataFrame([fill(RETAIL_A, r) for r in rows_a], RETAIL_A),
        spark.createDataFrame([fill(RETAIL_B, r) for r in rows_b], RETAIL_B),
    )


def all_dims(a, b, tag):
    def kept(members, name):
        return staging.stage(members, f"test/{tag}/{name}")

    return {
        "dim_category": dims.dim_category(kept(dims.category_members(a, b), "c")),
        "dim_brand": dims.dim_brand(kept(dims.brand_members(a, b), "b")),
        "dim_season": dims.dim_season(kept(dims.season_members(a, b), "s")),
        "dim_markdown": dims.dim_markdown(kept(dims.markdown_members(a, b), "m")),
        "dim_customer_rating": dims.dim_customer_rating(kept(dims.rating_members(a, b), "r")),
        "dim_promotion": dims.dim_promotion(kept(dims.promotion_members(a), "p")),
        "dim_price_range": seeds.dim_price_range(a.sparkSession),
        "dim_stock_level": seeds.dim_stock_level(a.sparkSession),
    }


A = {
    "product_id": "P1", "category": "x", "brand": "b1", "season": "Summer",
    "original_price": Decimal("100"), "markdown_1": Decimal("10"), "markdown_2": Decimal("20"),
    "markdown_3": Decimal("20"), "markdown_4": Decimal("40"), "historical_sales": 5,
    "sales_after_m1": 6, "sales_after_m2": 6, "sales_after_m4": 5, "stock_level": 10,
    "customer_ratings": Decimal("4"), "promotion_type": "Bulk",
}
B = {
    "product_id": "P2", "category": "y", "brand": "b1", "season": "Winter",
    "original_price": Decimal("600"), "current_price": None, "markdown_percentage": Decimal("10"),
    "stock_quantity": None, "customer_rating": None, "is_returned": "false",
}


def test_hot_and_missing_keys_keep_every_fact_row(spark):
    hot = [A] * 400 + [A | {"category": None, "customer_ratings": None, "promotion_type": None}] * 3
    a, b = retail(spark, hot, [B, B | {"current_price": Decimal("550"), "stock_quantity": 250}])
    d = all_dims(a, b, "hot")
    assert d["dim_category"].count() == 3  # x, y and the missing one
    assert d["dim_promotion"].count() == 1
    assert d["dim_customer_rating"].count() == 1
    sales = facts.fact_sales(a, b, d, NOW)
    assert sales.count() == 405
    assert sales.where("category_key IS NULL").count() == 3
    assert facts.fact_inventory(a, b, d, NOW).count() == 405
    impact = facts.fact_markdown_analytics(a, d, NOW)
    assert impact.count() == 403 and impact.where("promotion_key IS NULL").count() == 3
    assert {r[0] for r in impact.select("markdown_effectiveness").collect()} == {"Moderate Impact"}
    feedback = facts.fact_customer_feedback(b, d, NOW)
    assert feedback.count() == 2 and feedback.where("customer_rating_key IS NULL").count() == 2


def test_fact_values(spark):
    a, b = retail(spark, [A], [B, B | {"current_price": Decimal("550"), "stock_quantity": 250}])
    d = all_dims(a, b, "values")
    rows = facts.fact_sales(a, b, d, NOW).collect()
    assert {(r["current_price"], r["revenue"], r["historical_sales"]) for r in rows} == {
        (550, 550, 0), (600, 600, 0), (100, 600, 5)
    }
    assert {r["date_key"] for r in rows} == {20250102}
    assert {r["created_timestamp"] for r in rows} == {NOW}
    assert {(r["promotion_key"], r["store_key"], r["channel_key"], r["product_key"]) for r in rows} == {(1, 1, 1, None)}
    stock = facts.fact_inventory(a, b, d, NOW).collect()
    assert {(r["stock_status"], r["reorder_required"], r["inventory_value"]) for r in stock} == {
        ("Low Stock", "Yes", 1000), ("Overstock", "No", None), ("Overstock", "No", 150000)
    }


def test_load_time_does_not_depend_on_the_session_zone(spark):
    a, b = retail(spark, [A], [B])
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = facts.fact_sales(a, b, all_dims(a, b, "zone"), NOW).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (found["created_timestamp"], found["date_key"]) == (NOW, 20250102)


def test_dimensions_use_their_type_before_distinct(spark):
    a, b = retail(spark, [A, A], [B])
    loose = a.withColumn("customer_ratings", F.lit(4.001)).unionByName(
        a.withColumn("customer_ratings", F.lit(4.004))
    )
    members = dims.rating_members(loose, b.withColumn("customer_rating", F.lit(None).cast("double")))
    assert [r[0] for r in members.collect()] == [Decimal("4.00")]


def test_builders_give_the_same_twice(spark):
    a, b = retail(spark, [A, A | {"category": "z"}], [B])
    one, two = all_dims(a, b, "once"), all_dims(a, b, "twice")
    for name in one:
        assert sorted(map(str, one[name].collect())) == sorted(map(str, two[name].collect()))


def test_products(spark):
    rows = [("P1", "n1", "x", "b1", Decimal("500")), ("P1", "n1", "x", "b1", Decimal("500")),
            ("P2", "n2", "x", "b9", Decimal("2000")), ("P3", "n3", None, None, Decimal("2000.01"))]
    products = spark.createDataFrame(
        rows, "product_id string, product_name string, category string, brand string, price decimal(10,2)"
    )
    a, b = retail(spark, [A], [B])
    d = all_dims(a, b, "products")
    members = staging.stage(dims.product_members(products), "test/products")
    found = dims.dim_product(members, d["dim_category"], d["dim_brand"], NOW).orderBy("product_key")
    got = [(r["product_key"], r["category_key"], r["brand_key"], r["price_range_key"], r["cost_price"]) for r in found.collect()]
    assert got == [(1, 1, 1, 1, 300), (2, 1, None, 2, 1200), (3, None, None, 3, Decimal("1200.01"))]
    assert found.schema.names == TABLES["dim_product"].names


def test_conformed_sales_fills_what_a_source_lacks(spark):
    a, b = retail(spark, [A], [B])
    rows = {r["product_id"]: r for r in conformed_sales(a, b).collect()}
    assert rows["P1"]["current_price"] is None and rows["P1"]["sales_after_markdown"] == 6
    assert (rows["P2"]["historical_sales"], rows["P2"]["sales_after_markdown"]) == (0, 1)
    assert rows["P2"]["optimal_discount"] == 10


def test_lookup_of_null_finds_nothing(spark):
    df = spark.createDataFrame([(None,), ("a",)], "v string")
    dim = spark.createDataFrame([(None, 1), ("a", 2)], "m string, k int")
    assert sorted(map(str, lookup(df, F.col("v"), dim, "m", "k").collect())) == [
        "Row(v='a', k=2)", "Row(v=None, k=None)"
    ]


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a")], "k int, v string")
    assert_unique(df, ["k"], "df")
    with pytest.raises(ValueError, match="df is not unique"):
        assert_unique(df, ["v"], "df")
    assert {tuple(r) for r in row_counts({"x": df, "y": df.limit(1)}).collect()} == {("x", 2), ("y", 1)}
    used = member_usage(df, "k", spark.createDataFrame([(2,), (2,), (None,)], "k int"))
    assert {(r["k"], r["fact_rows"]) for r in used.collect()} == {(1, 0), (2, 2)}


def test_row_ids_are_unique(spark):
    df = with_row_id(spark.range(0, 1000, 1, 8).withColumnRenamed("id", "v"), "row")
    assert df.select("row").distinct().count() == 1000 and df.columns == ["row", "v"]


def test_loading_the_star_twice_leaves_the_same_rows(spark, work):
    first = {r[0]: r[1] for r in load_star(work, "star").collect()}
    second = {r[0]: r[1] for r in load_star(work, "star").collect()}
    assert first == second
    assert first["fact_sales"] == first["retail_a"] + first["retail_b"] == 6000
    assert first["dim_product"] == first["fact_sales_profit"] == first["fact_markdown_uplift"] == 200
    for name, schema in TABLES.items():
        if name.startswith(("dim_", "fact_")):
            loaded = spark.table(f"star.{name}").schema
            assert [(f.name, f.dataType) for f in loaded] == [(f.name, f.dataType) for f in schema]
    ids = spark.table("star.fact_sales").select("sales_key")
    assert ids.distinct().count() == 6000
