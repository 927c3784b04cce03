"""From raw CSV files with inferred types (prices as DOUBLE) to dimensions, facts and prices."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import banded, dims, facts, kpis, priority
from shelfwise.operators.quality import column_report
from shelfwise.plans.star import load_star
from shelfwise.plans.workspace import RawWorkspace
from shelfwise.sinks.staging import stage
from shelfwise.sources import seeds
from shelfwise.sources.files import read_csv

NOW = dt.datetime(2025, 3, 1)

RAW_A = """\
Product ID,Category,Brand,Season,Original Price,Competitor Price,Markdown 1,Markdown 2,Markdown 3,Markdown 4,Historical Sales,Sales After M1,Sales After M2,Sales After M3,Sales After M4,Optimal Discount,Stock Level,Customer Ratings,Promotion Type,Seasonality Factor,Return Rate
P1,Skin,Acme,Summer,100.5,90.25,5.0,10.0,20.0,40.0,10,11,12,13,14,20.0,150,2.5,Bulk,1.1,0.05
P2,Skin,Bolt,Festive,49.99,60.0,10.0,15.0,20.0,30.0,50,50,51,40,50,10.0,0,4.75,Loyal,1.0,0.01
P3,Hair,Acme,Winter,2500.0,2500.0,0.1,10.0,20.0,40.0,5,5,5,5,5,30.0,60,NaN,,0.9,
"""
RAW_B = """\
Product ID,Category,Brand,Season,Original Price,Current Price,Markdown Percentage,Stock Quantity,Customer Rating,Is Returned,Return Reason
Q1,Shirts,Bolt,Winter,700.0,560.0,20.0,40,3.3,true,Size Issue
Q2,Shirts,Cove,Summer,300.0,,0.1,500,NaN,false,
"""


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    (folder / "a.csv").write_text(RAW_A)
    (folder / "b.csv").write_text(RAW_B)
    return read_csv(spark, str(folder / "a.csv")), read_csv(spark, str(folder / "b.csv"))


def test_types_as_inferred(raw):
    kinds = {f.name: f.dataType.simpleString() for f in raw[0].schema}
    assert kinds["original_price"] == kinds["customer_ratings"] == "double"
    assert raw[0].where("customer_ratings IS NULL").count() == 1


def test_star(spark, raw):
    a, b = raw
    d = {
        "dim_category": dims.dim_category(stage(dims.category_members(a, b), "csv")),
        "dim_brand": dims.dim_brand(stage(dims.brand_members(a, b), "csv")),
        "dim_season": dims.dim_season(stage(dims.season_members(a, b), "csv")),
        "dim_markdown": dims.dim_markdown(stage(dims.markdown_members(a, b), "csv")),
        "dim_customer_rating": dims.dim_customer_rating(stage(dims.rating_members(a, b), "csv")),
        "dim_promotion": dims.dim_promotion(stage(dims.promotion_members(a), "csv")),
        "dim_price_range": seeds.dim_price_range(spark),
        "dim_stock_level": seeds.dim_stock_level(spark),
    }
    assert [r[1] for r in d["dim_customer_rating"].orderBy("customer_rating").collect()] == [
        Decimal("2.50"), Decimal("3.30"), Decimal("4.75")
    ]
    sales = {r["original_price"]: r for r in facts.fact_sales(a, b, d, NOW).collect()}
    assert len(sales) == 5
    # 0.1 % and 2.5 are found, though neither is the same number as DOUBLE and DECIMAL.
    assert all(r["markdown_key"] is not None for r in sales.values())
    assert sales[Decimal("100.50")]["customer_rating_key"] == 1
    assert sales[Decimal("300.00")]["customer_rating_key"] is None
    assert sales[Decimal("300.00")]["revenue"] == 300
    assert sales[Decimal("700.00")]["revenue"] == 560
    assert sales[Decimal("49.99")]["revenue"] == Decimal("2499.50")
    assert [sales[Decimal(p)]["price_range_key"] for p in ("49.99", "700.00", "2500.00")] == [1, 2, 3]
    returned = facts.fact_customer_feedback(b, d, NOW).where("is_returned = 'true'").collect()
    assert [r["return_reason"] for r in returned] == ["Size Issue"]


def test_load_of_the_star_and_pricing_from_its_tables(spark, raw):
    a, b = raw
    products = a.select("product_id", F.col("product_id").alias("product_name"), "category", "brand", F.col("original_price").alias("price"))
    customers = spark.createDataFrame(
        [(7, "Ann", "Ohio", None)], "customer_number long, customer_name string, state string, country string"
    )
    name = "csv"
    rows = {r[0]: r[1] for r in load_star(RawWorkspace(a, b, products, customers, NOW), name, "orc").collect()}
    assert (rows["fact_sales"], rows["dim_product"], rows["banded_rules"], rows["priority_rules"]) == (5, 3, 25, 7)
    days = spark.table(f"{name}.fact_sales").join(spark.table(f"{name}.dim_date"), "date_key")
    assert days.count() == 5 and days.first()["full_date"] == NOW.date()

    result, _ = banded.apply_banded_rules(banded.assumed_signals(spark.table(f"{name}.retail_a")), spark.table(f"{name}.banded_rules"))
    assert {r["product_id"]: r["markdown_reason"] for r in result.collect()}["P1"] == "SALES_VELOCITY"
    priced = priority.apply_priority_rules(
        priority.with_baseline_price(spark.table(f"{name}.retail_a")), spark.table(f"{name}.priority_rules")
    )
    assert {r["product_id"]: r["Optimal_Discount_Pct"] for r in priced.collect()} == {"P1": 60, "P2": 15, "P3": 15}

    report = column_report({t: spark.table(f"{name}.{t}") for t in ("dim_date", "priority_rules")}).collect()
    assert ("priority_rules", 3, "condition", "string") in set(map(tuple, report)) and len(report) == 15


def test_rule_engines(spark, raw):
    a = raw[0]
    signals = banded.assumed_signals(a)
    result, _ = banded.apply_banded_rules(signals, seeds.banded_rules(spark, NOW.date()))
    got = {r["product_id"]: r for r in kpis.pricing_kpis(result, "historical_sales").collect()}
    # 10 of 150 sold: velocity band below 20 %.
    assert got["P1"]["sell_through_rate"] == Decimal("6.67")
    assert got["P1"]["recommended_price"] == Decimal("65.325")
    assert got["P1"]["markdown_reason"] == "SALES_VELOCITY"
    assert (got["P1"]["gross_amount"], got["P1"]["net_amount"]) == (1005, Decimal("653.25"))
    assert got["P1"]["discount_pct_applied"] == 35
    # Nothing in stock: no sell-through rate; the assumed stock age decides.
    assert got["P2"]["sell_through_rate"] is None
    assert (got["P2"]["markdown_reason"], got["P2"]["recommended_price"]) == ("EXPIRY", Decimal("39.992"))

    priced = priority.with_baseline_price(a)
    marked = priority.with_markdown_amounts(
        priority.apply_priority_rules(priced, seeds.priority_rules(spark))
    )
    got = {r["product_id"]: r for r in marked.collect()}
    assert got["P1"]["Our_Price"] == Decimal("94.7625")
    assert [got[p]["Optimal_Discount_Pct"] for p in ("P1", "P2", "P3")] == [60, 15, 15]
    assert got["P1"]["Markdown_Amount"] == Decimal("56.86")
    assert got["P1"]["Final_Marked_Down_Price"] == Decimal("37.90")
