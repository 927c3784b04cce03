from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import classify as C
from shelfwise.functions.numbers import exact, nan_to_null, percent_of
from shelfwise.operators.joins import range_lookup
from shelfwise.sources import seeds
from shelfwise.types import PERCENT, PRICE


def labels(spark, function, values, kind):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(function(F.col("v")).alias("x")).collect()]


@pytest.mark.parametrize(
    "function, kind, expected",
    [
        (C.stock_status, "int", {50: "Low Stock", 51: "Medium Stock", 200: "Medium Stock",
                                 201: "Overstock", None: "Overstock", -1: "Low Stock"}),
        (C.reorder_required, "int", {50: "Yes", 51: "No", None: "No"}),
        (C.markdown_type, "double", {10.0: "Low Discount", 10.01: "Medium Discount",
                                     30.0: "Medium Discount", 30.01: "High Discount",
                                     None: "High Discount"}),
        (C.markdown_strategy, "double", {10.0: "Profit Optimization", 30.0: "Sales Boost",
                                         31.0: "Inventory Clearance"}),
        (C.rating_category, "double", {2.0: "Poor", 2.01: "Average", 3.0: "Average", 4.0: "Good",
                                       4.01: "Excellent", None: "Excellent"}),
        (C.feedback_category, "double", {2.0: "Negative Feedback", 4.0: "Neutral Feedback",
                                         4.01: "Positive Feedback", None: "Positive Feedback"}),
        (C.price_range_key, "double", {500.0: 1, 500.5: 2, 2000.0: 2, 2000.5: 3, 1e6: 3}),
        (C.discount_type, "string", {"Flat Discount": "Percentage",
                                     "CLEARANCE discount": "Percentage",
                                     "Summer Clearance": "Inventory Clearance",
                                     "Combo Offer": "Combo Offer", "Bulk": "General Promotion",
                                     None: "General Promotion"}),
    ],
)
def test_bands(spark, function, kind, expected):
    assert labels(spark, function, list(expected), kind) == list(expected.values())


def test_seasons(spark):
    values = ["Summer", "MONSOON", "winter", "Festive", "Spring", None]
    assert labels(spark, lambda c: C.season_month(c, 0), values, "string") == [3, 7, 10, 10, None, None]
    assert labels(spark, lambda c: C.season_month(c, 1), values, "string") == [6, 9, 2, 12, None, None]


def test_effectiveness(spark):
    df = spark.createDataFrame(
        [(10, 11, 11), (10, 11, 10), (10, 10, 10), (None, 1, 1)], "b int, m2 int, m4 int"
    )
    found = df.select(C.markdown_effectiveness(F.col("b"), F.col("m2"), F.col("m4")).alias("x"))
    assert [r[0] for r in found.collect()] == [
        "High Impact", "Moderate Impact", "Low Impact", "Low Impact"
    ]


def test_price_ranges_leave_gaps(spark):
    cases = {"0": "Budget", "500": "Budget", "500.50": None, "501": "Mid Range", "2000": "Mid Range",
             "2000.50": None, "2001": "Premium", "10000": "Premium", "10000.01": None, "-1": None}
    df = spark.createDataFrame([(Decimal(k),) for k in cases], "v decimal(10,2)")
    found = range_lookup(
        df, F.col("v"), seeds.dim_price_range(spark), "min_price", "max_price", "price_segment",
        cell=1000,
    )
    got = {r[0]: r[1] for r in found.collect()}
    assert got == {Decimal(k).quantize(Decimal("0.01")): v for k, v in cases.items()}


@pytest.mark.parametrize("cell", [1, 7, 100000])
def test_range_lookup_is_a_range_join_for_any_cell_width(spark, cell):
    bands = [(1, -5, 10), (2, 8, 30), (3, 31, 31), (4, 100, 250)]
    values = [None, -6, -5, 0, 8, 9, 10, 11, 30, 31, 32, 100, 101, 250, 251]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    side = spark.createDataFrame(bands, "id int, lo int, hi int")
    got = range_lookup(df, F.col("v"), side, "lo", "hi", "id", cell=cell).collect()
    want = []
    for v in values:
        hits = [i for i, lo, hi in bands if v is not None and lo <= v <= hi]
        want += [(v, i) for i in hits or [None]]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_percentages(spark):
    df = spark.createDataFrame([(29, 7), (1, 0), (None, 5), (5, None), (0, 5)], "a int, b int")
    got = [r[0] for r in df.select(percent_of(F.col("a"), F.col("b"), PERCENT)).collect()]
    assert got == [Decimal("414.29"), None, None, None, Decimal("0.00")]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(1, float("nan"), "x"), (2, 1.5, None)], "id int, `a b` double, s string")
    assert [tuple(r) for r in nan_to_null(df).orderBy("id").collect()] == [(1, None, "x"), (2, 1.5, None)]


def test_money_is_exact(spark):
    df = spark.createDataFrame([(Decimal("1.005"),)], "v decimal(10,3)")
    assert df.select((F.col("v") * exact("1")).cast(PRICE)).first()[0] == Decimal("1.01")


def test_calendar(spark):
    import datetime as dt

    from shelfwise.operators.dims import dim_date, dim_date_of

    rows = {r["full_date"]: r for r in dim_date(spark).collect()}
    assert len(rows) == 731
    day = rows[dt.date(2024, 12, 29)]
    assert (day["date_key"], day["day"], day["month_name"], day["quarter"]) == (20241229, 29, "December", 4)
    assert (day["week_of_year"], day["day_of_week"], day["is_weekend"]) == (52, "Sunday", "Yes")
    assert rows[dt.date(2024, 12, 30)]["week_of_year"] == 1
    assert sum(r["is_weekend"] == "Yes" for r in rows.values()) == 208
    none = dim_date_of(spark.createDataFrame([], "d date"), "d")
    assert none.count() == 0
