import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfwise.operators import banded
from shelfwise.operators.kpis import pricing_kpis
from shelfwise.sources import seeds
from shelfwise.types import TABLES

DAY = dt.date(2025, 1, 1)
SIGNALS = (
    "original_price decimal(10,2), unit_cost decimal(12,4), days_in_stock double, "
    "sell_through_rate decimal(14,2), season string, competitor_gap_pct decimal(14,2), "
    "product_rating decimal(3,2), trend_score int"
)
ALL = ["price_expiry", "price_sales_velocity", "price_seasonal", "price_competitor",
       "price_product_rating", "price_trending"]


def frame(spark, rows):
    return spark.createDataFrame(rows, SIGNALS)


def row(price="100", cost="0", days=None, rate=None, season=None, gap=None, rating=None, trend=None):
    def dec(x):
        return None if x is None else Decimal(str(x))

    return (dec(price), dec(cost), days, dec(rate), season, dec(gap), dec(rating), trend)


def rules(spark):
    return seeds.banded_rules(spark, DAY)


def one_rule(spark, *bands):
    rows = [
        (1, "R", t, op, lo, hi, text, m, None, "t", DAY) for t, op, lo, hi, text, m in bands
    ]
    return seeds.rows_to_df(spark, rows, TABLES["banded_rules"])


def prices(spark, column, rows):
    result, _ = banded.apply_banded_rules(frame(spark, rows), rules(spark))
    return [None if r[0] is None else float(r[0]) for r in result.select(column).collect()]


@pytest.mark.parametrize(
    "column, field, expected",
    [
        ("price_sales_velocity", "rate", {19.99: 65, 20: 80, 40: 80, 40.01: 90, 70: 90, 70.01: 100, None: 100}),
        ("price_competitor", "gap", {-10.01: 105, -10: 100, -7: 100, -5: 100, 5: 100, 5.01: 93, 15: 93, 15.01: 82}),
        ("price_trending", "trend", {19: 80, 20: 90, 50: 90, 51: 100, 80: 100, 81: 110}),
        ("price_expiry", "days", {0.0: 40, 2.0: 40, 2.5: 100, 3.0: 55, 14.0: 75, 21.0: 80, 30.0: 90, 30.5: 100, -1.0: 100, None: 100}),
        ("price_product_rating", "rating", {3.49: 82, 3.5: 93, 4.4: 93, 4.45: 100, 4.5: 100, None: 100}),
        ("price_seasonal", "season", {"SUMMER": 105, "Summer": 100, "OFF": 80, "FESTIVAL": 108, "TRANSITIONAL": 93, "MONSOON": 100, None: 100}),
    ],
)
def test_band_edges(spark, column, field, expected):
    assert prices(spark, column, [row(**{field: v}) for v in expected]) == list(expected.values())


def test_lowest_price_floor_and_reason(spark):
    df = frame(spark, [
        row(days=1.0, rate=10),               # expiry 40 beats velocity 65
        row(days=1.0, rate=10, cost="60"),    # floor 63 above 40; the rule stays the reason
        row(days=50.0),                       # nothing fires: first rule is named
        row(price=None, days=1.0, cost="1"),  # no price: only the floor is left
    ])
    result, columns = banded.apply_banded_rules(df, rules(spark))
    assert columns == ALL
    got = [
        (r["raw_recommended_price"], r["floor_price"], r["recommended_price"], r["floor_bound"], r["markdown_reason"])
        for r in result.collect()
    ]
    assert got == [
        (40, 0, 40, False, "EXPIRY"),
        (40, 63, 63, True, "EXPIRY"),
        (100, 0, 100, False, "EXPIRY"),
        (None, Decimal("1.05"), Decimal("1.05"), None, "FLOOR_GUARDRAIL"),
    ]


def test_rule_subsets(spark):
    df = frame(spark, [row(days=1.0, trend=10)])
    for names, columns, price, reason in [
        (["EXPIRY"], ["price_expiry"], 40, "EXPIRY"),
        (["TRENDING", "EXPIRY"], ["price_expiry", "price_trending"], 40, "EXPIRY"),
        (["TRENDING"], ["price_trending"], 80, "TRENDING"),
        (["NOPE"], [], 100, "NO_RULE"),
        ([], ALL, 40, "EXPIRY"),
        (None, ALL, 40, "EXPIRY"),
    ]:
        result, found = banded.apply_banded_rules(df, rules(spark), names)
        assert found == columns
        r = result.first()
        assert (r["recommended_price"], r["markdown_reason"]) == (price, reason)


def test_names_are_values_not_sql(spark):
    df = frame(spark, [row(days=1.0)])
    _, found = banded.apply_banded_rules(df, rules(spark), ["x') OR (1=1"])
    assert found == []


def test_bad_rules_are_refused(spark):
    df = frame(spark, [row(days=1.0)])
    for band, message in [
        (("days_in_stock", "!=", 1.0, 1.0, None, 0.5), "unknown operator"),
        (("days_in_stock", "BETWEEN", None, 1.0, None, 0.5), "needs condition_min"),
        (("days_in_stock", "<", 1.0, None, None, 0.5), "needs condition_max"),
        (("days_in_stock", ">", 1.0, 1.0, None, None), "no multiplier"),
    ]:
        with pytest.raises(ValueError, match=message):
            banded.apply_banded_rules(df, one_rule(spark, band))


def test_all_operators(spark):
    for op, expected in {">=": [0, 1, 1], ">": [0, 0, 1], "<=": [1, 1, 0], "<": [1, 0, 0]}.items():
        df = frame(spark, [row(days=x) for x in (1.0, 2.0, 3.0)])
        result, _ = banded.apply_banded_rules(df, one_rule(spark, ("days_in_stock", op, 2.0, 2.0, None, 0.5)))
        assert [int(r["price_r"] == 50) for r in result.collect()] == expected


def test_multipliers_keep_all_their_decimals(spark):
    df = frame(spark, [row(price="1000", days=1.0), row(price="1000", days=9.0)])
    bands = [("days_in_stock", "<", 0.0, 5.0, None, 0.123456), ("days_in_stock", ">", 5.0, 0.0, None, 999.5)]
    result, _ = banded.apply_banded_rules(df, one_rule(spark, *bands))
    assert [r["price_r"] for r in result.collect()] == [Decimal("123.456"), 999500]


def test_wide_and_long_multipliers_are_exact(spark):
    df = frame(spark, [row(price="33.33", days=1.0), row(price="33.33", days=9.0)])
    bands = [("days_in_stock", "<", 0.0, 5.0, None, 0.1234567), ("days_in_stock", ">", 5.0, 0.0, None, 1000.5)]
    result, _ = banded.apply_banded_rules(df, one_rule(spark, *bands))
    assert [r["price_r"] for r in result.collect()] == [Decimal("4.114811811"), Decimal("33346.665")]


def test_usage_counts_each_row_once_per_rule(spark, work):
    from shelfwise.plans import queries as Q

    usage = Q.rules_grouped(work)
    counts = {r["rule_name"]: r["priced_rows"] for r in usage.collect()}
    # Of 6,000 lines 203 have no stock, so no sell-through rate.
    assert counts == {
        "EXPIRY": 4165, "SALES_VELOCITY": 5797, "SEASONAL": 3106, "COMPETITOR": 5274,
        "PRODUCT_RATING": 5853, "TRENDING": 6000,
    }


def test_signals(spark):
    df = spark.createDataFrame(
        [(Decimal("10"), Decimal("9"), 0, 5, Decimal("4.5"), 3),
         (Decimal("0"), Decimal("9"), 4, 1, None, None),
         (Decimal("3"), Decimal("2"), 7, 29, Decimal("1"), 4)],
        "Original_Price decimal(10,2), Competitor_Price decimal(10,2), Stock_Level int, "
        "Historical_Sales int, Customer_Ratings decimal(3,2), Days_In_Stock int",
    )
    assumed = banded.assumed_signals(df).collect()
    assert [r["sell_through_rate"] for r in assumed] == [None, 25, Decimal("414.29")]
    assert [r["competitor_gap_pct"] for r in assumed] == [10, None, Decimal("33.33")]
    assert {(r["days_in_stock"], r["trend_score"]) for r in assumed} == {(15.0, 50.0)}
    assert [r["unit_cost"] for r in assumed] == [6, 0, Decimal("1.8")]
    measured = banded.measured_signals(df.withColumnRenamed("Historical_Sales", "Units_Sold"))
    assert [r["days_in_stock"] for r in measured.collect()] == [3.0, None, 4.0]
    assert "Days_In_Stock" not in measured.columns  # replaced in place


def test_kpis(spark):
    df = spark.createDataFrame(
        [(Decimal("10"), Decimal("8.333333"), 3), (Decimal("0"), Decimal("0"), 3), (None, Decimal("1"), 1)],
        "original_price decimal(10,2), recommended_price decimal(18,6), units int",
    )
    got = [tuple(r)[3:] for r in pricing_kpis(df, "units").collect()]
    assert got[0] == (Decimal("16.7"), Decimal("30.00"), Decimal("25.00"), Decimal("5.00"))
    assert got[1] == (None, 0, 0, 0)
    assert got[2] == (None, None, 1, None)


cents = st.integers(1, 10_000_000).map(lambda c: Decimal(c) / 100)
row_values = st.tuples(
    cents,
    st.integers(0, 50_000_000).map(lambda c: Decimal(c) / 10000),
    st.one_of(st.none(), st.floats(-5, 60, allow_nan=False)),
    st.one_of(st.none(), st.integers(0, 20000).map(lambda c: Decimal(c) / 100)),
    st.sampled_from([None, "SUMMER", "WINTER", "OFF", "FESTIVAL", "TRANSITIONAL", "MONSOON"]),
    st.one_of(st.none(), st.integers(-10000, 10000).map(lambda c: Decimal(c) / 100)),
    st.one_of(st.none(), st.integers(0, 500).map(lambda c: Decimal(c) / 100)),
    st.one_of(st.none(), st.integers(0, 100)),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row_values, min_size=1, max_size=60))
def test_properties(spark, rows):
    result, columns = banded.apply_banded_rules(frame(spark, rows), rules(spark))
    for r in result.collect():
        every = [r[c] for c in columns]
        assert r["raw_recommended_price"] == min(every)
        assert r["recommended_price"] >= r["floor_price"]
        assert r["recommended_price"] == max(r["raw_recommended_price"], r["floor_price"])
        assert r["floor_price"] == r["unit_cost"] * Decimal("1.05")
        first = columns[every.index(min(every))]
        assert r["markdown_reason"] == first.removeprefix("price_").upper()
        assert all(p <= r["original_price"] * Decimal("1.10") for p in every)
