from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfwise.functions.names import normalize_names, quote_bare_words
from shelfwise.operators.priority import (
    apply_priority_rules,
    with_baseline_price,
    with_markdown_amounts,
)
from shelfwise.sources.seeds import priority_rules, rows_to_df
from shelfwise.types import TABLES

COLUMNS = (
    "Our_Price decimal(10,2), Competitor_Price decimal(10,2), Stock_Level int, "
    "Customer_Ratings decimal(3,2), Seasonality_Factor decimal(10,2), Promotion_Type string"
)


def priced(spark, *rows):
    d = Decimal
    data = [(d(o), d(c), s, None if r is None else d(r), d(f), p) for o, c, s, r, f, p in rows]
    return spark.createDataFrame(data, COLUMNS)


def rules(spark, *rows):
    return rows_to_df(
        spark, [(i, f"r{i}", text, pct, pri) for i, (text, pct, pri) in enumerate(rows)],
        TABLES["priority_rules"],
    )


def discounts(df, table):
    return [float(r[0]) for r in apply_priority_rules(df, table).select("Optimal_Discount_Pct").collect()]


def test_first_rule_by_priority_wins(spark):
    df = priced(
        spark,
        ("10", "9", 101, "2.9", "0.9", "Bulk"),
        ("10", "9", 100, "2.9", "0.9", "Bulk"),
        ("10", "10", 100, "2.9", "0.9", "Bulk"),
        ("10", "10", 100, "2.9", "1.0", "Bulk"),
        ("10", "10", 100, "2.9", "1.0", None),
        ("10", "10", 100, "4.5", "1.0", "Loyal"),
        ("10", "10", 100, "4.4", "1.0", "Loyal"),
        ("10", "10", 100, None, "1.0", None),
    )
    assert discounts(df, priority_rules(spark)) == [60, 15, 20, 10, 25, 0, 5, 0]


def test_table_order_does_not_matter(spark):
    df = priced(spark, ("10", "9", 101, "2.9", "0.9", "Bulk"))
    table = rules(spark, ("Stock_Level > 1", 5.0, 9), ("Stock_Level > 100", 7.5, 2))
    assert discounts(df, table) == [7.5]


def test_percentages_keep_all_their_decimals(spark):
    df = priced(spark, ("10", "9", 101, "2.9", "0.9", "Bulk"))
    assert discounts(df, rules(spark, ("Stock_Level > 1", 12.345678, 1), ("true", 1.0, 2))) == [12.345678]


def test_no_rules(spark):
    df = priced(spark, ("10", "9", 101, "2.9", "0.9", "Bulk"))
    assert discounts(df, rules(spark)) == [0]


def test_bare_words_are_quoted(spark):
    df = priced(spark, ("10", "9", 1, "5", "1", "Bulk"))
    assert discounts(df, rules(spark, ("Promotion_Type = Bulk", 10.0, 1))) == [10]
    columns = df.columns
    assert quote_bare_words("a = Loyal AND b='x = Bulk'", columns) == "a = 'Loyal' AND b='x = Bulk'"
    assert quote_bare_words("Our_Price = competitor_price", columns) == "Our_Price = competitor_price"
    assert quote_bare_words("flag = true OR x = lower(y)", columns) == "flag = true OR x = lower(y)"
    assert quote_bare_words('a = "x = Bulk" AND day = current_date', columns) == (
        'a = "x = Bulk" AND day = current_date'
    )
    assert quote_bare_words("a <> Regular", columns) == "a <> 'Regular'"


def test_unusable_rules_fail_before_a_job_runs(spark):
    df = priced(spark, ("10", "9", 1, "5", "1", "Bulk"))
    with pytest.raises(ValueError, match="r0.*Shelf_Life"):
        apply_priority_rules(df, rules(spark, ("Shelf_Life > 3", 1.0, 1)))
    with pytest.raises(ValueError, match="not a condition"):
        apply_priority_rules(df, rules(spark, ("Stock_Level + 1", 1.0, 1)))


def test_misspelled_columns_are_no_words(spark):
    df = priced(spark, ("10", "9", 1, "5", "1", "Bulk"))
    with pytest.raises(ValueError, match="Competitor_Prize"):
        apply_priority_rules(df, rules(spark, ("Our_Price = Competitor_Prize", 1.0, 1)))
    with pytest.raises(ValueError, match="Othr"):
        apply_priority_rules(df, rules(spark, ("Promotion_Type = Othr", 1.0, 1)), words=["Bulk", "Loyal"])


def test_large_tables_and_percentages(spark):
    df = priced(spark, ("10", "9", 101, "2.9", "0.9", "Bulk"))
    many = [(f"Stock_Level > {3000 - i}", float(i), i) for i in range(2000)]
    assert discounts(df, rules(spark, *many, ("true", 12345.0, 5000))) == [12345]


def test_amounts_are_rounded_half_up(spark):
    df = priced(spark, ("0.10", "9", 1, "5", "1", "Loyal"), ("10.10", "9", 1, "5", "1", "Loyal"))
    marked = with_markdown_amounts(df.withColumn("Optimal_Discount_Pct", F.lit(Decimal("5.0000"))))
    got = [tuple(r) for r in marked.select("Markdown_Amount", "Final_Marked_Down_Price").collect()]
    # 0.005 -> 0.01; 0.505 -> 0.51
    assert got == [(Decimal("0.01"), Decimal("0.09")), (Decimal("0.51"), Decimal("9.59"))]


def test_baseline_price_only_where_absent(spark):
    df = priced(spark, ("10", "8", 1, "5", "1", None))
    assert with_baseline_price(df) is df
    assert with_baseline_price(df.withColumnRenamed("Our_Price", "OUR_PRICE")).columns[0] == "OUR_PRICE"
    assert with_baseline_price(df.drop("Our_Price")).first()["Our_Price"] == Decimal("8.4000")


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], "`Product ID` int, Stock int")
    assert normalize_names(df).columns == ["product_id", "stock"]
    assert normalize_names(df, lower=False).columns == ["Product_ID", "Stock"]
    with pytest.raises(ValueError, match="share a name"):
        normalize_names(spark.createDataFrame([(1, 2)], "`a b` int, a_b int"))
