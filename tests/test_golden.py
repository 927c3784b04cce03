"""Counts known beforehand for the smallest test data."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import facts
from shelfwise.plans import queries as Q


def counted(df, column):
    return {r[0]: r[1] for r in df.groupBy(column).count().collect()}


def test_source_rows(work):
    assert (work.retail_a.count(), work.retail_b.count()) == (2968, 3032)


@pytest.mark.parametrize(
    "dim, rows",
    [("dim_category", 6), ("dim_brand", 25), ("dim_season", 4), ("dim_promotion", 5),
     ("dim_markdown", 25), ("dim_customer_rating", 81), ("dim_product", 200)],
)
def test_dimension_rows(work, dim, rows):
    assert getattr(work, dim).count() == rows


def test_facts_keep_their_source_rows(work):
    args = (work.dims, work.as_of)
    a, b = work.retail_a, work.retail_b
    assert facts.fact_sales(a, b, *args).count() == 6000
    assert facts.fact_inventory(a, b, *args).count() == 6000
    assert facts.fact_markdown_analytics(a, *args).count() == 2968
    assert facts.fact_customer_feedback(b, *args).count() == 3032


def test_bands(work):
    assert counted(Q.price_band_join(work), "price_segment") == {
        "Budget": 254, "Mid Range": 847, "Premium": 4617, None: 282
    }
    assert counted(Q.stock_level_join(work), "stock_status") == {
        "Low Stock": 1502, "Medium Stock": 2803, "Overstock": 1695
    }
    assert counted(Q.markdown_effectiveness(work), "markdown_effectiveness") == {
        "High Impact": 1267, "Moderate Impact": 673, "Low Impact": 1028
    }
    assert counted(Q.feedback_bands(work), "feedback_category") == {
        "Negative Feedback": 797, "Neutral Feedback": 1465, "Positive Feedback": 770
    }


def test_priority_discounts(work):
    own = counted(Q.priority_rules_own_price(work), "Optimal_Discount_Pct")
    # 60, 15, 20, 10, 25, 5 % by one rule each; 0 % by rule 6 (214 rows) or no rule (479).
    assert {float(k): v for k, v in own.items()} == {
        60: 1613, 15: 2095, 20: 610, 10: 404, 25: 409, 5: 176, 0: 693
    }
    fallback = counted(Q.priority_rules_fallback(work), "Optimal_Discount_Pct")
    assert {float(k): v for k, v in fallback.items()} == {60: 1613, 15: 4387}


def test_banded_reasons(work):
    rows = Q.banded_recommendation(work).groupBy("markdown_reason").agg(
        F.count("*").alias("n"), F.count_if("floor_bound").alias("bound")
    ).collect()
    assert Counter({r[0]: r[1] for r in rows}) == {
        "EXPIRY": 2130, "SALES_VELOCITY": 3210, "COMPETITOR": 83, "PRODUCT_RATING": 368, "TRENDING": 209
    }
    assert {r[0]: r[2] for r in rows if r[2]} == {"EXPIRY": 1062}
