"""Band labels as column expressions.

Bands are ``(highest value, label)`` pairs in ascending order. Values above the
last bound, and NULLs, get the label given as ``above``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band bounds and labels.
MARKDOWN_TYPE = ((10, "Low Discount"), (30, "Medium Discount"))
MARKDOWN_TYPE_ABOVE = "High Discount"
MARKDOWN_STRATEGY = ((10, "Profit Optimization"), (30, "Sales Boost"))
MARKDOWN_STRATEGY_ABOVE = "Inventory Clearance"
RATING_CATEGORY = ((2, "Poor"), (3, "Average"), (4, "Good"))
RATING_CATEGORY_ABOVE = "Excellent"
FEEDBACK_CATEGORY = ((2, "Negative Feedback"), (4, "Neutral Feedback"))
FEEDBACK_CATEGORY_ABOVE = "Positive Feedback"
STOCK_STATUS = ((50, "Low Stock"), (200, "Medium Stock"))
STOCK_STATUS_ABOVE = "Overstock"
REORDER = ((50, "Yes"),)
REORDER_ABOVE = "No"
PRICE_RANGE_KEY = ((500, 1), (2000, 2))
PRICE_RANGE_KEY_ABOVE = 3
SEASON_MONTHS = {"summer": (3, 6), "monsoon": (7, 9), "winter": (10, 2), "festive": (10, 12)}
DISCOUNT_TYPE = (
    ("discount", "Percentage"),
    ("clearance", "Inventory Clearance"),
    ("combo", "Combo Offer"),
)
DISCOUNT_TYPE_OTHER = "General Promotion"
WEEKEND_DAYS = (1, 7)


def first_match(branches: Sequence[tuple[Column, Column]], otherwise: Column) -> Column:
    """``CASE`` over (condition, result) pairs; the first true condition wins."""
    if not branches:
        return otherwise
    case = F.when(*branches[0])
    for condition, result in branches[1:]:
        case = case.when(condition, result)
    return case.otherwise(otherwise)


def up_to(value: Column, bands: Sequence[tuple[float, object]], above: object) -> Column:
    """Label of the first band whose upper bound the value does not exceed."""
    return first_match([(value <= bound, F.lit(name)) for bound, name in bands], F.lit(above))


def markdown_type(pct: Column) -> Column:
    return up_to(pct, MARKDOWN_TYPE, MARKDOWN_TYPE_ABOVE)


def markdown_strategy(pct: Column) -> Column:
    return up_to(pct, MARKDOWN_STRATEGY, MARKDOWN_STRATEGY_ABOVE)


def rating_category(rating: Column) -> Column:
    return up_to(rating, RATING_CATEGORY, RATING_CATEGORY_ABOVE)


def feedback_category(rating: Column) -> Column:
    return up_to(rating, FEEDBACK_CATEGORY, FEEDBACK_CATEGORY_ABOVE)


def stock_status(quantity: Column) -> Column:
    return up_to(quantity, STOCK_STATUS, STOCK_STATUS_ABOVE)


def reorder_required(quantity: Column) -> Column:
    return up_to(quantity, REORDER, REORDER_ABOVE)


def price_range_key(price: Column) -> Column:
    """Gap-free price classes; a price outside the price range table still gets one."""
    return up_to(price, PRICE_RANGE_KEY, PRICE_RANGE_KEY_ABOVE).cast("bigint")


def season_month(season: Column, which: int) -> Column:
    """First (``which=0``) or last (``which=1``) month of a season, by name without case."""
    return first_match(
        [(F.lower(season) == name, F.lit(m[which])) for name, m in SEASON_MONTHS.items()],
        F.lit(None).cast("int"),
    )


def discount_type(promotion: Column) -> Column:
    """Kind of discount by the first word found in the promotion's name."""
    return first_match(
        [(F.lower(promotion).contains(word), F.lit(name)) for word, name in DISCOUNT_TYPE],
        F.lit(DISCOUNT_TYPE_OTHER),
    )


def is_weekend(day: Column) -> Column:
    return F.when(F.dayofweek(day).isin(*WEEKEND_DAYS), F.lit("Yes")).otherwise(F.lit("No"))


def markdown_effectiveness(before: Column, after_2: Column, after_4: Column) -> Column:
    """Deepest markdown that raised sales decides the impact."""
    return first_match(
        [(after_4 > before, F.lit("High Impact")), (after_2 > before, F.lit("Moderate Impact"))],
        F.lit("Low Impact"),
    )


def date_key(day: Column) -> Column:
    """Date as a ``yyyyMMdd`` number."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def moment(clock: dt.datetime) -> Column:
    """A clock time as a literal; the same in every session time zone."""
    return F.lit(clock.isoformat(sep=" ")).cast("timestamp_ntz")
