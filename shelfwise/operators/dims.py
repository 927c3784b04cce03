"""Dimension tables.

A builder comes in two steps: ``*_members`` reduces the sources to the distinct
natural keys (one shuffle of already combined values), and the dimension adds the
surrogate key and attributes to the stored members. ``all_members`` takes the members of
all six dimensions of sales in one pass. Values are cast to the dimension's type before
they are made distinct, so that two of them cannot become one member later.

Given the dimension as it was loaded (``known``), members keep the keys they have there.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions import classify
from shelfwise.functions.numbers import exact
from shelfwise.operators.joins import lookup
from shelfwise.operators.keys import keep_keys, number_members
from shelfwise.types import PRICE, RATING, TABLES

# Fixed value: the reason every markdown is recorded with.
MARKDOWN_REASON = "Dynamic Pricing Strategy"


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _both(
    retail_a: DataFrame, in_a: str, retail_b: DataFrame, in_b: str, member: str
) -> DataFrame:
    a = retail_a.select(F.col(in_a).alias(member))
    return a.unionByName(retail_b.select(F.col(in_b).alias(member)))


def category_members(retail_a: DataFrame, retail_b: DataFrame) -> DataFrame:
    return _both(retail_a, "category", retail_b, "category", "category_name").distinct()


def dim_category(members: DataFrame, known: DataFrame | None = None) -> DataFrame:
    return category_attributes(keep_keys(members, known, "category_key", ["category_name"]))


def category_attributes(keyed: DataFrame) -> DataFrame:
    return keyed.select(
        "category_key",
        "category_name",
        _null("string").alias("parent_category"),
        _null("string").alias("sub_category"),
    )


def brand_members(retail_a: DataFrame, retail_b: DataFrame) -> DataFrame:
    return _both(retail_a, "brand", retail_b, "brand", "brand_name").distinct()


def dim_brand(members: DataFrame, known: DataFrame | None = None) -> DataFrame:
    return brand_attributes(keep_keys(members, known, "brand_key", ["brand_name"]))


def brand_attributes(keyed: DataFrame) -> DataFrame:
    return keyed.select(
        "brand_key",
        "brand_name",
        _null("string").alias("brand_type"),
        _null("string").alias("country"),
    )


def season_members(retail_a: DataFrame, retail_b: DataFrame) -> DataFrame:
    return _both(retail_a, "season", retail_b, "season", "season_name").distinct()


def dim_season(members: DataFrame, known: DataFrame | None = None) -> DataFrame:
    return season_attributes(keep_keys(members, known, "season_key", ["season_name"]))


def season_attributes(keyed: DataFrame) -> DataFrame:
    name = F.col("season_name")
    return keyed.select(
        "season_key",
        "season_name",
        classify.season_month(name, 0).alias("start_month"),
        classify.season_month(name, 1).alias("end_month"),
    )


def markdown_members(retail_a: DataFrame, retail_b: DataFrame) -> DataFrame:
    """Every percentage of the four markdown columns of a and the one of b; the
    four columns become rows within one scan."""
    trials = F.array(*[F.col(f"markdown_{i}").cast(PRICE) for i in range(1, 5)])
    a = retail_a.select(F.explode(trials).alias("markdown_percentage"))
    b = retail_b.select(F.col("markdown_percentage").cast(PRICE).alias("markdown_percentage"))
    return a.unionByName(b).distinct()


def dim_markdown(members: DataFrame, known: DataFrame | None = None) -> DataFrame:
    return markdown_attributes(keep_keys(members, known, "markdown_key", ["markdown_percentage"]))


def markdown_attributes(keyed: DataFrame) -> DataFrame:
    pct = F.col("markdown_percentage")
    return keyed.select(
        "markdown_key",
        "markdown_percentage",
        classify.markdown_type(pct).alias("markdown_type"),
        F.lit(MARKDOWN_REASON).alias("markdown_reason"),
        classify.markdown_strategy(pct).alias("markdown_strategy"),
    )


def rating_members(retail_a: DataFrame, retail_b: DataFrame) -> DataFrame:
    ratings = _both(retail_a, "customer_ratings", retail_b, "customer_rating", "customer_rating")
    return (
        ratings.where(F.col("customer_rating").isNotNull())
        .select(F.col("customer_rating").cast(RATING).alias("customer_rating"))
        .distinct()
    )


def dim_customer_rating(members: DataFrame, known: DataFrame | None = None) -> DataFrame:
    return rating_attributes(keep_keys(members, known, "customer_rating_key", ["customer_rating"]))


def rating_attributes(keyed: DataFrame) -> DataFrame:
    return keyed.select(
        "customer_rating_key",
        "customer_rating",
        classify.rating_category(F.col("customer_rating")).alias("rating_category"),
    )


def promotion_members(retail_a: DataFrame) -> DataFrame:
    return retail_a.where(F.col("promotion_type").isNotNull()).select("promotion_type").distinct()


def dim_promotion(members: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per promotion type, so that facts joined on it keep their rows."""
    return promotion_attributes(keep_keys(members, known, "promotion_key", ["promotion_type"]))


def promotion_attributes(keyed: DataFrame) -> DataFrame:
    return keyed.select(
        "promotion_key",
        F.col("promotion_type").alias("promotion_name"),
        "promotion_type",
        classify.discount_type(F.col("promotion_type")).alias("discount_type"),
        _null("date").alias("start_date"),
        _null("date").alias("end_date"),
    )


class Dimension(NamedTuple):
    key: str
    natural: str
    kind: T.DataType
    attributes: Callable[[DataFrame], DataFrame]


#: The dimensions that are taken from the values of both sources.
DIMENSIONS = {
    "dim_category": Dimension("category_key", "category_name", T.StringType(), category_attributes),
    "dim_brand": Dimension("brand_key", "brand_name", T.StringType(), brand_attributes),
    "dim_season": Dimension("season_key", "season_name", T.StringType(), season_attributes),
    "dim_markdown": Dimension("markdown_key", "markdown_percentage", PRICE, markdown_attributes),
    "dim_customer_rating": Dimension("customer_rating_key", "customer_rating", RATING, rating_attributes),
    "dim_promotion": Dimension("promotion_key", "promotion_type", T.StringType(), promotion_attributes),
}
#: Those that have no member for a missing value.
_ONLY_KNOWN = ("dim_customer_rating", "dim_promotion")


def all_members(retail_a: DataFrame, retail_b: DataFrame) -> DataFrame:
    """The distinct members of all ``DIMENSIONS``: dimension, text, number (of which one is used).
    Each source is read once, and values are combined before one shuffle of all dimensions."""

    def entries(**columns: Sequence[str]) -> Column:
        out = []
        for name, values in columns.items():
            kind = DIMENSIONS[name].kind
            for c in values:
                value, text = F.col(c).cast(kind), isinstance(kind, T.StringType)
                pair = (value, _null("decimal(10,2)")) if text else (_null("string"), value.cast(PRICE))
                out.append(F.struct(F.lit(name).alias("dimension"), pair[0].alias("text"), pair[1].alias("number")))
        return F.inline(F.array(*out))

    shared = {"dim_category": ["category"], "dim_brand": ["brand"], "dim_season": ["season"]}
    trials = [f"markdown_{i}" for i in range(1, 5)]
    a = retail_a.select(entries(**shared, dim_markdown=trials, dim_customer_rating=["customer_ratings"], dim_promotion=["promotion_type"]))
    b = retail_b.select(entries(**shared, dim_markdown=["markdown_percentage"], dim_customer_rating=["customer_rating"]))
    known = ~F.col("dimension").isin(*_ONLY_KNOWN) | F.col("text").isNotNull() | F.col("number").isNotNull()
    return a.unionAll(b).where(known).distinct()


def number_all(members: DataFrame) -> DataFrame:
    """Keys 1..n within each dimension, in the order of the members; numbered side by side as one table."""
    numbered = number_members(members, "place", ["dimension", "text", "number"])
    starts = numbered.groupBy("dimension").agg(F.min("place").alias("_first"))
    return numbered.join(starts, "dimension").select(
        "dimension", (F.col("place") - F.col("_first") + 1).alias("key"), "text", "number"
    )


def members_of(numbered: DataFrame, name: str) -> DataFrame:
    """Key and natural key of one dimension's members."""
    d = DIMENSIONS[name]
    value = F.col("text" if isinstance(d.kind, T.StringType) else "number").cast(d.kind)
    return numbered.where(F.col("dimension") == name).select(F.col("key").alias(d.key), value.alias(d.natural))


def dimension(numbered: DataFrame, name: str, known: DataFrame | None = None) -> DataFrame:
    """One dimension from the numbered members of all."""
    d, found = DIMENSIONS[name], members_of(numbered, name)
    return d.attributes(found if known is None else keep_keys(found.drop(d.key), known, d.key, [d.natural]))


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of the DATE column ``full_date``."""
    day = F.col("full_date")
    return days.select(
        classify.date_key(day).alias("date_key"),
        day,
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.weekofyear(day).alias("week_of_year"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        classify.is_weekend(day).alias("is_weekend"),
    )


# Days that a task lists, and tasks that calendars of unknown length are dealt to.
_DAYS = 100_000
_TASKS = 32


# The calendar's default first and last day.
FIRST_DAY = dt.date(2024, 1, 1)
LAST_DAY = dt.date(2025, 12, 31)


def dim_date(
    spark: SparkSession, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY
) -> DataFrame:
    """Calendar of the given days."""
    days = max(0, (last - first).days + 1)
    numbers = spark.range(0, days, 1, max(1, -(-days // _DAYS)))
    return calendar(numbers.select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("full_date")))


def dim_date_of(df: DataFrame, column: str, *also: dt.date) -> DataFrame:
    """Calendar from the first to the last day found in a column or given besides."""
    day, more = F.col(column).cast("date"), [F.lit(d) for d in also]
    first, last = F.min(day), F.max(day)
    if more:
        first, last = F.least(first, *more), F.greatest(last, *more)
    span = df.agg(first.alias("first"), last.alias("last"))
    chunks = F.sequence(F.lit(0), F.floor(F.datediff("last", "first") / _DAYS).cast("int"))
    dealt = span.select("first", "last", F.explode(chunks).alias("chunk")).repartition(_TASKS, "chunk")
    start = F.date_add("first", F.col("chunk") * _DAYS)
    end = F.least(F.col("last"), F.date_add(start, _DAYS - 1))
    return calendar(dealt.select(F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).alias("full_date")))


def dim_customer(customers: DataFrame) -> DataFrame:
    """The source's own customer number is the key: no numbering, no shuffle.
    Gender, age group and city have no source and stay NULL."""
    number = F.col("customer_number").cast("bigint")
    return customers.select(
        number.alias("customer_key"),
        F.concat(F.lit("CUST"), number.cast("string")).alias("customer_id"),
        "customer_name",
        _null("string").alias("gender"),
        _null("string").alias("age_group"),
        _null("string").alias("city"),
        "state",
        "country",
    )


# The season every product is filed under, and cost as a share of price.
PRODUCT_SEASON_KEY = 1
COST_SHARE = "0.60"

PRODUCT_COLUMNS = ("product_id", "product_name", "category", "brand", "price")


def product_members(products: DataFrame) -> DataFrame:
    return products.select(*PRODUCT_COLUMNS).distinct()


def dim_product(
    members: DataFrame, category: DataFrame, brand: DataFrame, as_of: dt.datetime, known: DataFrame | None = None
) -> DataFrame:
    """Product master with category, brand and price class; cost is a share of price.
    Attributes without a source stay NULL."""
    first = number_members(members, "product_key", PRODUCT_COLUMNS) if known is None else members
    with_category = lookup(first, F.col("category"), category, "category_name", "category_key")
    keyed = lookup(with_category, F.col("brand"), brand, "brand_name", "brand_key")
    price = F.col("price").cast(PRICE)
    if known is not None:
        natural = ("product_id", "product_name", "category_key", "brand_key", "price")
        stored = known.withColumnRenamed("base_price", "price")
        keyed = keep_keys(keyed.withColumn("price", price).select(*natural).distinct(), stored, "product_key", natural)
    found = {
        "product_key": F.col("product_key"),
        "product_id": F.col("product_id"),
        "product_name": F.col("product_name"),
        "category_key": F.col("category_key"),
        "brand_key": F.col("brand_key"),
        "season_key": F.lit(PRODUCT_SEASON_KEY),
        "price_range_key": classify.price_range_key(price),
        "base_price": price,
        "cost_price": price * exact(COST_SHARE),
        "created_date": classify.moment(as_of),
    }
    return keyed.select(
        [
            found.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TABLES["dim_product"]
        ]
    )
