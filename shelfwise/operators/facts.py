"""Fact tables.

Each builder keeps the rows of its source: dimensions hold a member once, and all
lookups are left outer joins. The fact side is not shuffled as long as the
dimensions stay below Spark's broadcast threshold. Row ids are added when a fact
is loaded (see ``keys.with_row_id``), so builders return everything but them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import classify
from shelfwise.functions.numbers import exact
from shelfwise.operators.conform import conformed_inventory, conformed_sales
from shelfwise.operators.joins import lookup, range_lookup
from shelfwise.types import PRICE, RATING, TABLES

Dims = Mapping[str, DataFrame]

# Keys of facts whose source has no such attribute.
UNKNOWN_PROMOTION = 1
DEFAULT_STORE = 1
DEFAULT_CHANNEL = 1


def _typed(df: DataFrame, table: str, columns: Mapping[str, Column]) -> DataFrame:
    """The table's columns in order and type; its first one, the row id, is left out."""
    return df.select(
        [columns[f.name].cast(f.dataType).alias(f.name) for f in TABLES[table].fields[1:]]
    )


def _stamp(as_of: dt.datetime) -> dict[str, Column]:
    return {
        "product_key": F.lit(None),
        "date_key": classify.date_key(F.lit(as_of.date())),
        "created_timestamp": classify.moment(as_of),
    }


def _found(df: DataFrame) -> dict[str, Column]:
    return {c: F.col(c) for c in df.columns}


def by_category(df: DataFrame, dims: Dims) -> DataFrame:
    return lookup(df, F.col("category"), dims["dim_category"], "category_name", "category_key")


def by_brand(df: DataFrame, dims: Dims) -> DataFrame:
    return lookup(df, F.col("brand"), dims["dim_brand"], "brand_name", "brand_key")


def by_season(df: DataFrame, dims: Dims) -> DataFrame:
    return lookup(df, F.col("season"), dims["dim_season"], "season_name", "season_key")


def by_promotion(df: DataFrame, dims: Dims) -> DataFrame:
    return lookup(
        df, F.col("promotion_type"), dims["dim_promotion"], "promotion_type", "promotion_key"
    )


def by_rating(df: DataFrame, rating: str, dims: Dims) -> DataFrame:
    """The rating is cast to the dimension's type: equal decimals, not equal doubles."""
    return lookup(
        df,
        F.col(rating).cast(RATING),
        dims["dim_customer_rating"].withColumnRenamed("customer_rating", "_rating"),
        "_rating",
        "customer_rating_key",
    )


def by_markdown(df: DataFrame, pct: str, dims: Dims) -> DataFrame:
    return lookup(
        df,
        F.col(pct).cast(PRICE),
        dims["dim_markdown"].withColumnRenamed("markdown_percentage", "_pct"),
        "_pct",
        "markdown_key",
    )


def by_price_range(df: DataFrame, price: str, dims: Dims, *take: str) -> DataFrame:
    return range_lookup(
        df,
        F.col(price),
        dims["dim_price_range"],
        "min_price",
        "max_price",
        "price_range_key",
        *take,
    )


def by_stock_level(df: DataFrame, quantity: str, dims: Dims) -> DataFrame:
    """Stock levels are found by the label that the quantity is classified with;
    the label stays in the result as ``stock_status``."""
    labelled = df.withColumn("stock_status", classify.stock_status(F.col(quantity)))
    return lookup(
        labelled,
        F.col("stock_status"),
        dims["dim_stock_level"].withColumnRenamed("stock_status", "_status"),
        "_status",
        "stock_level_key",
    )


def fact_sales(
    retail_a: DataFrame, retail_b: DataFrame, dims: Dims, as_of: dt.datetime
) -> DataFrame:
    """Sales of both sources with seven dimension keys and revenue."""
    df = conformed_sales(retail_a, retail_b)
    df = by_category(df, dims)
    df = by_brand(df, dims)
    df = by_season(df, dims)
    df = by_rating(df, "customer_ratings", dims)
    df = by_markdown(df, "markdown_percentage", dims)
    df = by_price_range(df, "original_price", dims)
    df = by_stock_level(df, "stock_level", dims)
    price = F.coalesce("current_price", "original_price")
    return _typed(
        df,
        "fact_sales",
        _found(df)
        | _stamp(as_of)
        | {
            "promotion_key": F.lit(UNKNOWN_PROMOTION),
            "store_key": F.lit(DEFAULT_STORE),
            "channel_key": F.lit(DEFAULT_CHANNEL),
            "current_price": price,
            "revenue": price * F.col("sales_after_markdown"),
        },
    )


def fact_inventory(
    retail_a: DataFrame, retail_b: DataFrame, dims: Dims, as_of: dt.datetime
) -> DataFrame:
    """Stock of both sources with its level, reorder flag and value."""
    df = conformed_inventory(retail_a, retail_b)
    df = by_category(df, dims)
    df = by_brand(df, dims)
    df = by_season(df, dims)
    df = by_stock_level(df, "stock_quantity", dims)
    quantity = F.col("stock_quantity")
    return _typed(
        df,
        "fact_inventory",
        _found(df)
        | _stamp(as_of)
        | {
            "store_key": F.lit(DEFAULT_STORE),
            "reorder_required": classify.reorder_required(quantity),
            "inventory_value": quantity * F.col("original_price"),
        },
    )


def fact_markdown_analytics(retail_a: DataFrame, dims: Dims, as_of: dt.datetime) -> DataFrame:
    """Trial markdowns of source a, the sales after each, and their impact."""
    df = by_category(retail_a, dims)
    df = by_brand(df, dims)
    df = by_season(df, dims)
    df = by_markdown(df, "markdown_1", dims)
    df = by_promotion(df, dims)
    df = by_stock_level(df, "stock_level", dims)
    df = by_rating(df, "customer_ratings", dims)
    return _typed(
        df,
        "fact_markdown_analytics",
        _found(df)
        | _stamp(as_of)
        | {
            "markdown_effectiveness": classify.markdown_effectiveness(
                F.col("historical_sales"), F.col("sales_after_m2"), F.col("sales_after_m4")
            )
        },
    )


def fact_customer_feedback(retail_b: DataFrame, dims: Dims, as_of: dt.datetime) -> DataFrame:
    """Ratings and returns of source b."""
    df = by_category(retail_b, dims)
    df = by_brand(df, dims)
    df = by_rating(df, "customer_rating", dims)
    df = by_markdown(df, "markdown_percentage", dims)
    return _typed(
        df,
        "fact_customer_feedback",
        _found(df)
        | _stamp(as_of)
        | {"feedback_category": classify.feedback_category(F.col("customer_rating"))},
    )


# The product-level facts assume one sale of each product at a flat discount.
FLAT_DATE = dt.date(2025, 1, 1)
FLAT_DATE_KEY = 20250101
FLAT_DISCOUNT = "0.10"
FLAT_REMAINDER = "0.90"
FLAT_MARKDOWN_KEY = 1
FLAT_STOCK_LEVEL_KEY = 2
FLAT_PAYMENT_MODE = "Online"
FLAT_UPLIFT_PCT = "10.00"
FLAT_CLEARANCE_RATE = "70.00"


def fact_sales_profit(dim_product: DataFrame, as_of: dt.datetime) -> DataFrame:
    """One sale per product at a flat discount, with its profit."""
    base = F.col("base_price")
    selling = base * exact(FLAT_REMAINDER)
    return _typed(
        dim_product,
        "fact_sales_profit",
        {
            "date_key": F.lit(FLAT_DATE_KEY),
            "customer_key": F.lit(None),
            "product_key": F.col("product_key"),
            "store_key": F.lit(DEFAULT_STORE),
            "promotion_key": F.lit(None),
            "markdown_key": F.lit(FLAT_MARKDOWN_KEY),
            "stock_level_key": F.lit(FLAT_STOCK_LEVEL_KEY),
            "quantity_sold": F.lit(1),
            "original_price": base,
            "discount_amount": base * exact(FLAT_DISCOUNT),
            "selling_price": selling,
            "revenue": selling,
            "cost_price": F.col("cost_price"),
            "profit": selling - F.col("cost_price"),
            "payment_mode": F.lit(FLAT_PAYMENT_MODE),
            "created_timestamp": classify.moment(as_of),
        },
    )


def fact_markdown_uplift(dim_product: DataFrame) -> DataFrame:
    """Price of each product before and after the flat discount."""
    base = F.col("base_price")
    return _typed(
        dim_product,
        "fact_markdown_uplift",
        {
            "date_key": F.lit(FLAT_DATE_KEY),
            "product_key": F.col("product_key"),
            "markdown_key": F.lit(FLAT_MARKDOWN_KEY),
            "promotion_key": F.lit(None),
            "before_markdown_sales": base,
            "after_markdown_sales": base * exact(FLAT_REMAINDER),
            "uplift_percentage": exact(FLAT_UPLIFT_PCT),
            "inventory_clearance_rate": exact(FLAT_CLEARANCE_RATE),
        },
    )
