"""Both retail sources in one layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.types import PRICE


def conformed_sales(retail_a: DataFrame, retail_b: DataFrame) -> DataFrame:
    """Sales lines of both sources. Source a knows no current price; source b no
    sales history: it counts one sale per row and takes its markdown as optimal."""
    a = retail_a.select(
        "product_id", "category", "brand", "season", "original_price",
        F.lit(None).cast(PRICE).alias("current_price"),
        F.col("markdown_1").alias("markdown_percentage"),
        "historical_sales",
        F.col("sales_after_m1").alias("sales_after_markdown"),
        "optimal_discount", "stock_level", "customer_ratings",
    )
    b = retail_b.select(
        "product_id", "category", "brand", "season", "original_price", "current_price",
        "markdown_percentage",
        F.lit(0).alias("historical_sales"),
        F.lit(1).alias("sales_after_markdown"),
        F.col("markdown_percentage").alias("optimal_discount"),
        F.col("stock_quantity").alias("stock_level"),
        F.col("customer_rating").alias("customer_ratings"),
    )
    return a.unionByName(b)


def conformed_inventory(retail_a: DataFrame, retail_b: DataFrame) -> DataFrame:
    """Stock lines of both sources."""
    shared = ("product_id", "category", "brand", "season")
    a = retail_a.select(*shared, F.col("stock_level").alias("stock_quantity"), "original_price")
    return a.unionByName(retail_b.select(*shared, "stock_quantity", "original_price"))
