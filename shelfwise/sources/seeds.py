"""Static tables: reference data and the two rule tables.

Seeds are built from Arrow, so Spark keeps them as a local relation of known
size (one task to read, and the planner can see that they are small).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shelfwise.types import TABLES

# Reference data of the static dimensions.
PRICE_RANGES = (
    (1, Decimal("0.00"), Decimal("500.00"), "Budget"),
    (2, Decimal("501.00"), Decimal("2000.00"), "Mid Range"),
    (3, Decimal("2001.00"), Decimal("10000.00"), "Premium"),
)
STOCK_LEVELS = (
    (1, "Low Stock", "0-50", "Yes"),
    (2, "Medium Stock", "51-200", "No"),
    (3, "Overstock", "201+", "No"),
)
STORES = (
    (1, "Online Store", "E-Commerce", "Pune", "Maharashtra", "India"),
    (2, "Fashion Retail Store", "Retail", "Mumbai", "Maharashtra", "India"),
    (3, "Cosmetics Outlet", "Retail", "Bangalore", "Karnataka", "India"),
)
CHANNELS = (
    (1, "Website", "Online", "Web"),
    (2, "Mobile App", "Digital", "Android/iOS"),
    (3, "Retail Store", "Offline", "Physical Store"),
)
TRENDS = (
    (1, "P101", "HIGH_TREND", 90.0, "UP", "SOCIAL_MEDIA"),
    (2, "P102", "LOW_TREND", 20.0, "DOWN", "SALES_PATTERN"),
    (3, "P103", "SEASONAL_TREND", 75.0, "UP", "FESTIVAL"),
)

# Banded rules as
# (id, rule, trigger, operator, min, max, text, multiplier, discount %).
BANDED_RULES = (
    (1, "EXPIRY", "days_in_stock", "BETWEEN", 0, 2, None, 0.40, 60),
    (1, "EXPIRY", "days_in_stock", "BETWEEN", 3, 7, None, 0.55, 45),
    (1, "EXPIRY", "days_in_stock", "BETWEEN", 8, 14, None, 0.75, 25),
    (1, "EXPIRY", "days_in_stock", "BETWEEN", 15, 21, None, 0.80, 20),
    (1, "EXPIRY", "days_in_stock", "BETWEEN", 22, 30, None, 0.90, 10),
    (2, "SALES_VELOCITY", "sell_through_rate", "<", 0, 20, None, 0.65, 35),
    (2, "SALES_VELOCITY", "sell_through_rate", "BETWEEN", 20, 40, None, 0.80, 20),
    (2, "SALES_VELOCITY", "sell_through_rate", "BETWEEN", 40, 70, None, 0.90, 10),
    (2, "SALES_VELOCITY", "sell_through_rate", ">", 70, -1, None, 1.00, 0),
    (3, "SEASONAL", "Season", "=", None, None, "SUMMER", 1.05, -5),
    (3, "SEASONAL", "Season", "=", None, None, "WINTER", 1.05, -5),
    (3, "SEASONAL", "Season", "=", None, None, "OFF", 0.80, 20),
    (3, "SEASONAL", "Season", "=", None, None, "FESTIVAL", 1.08, -8),
    (3, "SEASONAL", "Season", "=", None, None, "TRANSITIONAL", 0.93, 7),
    (4, "COMPETITOR", "competitor_gap_pct", "<", -100, -10, None, 1.05, -5),
    (4, "COMPETITOR", "competitor_gap_pct", "BETWEEN", -5, 5, None, 1.00, 0),
    (4, "COMPETITOR", "competitor_gap_pct", "BETWEEN", 5, 15, None, 0.93, 7),
    (4, "COMPETITOR", "competitor_gap_pct", ">", 15, -1, None, 0.82, 18),
    (5, "PRODUCT_RATING", "product_rating", ">=", 4.5, -1, None, 1.00, 0),
    (5, "PRODUCT_RATING", "product_rating", "BETWEEN", 3.5, 4.4, None, 0.93, 7),
    (5, "PRODUCT_RATING", "product_rating", "<", 0, 3.5, None, 0.82, 18),
    (6, "TRENDING", "trend_score", ">", 80, -1, None, 1.10, -10),
    (6, "TRENDING", "trend_score", "BETWEEN", 50, 80, None, 1.00, 0),
    (6, "TRENDING", "trend_score", "BETWEEN", 20, 50, None, 0.90, 10),
    (6, "TRENDING", "trend_score", "<", 0, 20, None, 0.80, 20),
)

# Priority rules as (id, rule, condition, discount %, priority).
PRIORITY_RULES = (
    (1, "Expiry_Clearance_Critical", "Stock_Level > 100 AND Customer_Ratings < 3.0", 60.0, 1),
    (2, "Competitor_Match", "Our_Price > Competitor_Price", 15.0, 2),
    (3, "Seasonality_Off_Season", "Seasonality_Factor < 1.0", 20.0, 3),
    (4, "Customer_Bulk_Discount", "Promotion_Type = 'Bulk'", 10.0, 4),
    (5, "Product_Performance_Low", "Customer_Ratings < 3.0", 25.0, 5),
    (6, "Product_Performance_High", "Customer_Ratings >= 4.5", 0.0, 6),
    (7, "Customer_Loyalty_Pricing", "Promotion_Type = 'Loyal'", 5.0, 7),
)


def rows_to_df(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """Literal rows as a DataFrame, by position; for metadata-sized inputs."""
    rows = list(rows)
    arrow = to_arrow_schema(schema)
    columns = [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema=schema)


def dim_price_range(spark: SparkSession) -> DataFrame:
    return rows_to_df(spark, PRICE_RANGES, TABLES["dim_price_range"])


def dim_stock_level(spark: SparkSession) -> DataFrame:
    return rows_to_df(spark, STOCK_LEVELS, TABLES["dim_stock_level"])


def dim_store(spark: SparkSession) -> DataFrame:
    return rows_to_df(spark, STORES, TABLES["dim_store"])


def dim_channel(spark: SparkSession) -> DataFrame:
    return rows_to_df(spark, CHANNELS, TABLES["dim_channel"])


def product_trends(spark: SparkSession, as_of: dt.date) -> DataFrame:
    return rows_to_df(spark, [(*r, as_of) for r in TRENDS], TABLES["product_trends"])


def banded_rules(spark: SparkSession, as_of: dt.date, created_by: str = "system") -> DataFrame:
    return rows_to_df(
        spark, [(*r, created_by, as_of) for r in BANDED_RULES], TABLES["banded_rules"]
    )


def priority_rules(spark: SparkSession) -> DataFrame:
    return rows_to_df(spark, PRIORITY_RULES, TABLES["priority_rules"])
