"""Column types and table schemas.

Money and rates are DECIMAL. Prices that a rule computed keep six decimals, so
that multiplying a two-decimal price by a rule multiplier stays exact.
"""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(10, 2)
VALUE = T.DecimalType(12, 2)
RATING = T.DecimalType(3, 2)
RULE_PRICE = T.DecimalType(18, 6)  # PRICE times a multiplier of four decimals
COST = T.DecimalType(12, 4)
BASELINE_PRICE = T.DecimalType(14, 4)
AMOUNT = T.DecimalType(20, 2)
PERCENT = T.DecimalType(14, 2)
PERCENT_ONE = T.DecimalType(18, 1)
SHARE = T.DecimalType(5, 2)
KEY = T.LongType()
COUNT = T.IntegerType()
NUMBER = T.DoubleType()
TEXT = T.StringType()
DAY = T.DateType()
MOMENT = T.TimestampNTZType()


def table(**columns: T.DataType) -> T.StructType:
    """Layout with nullable columns in the given order."""
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Raw inputs, as columns are called after name normalisation.
RETAIL_A = table(
    product_id=TEXT, category=TEXT, brand=TEXT, season=TEXT, original_price=PRICE,
    competitor_price=PRICE, markdown_1=PRICE, markdown_2=PRICE, markdown_3=PRICE,
    markdown_4=PRICE, historical_sales=COUNT, sales_after_m1=COUNT, sales_after_m2=COUNT,
    sales_after_m3=COUNT, sales_after_m4=COUNT, optimal_discount=PRICE, stock_level=COUNT,
    customer_ratings=RATING, promotion_type=TEXT, seasonality_factor=PRICE, return_rate=PRICE,
)
RETAIL_B = table(
    product_id=TEXT, category=TEXT, brand=TEXT, season=TEXT, original_price=PRICE,
    current_price=PRICE, markdown_percentage=PRICE, stock_quantity=COUNT, customer_rating=RATING,
    is_returned=TEXT, return_reason=TEXT,
)

# The table layouts a load has to produce.
TABLES: dict[str, T.StructType] = {
    "dim_category": table(
        category_key=KEY, category_name=TEXT, parent_category=TEXT, sub_category=TEXT,
    ),
    "dim_brand": table(brand_key=KEY, brand_name=TEXT, brand_type=TEXT, country=TEXT),
    "dim_season": table(season_key=KEY, season_name=TEXT, start_month=COUNT, end_month=COUNT),
    "dim_markdown": table(
        markdown_key=KEY, markdown_percentage=PRICE, markdown_type=TEXT, markdown_reason=TEXT,
        markdown_strategy=TEXT,
    ),
    "dim_price_range": table(
        price_range_key=KEY, min_price=PRICE, max_price=PRICE, price_segment=TEXT,
    ),
    "dim_stock_level": table(
        stock_level_key=KEY, stock_status=TEXT, stock_bucket=TEXT, reorder_flag=TEXT,
    ),
    "dim_customer_rating": table(
        customer_rating_key=KEY, customer_rating=RATING, rating_category=TEXT,
    ),
    "dim_promotion": table(
        promotion_key=KEY, promotion_name=TEXT, promotion_type=TEXT, discount_type=TEXT,
        start_date=DAY, end_date=DAY,
    ),
    "dim_store": table(
        store_key=KEY, store_name=TEXT, store_type=TEXT, city=TEXT, state=TEXT, country=TEXT,
    ),
    "dim_channel": table(channel_key=KEY, channel_name=TEXT, channel_type=TEXT, platform=TEXT),
    "dim_date": table(
        date_key=KEY, full_date=DAY, day=COUNT, month=COUNT, month_name=TEXT, quarter=COUNT,
        year=COUNT, week_of_year=COUNT, day_of_week=TEXT, is_weekend=TEXT,
    ),
    "dim_customer": table(
        customer_key=KEY, customer_id=TEXT, customer_name=TEXT, gender=TEXT, age_group=TEXT,
        city=TEXT, state=TEXT, country=TEXT,
    ),
    "dim_product": table(
        product_key=KEY, product_id=TEXT, product_name=TEXT, category_key=KEY, brand_key=KEY,
        season_key=KEY, price_range_key=KEY, supplier_name=TEXT, gender=TEXT, color=TEXT,
        size=TEXT, fabric_material=TEXT, cosmetic_type=TEXT, skin_type=TEXT, expiry_date=DAY,
        shelf_life_days=COUNT, base_price=PRICE, cost_price=PRICE, created_date=MOMENT,
    ),
    "fact_sales": table(
        sales_key=KEY, product_key=KEY, category_key=KEY, brand_key=KEY, season_key=KEY,
        markdown_key=KEY, customer_rating_key=KEY, price_range_key=KEY, stock_level_key=KEY,
        promotion_key=KEY, store_key=KEY, channel_key=KEY, date_key=KEY, original_price=PRICE,
        current_price=PRICE, markdown_percentage=PRICE, historical_sales=COUNT,
        sales_after_markdown=COUNT, revenue=VALUE, optimal_discount=PRICE,
        created_timestamp=MOMENT,
    ),
    "fact_inventory": table(
        inventory_key=KEY, product_key=KEY, category_key=KEY, brand_key=KEY, season_key=KEY,
        stock_level_key=KEY, store_key=KEY, date_key=KEY, stock_quantity=COUNT,
        stock_status=TEXT, reorder_required=TEXT, inventory_value=VALUE,
        created_timestamp=MOMENT,
    ),
    "fact_markdown_analytics": table(
        markdown_fact_key=KEY, product_key=KEY, category_key=KEY, brand_key=KEY, season_key=KEY,
        markdown_key=KEY, promotion_key=KEY, stock_level_key=KEY, customer_rating_key=KEY,
        date_key=KEY, markdown_1=PRICE, markdown_2=PRICE, markdown_3=PRICE, markdown_4=PRICE,
        optimal_discount=PRICE, historical_sales=COUNT, sales_after_m1=COUNT,
        sales_after_m2=COUNT, sales_after_m3=COUNT, sales_after_m4=COUNT,
        seasonality_factor=PRICE, return_rate=PRICE, markdown_effectiveness=TEXT,
        created_timestamp=MOMENT,
    ),
    "fact_customer_feedback": table(
        feedback_key=KEY, product_key=KEY, category_key=KEY, brand_key=KEY,
        customer_rating_key=KEY, markdown_key=KEY, date_key=KEY, customer_rating=RATING,
        is_returned=TEXT, return_reason=TEXT, feedback_category=TEXT, created_timestamp=MOMENT,
    ),
    "fact_sales_profit": table(
        sales_key=KEY, date_key=KEY, customer_key=KEY, product_key=KEY, store_key=KEY,
        promotion_key=KEY, markdown_key=KEY, stock_level_key=KEY, quantity_sold=COUNT,
        original_price=PRICE, discount_amount=PRICE, selling_price=PRICE, revenue=VALUE,
        cost_price=PRICE, profit=VALUE, payment_mode=TEXT, created_timestamp=MOMENT,
    ),
    "fact_markdown_uplift": table(
        markdown_fact_key=KEY, date_key=KEY, product_key=KEY, markdown_key=KEY,
        promotion_key=KEY, before_markdown_sales=VALUE, after_markdown_sales=VALUE,
        uplift_percentage=SHARE, inventory_clearance_rate=SHARE,
    ),
    "banded_rules": table(
        rule_id=COUNT, rule_name=TEXT, trigger_column=TEXT, condition_operator=TEXT,
        condition_min=NUMBER, condition_max=NUMBER, condition_str_value=TEXT,
        price_multiplier=NUMBER, discount_pct=NUMBER, created_by=TEXT, created_date=DAY,
    ),
    "priority_rules": table(
        rule_id=COUNT, rule_name=TEXT, condition=TEXT, discount_percentage=NUMBER,
        priority=COUNT,
    ),
    "product_trends": table(
        trend_id=COUNT, product_id=TEXT, trend_type=TEXT, trend_score=NUMBER,
        trend_direction=TEXT, trend_source=TEXT, trend_date=DAY,
    ),
}
