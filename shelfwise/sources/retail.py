"""Retail inputs derived from order tables.

``retail_base`` joins lineitem, part and orders once and ``retail_lines`` derives the
columns of both sources from it. ``retail_a`` (products with four trial markdowns and
pricing signals) and ``retail_b`` (products with one current markdown and return data)
are its two halves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.classify import first_match
from shelfwise.functions.numbers import exact
from shelfwise.types import COST, PRICE, RATING


def retail_base(lineitem: DataFrame, part: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order line with its product and order attributes.

    ``source`` is 'a' or 'b'. No join hints: sizes decide, and adaptive execution splits hot keys.
    """
    month = F.month("o_orderdate")
    priority = F.col("o_orderpriority")
    joined = (
        lineitem.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
            "l_extendedprice", "l_discount", "l_tax", "l_quantity",
        )
        .join(
            orders.select("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus"),
            F.col("l_orderkey") == F.col("o_orderkey"),
        )
        .join(
            part.select("p_partkey", "p_type", "p_brand", "p_size"),
            F.col("l_partkey") == F.col("p_partkey"),
        )
    )
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_id"),
        first_match(
            [
                (month.between(3, 6), F.lit("Summer")),
                (month.between(7, 9), F.lit("Monsoon")),
                (month.between(10, 12), F.lit("Festive")),
            ],
            F.lit("Winter"),
        ).alias("season"),
        (F.col("l_extendedprice").cast(PRICE) * exact("0.1")).cast(PRICE).alias("original_price"),
        F.col("l_discount").cast("decimal(4,2)").alias("disc"),
        F.col("l_tax").cast("decimal(4,2)").alias("tax"),
        F.col("l_quantity").cast("int").alias("qty"),
        ((F.col("p_size") - 1) * 6).cast("int").alias("stock_level"),
        F.when(
            F.col("l_orderkey") % 97 != 0,
            (1 + (F.col("l_orderkey") % 81).cast("decimal(5,0)") * exact("0.05")).cast(RATING),
        ).alias("customer_ratings"),
        first_match(
            [
                (priority == "1-URGENT", F.lit("Clearance")),
                (priority == "2-HIGH", F.lit("Bulk")),
                (priority == "3-MEDIUM", F.lit("Loyal")),
                ((priority == "5-LOW") & (F.col("o_orderstatus") == "P"), F.lit("Combo Offer")),
                (priority == "5-LOW", F.lit("Flat Discount")),
            ],
            F.lit(None).cast("string"),
        ).alias("promotion_type"),
        (exact("0.80") + month.cast("decimal(2,0)") * exact("0.05")).cast(PRICE).alias(
            "seasonality_factor"
        ),
        F.when(F.col("l_partkey") % 2 == 0, F.lit("a")).otherwise(F.lit("b")).alias("source"),
    )


SHARED = (
    "product_id", "category", "brand", "season", "original_price", "stock_level",
    "customer_ratings",
)
ONLY_A = (
    "competitor_price", "markdown_1", "markdown_2", "markdown_3", "markdown_4",
    "historical_sales", "sales_after_m1", "sales_after_m2", "sales_after_m3", "sales_after_m4",
    "optimal_discount", "promotion_type", "seasonality_factor", "return_rate", "days_in_stock",
    "trend_score", "unit_cost",
)
ONLY_B = ("current_price", "markdown_percentage", "is_returned", "return_reason")
# What the rule engines price by, known for the lines of both halves.
PRICING = (
    "competitor_price", "historical_sales", "promotion_type", "seasonality_factor",
    "days_in_stock", "trend_score", "unit_cost",
)


def retail_lines(base: DataFrame) -> DataFrame:
    """Both halves side by side, as they are stored: columns that only the other half
    has are NULL, which takes no room in a column file and no work to compute."""
    order, supp, part, line = (
        F.col(c) for c in ("l_orderkey", "l_suppkey", "l_partkey", "l_linenumber")
    )
    price, disc, qty = F.col("original_price"), F.col("disc"), F.col("qty")
    competitor = (80 + (order * 3 + supp) % 41).cast("decimal(5,0)")
    shifts = (order % 3 - 1, supp % 5 - 2, line % 4 - 1, part % 7 - 3)
    of_a = {
        "competitor_price": (price * competitor * exact("0.01")).cast(PRICE),
        **{f"markdown_{i}": (disc * (100 * i)).cast(PRICE) for i in range(1, 5)},
        "historical_sales": qty,
        **{
            f"sales_after_m{i}": (qty + shift).cast("int") for i, shift in enumerate(shifts, 1)
        },
        "optimal_discount": (F.col("tax") * 100).cast(PRICE),
        "promotion_type": F.col("promotion_type"),
        "seasonality_factor": F.col("seasonality_factor"),
        "return_rate": ((supp % 20).cast("decimal(2,0)") * exact("0.01")).cast(PRICE),
        "days_in_stock": ((order * 7 + line) % 45).cast("int"),
        "trend_score": (part % 101).cast("int"),
        "unit_cost": (price * exact("0.6")).cast(COST),
    }
    returned = F.col("l_returnflag") == "R"
    reason = first_match(
        [(line % 3 == 0, F.lit("Size Issue")), (line % 3 == 1, F.lit("Damaged"))],
        F.lit("Changed Mind"),
    )
    of_b = {
        "current_price": F.when(order % 10 != 0, (price * (1 - disc)).cast(PRICE)),
        "markdown_percentage": (disc * 300).cast(PRICE),
        "is_returned": F.when(returned, F.lit("true")).otherwise(F.lit("false")),
        "return_reason": F.when(returned, reason),
    }
    source = F.col("source")
    return base.select(
        *SHARED,
        *[(of_a[c] if c in PRICING else F.when(source == "a", of_a[c])).alias(c) for c in ONLY_A],
        *[F.when(source == "b", of_b[c]).alias(c) for c in ONLY_B],
        "source",
    )


def retail_priced(lines: DataFrame) -> DataFrame:
    """The lines of both halves with all that the rule engines price by."""
    return lines.select(*SHARED, *PRICING)


def retail_a(lines: DataFrame) -> DataFrame:
    """Half 'a': trial markdowns, sales after each, and pricing signals."""
    return lines.where(F.col("source") == "a").select(*SHARED, *ONLY_A)


def retail_b(lines: DataFrame) -> DataFrame:
    """Half 'b': one markdown, the current price where known, and returns."""
    renamed = {"stock_level": "stock_quantity", "customer_ratings": "customer_rating"}
    return lines.where(F.col("source") == "b").select(
        *[F.col(c).alias(renamed.get(c, c)) for c in SHARED], *ONLY_B
    )


def products(part: DataFrame) -> DataFrame:
    """Product master rows of both halves, before de-duplication."""
    return part.where("p_partkey is not null").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast(PRICE).alias("price"),
    )


def customers(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Customer attributes with their nation as state and region as country."""
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_number"),
            F.col("c_name").alias("customer_name"),
            F.col("n_name").alias("state"),
            F.col("r_name").alias("country"),
        )
    )
