"""Figures of a price recommendation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.numbers import percent_of
from shelfwise.types import AMOUNT, PERCENT_ONE


def pricing_kpis(df: DataFrame, units: str) -> DataFrame:
    """Add the discount in percent and the amounts before, after and between.

    The discount amount is the difference of the rounded amounts.
    """
    price, recommended, sold = F.col("original_price"), F.col("recommended_price"), F.col(units)
    return df.withColumns(
        {
            "discount_pct_applied": percent_of(price - recommended, price, PERCENT_ONE),
            "gross_amount": F.round(price * sold, 2).cast(AMOUNT),
            "net_amount": F.round(recommended * sold, 2).cast(AMOUNT),
        }
    ).withColumn(
        "discount_amount", (F.col("gross_amount") - F.col("net_amount")).cast(AMOUNT)
    )
