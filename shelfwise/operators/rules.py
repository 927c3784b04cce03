"""Reading rule tables. Rules are metadata: they are fetched whole, once, in evaluation
order, and compiled to column expressions, so rows are never joined with rules. A rule
table has to fit the driver, as the expressions made from it do."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

def fetch_rules(rules: DataFrame, *order: Column | str) -> list[Row]:
    return rules.orderBy(*order).collect()


def select_rules(rules: DataFrame, rule_names: Sequence[str] | None = None) -> DataFrame:
    """The conditions of the named rules (all if none are named) in evaluation order."""
    chosen = rules.where(F.col("rule_name").isin(*rule_names)) if rule_names else rules
    return chosen.select(
        "rule_id",
        "rule_name",
        "trigger_column",
        "condition_operator",
        "condition_min",
        "condition_max",
        "condition_str_value",
        "price_multiplier",
        "discount_pct",
    ).orderBy(*BAND_ORDER)


# NULL bounds come first; the last two only settle the order of equal lower bounds.
BAND_ORDER = ("rule_id", "condition_min", "condition_max", "condition_str_value")
