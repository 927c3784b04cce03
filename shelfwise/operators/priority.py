"""Discount by priority rules: predicates held as text, the first true one wins."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.classify import first_match
from shelfwise.functions.names import quote_bare_words
from shelfwise.functions.numbers import decimal_for, exact
from shelfwise.operators.rules import fetch_rules
from shelfwise.types import BASELINE_PRICE

# Fixed value: own price over the competitor's, where no own price is known.
BASELINE_FACTOR = "1.05"


def with_baseline_price(df: DataFrame) -> DataFrame:
    """Add ``Our_Price`` from the competitor's price, unless it is there."""
    if "our_price" in (c.lower() for c in df.columns):
        return df
    price = (F.col("Competitor_Price") * exact(BASELINE_FACTOR)).cast(BASELINE_PRICE)
    return df.withColumn("Our_Price", price)


def conditions_of(
    df: DataFrame, rules: Sequence[Row], words: Iterable[str] | None = None
) -> list[Column]:
    """The rules' predicates, checked against the columns of ``df`` in one analysis."""
    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    try:
        texts = [quote_bare_words(r["condition"], df.columns, strings, words) for r in rules]
    except ValueError as e:
        raise ValueError(f"rules: {e}") from e
    try:
        conditions = [F.expr(text) for text in texts]
        kinds = df.select([c.alias(f"c{i}") for i, c in enumerate(conditions)]).schema
    except AnalysisException as e:
        raise ValueError(f"{_culprit(df, rules, texts)}: {e}") from e
    for rule, text, kind in zip(rules, texts, kinds):
        if not isinstance(kind.dataType, T.BooleanType):
            raise ValueError(f"rule {rule['rule_name']!r}: {text!r} is not a condition")
    return conditions


def _culprit(df: DataFrame, rules: Sequence[Row], texts: Sequence[str]) -> str:
    """Which rule cannot be used; looked for only after an error."""
    for rule, text in zip(rules, texts):
        try:
            df.select(F.expr(text))
        except AnalysisException:
            return f"rule {rule['rule_name']!r}: cannot use {text!r}"
    return "rules cannot be used together"


def apply_priority_rules(
    df: DataFrame, rules: DataFrame, words: Iterable[str] | None = None
) -> DataFrame:
    """Add ``Optimal_Discount_Pct``: the percentage of the first rule, by priority,
    that holds for a row, and 0 if none does. A rule of 0 % also claims its rows.
    ``words``: what rule texts may compare with unquoted, any word if not given."""
    needed = rules.select("rule_id", "rule_name", "condition", "discount_percentage", "priority")
    fetched = fetch_rules(needed, "priority", "rule_id")
    kind = decimal_for([r["discount_percentage"] for r in fetched], whole=4, decimals=4)
    branches = [
        (condition, exact(r["discount_percentage"]).cast(kind))
        for condition, r in zip(conditions_of(df, fetched, words), fetched)
    ]
    return df.withColumn("Optimal_Discount_Pct", first_match(branches, exact(0).cast(kind)))


def with_markdown_amounts(df: DataFrame) -> DataFrame:
    """Add the amount taken off and the price left, both rounded to cents."""
    amount = F.round(F.col("Our_Price") * F.col("Optimal_Discount_Pct") * exact("0.01"), 2)
    marked = df.withColumn("Markdown_Amount", amount.cast("decimal(14,2)"))
    final = F.round(F.col("Our_Price") - F.col("Markdown_Amount"), 2)
    return marked.withColumn("Final_Marked_Down_Price", final.cast("decimal(14,2)"))
