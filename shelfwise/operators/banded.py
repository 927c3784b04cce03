"""Price recommendation by banded rules.

A rule is a list of bands on one trigger column, each with a price multiplier.
Within a rule the first matching band sets the rule's price; between rules the
lowest price wins; a cost floor bounds the result from below.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.classify import first_match
from shelfwise.functions.numbers import MAX_DIGITS, decimal_for, exact, percent_of
from shelfwise.operators import joined_bands
from shelfwise.operators.rules import BAND_ORDER, fetch_rules, select_rules
from shelfwise.sources.seeds import rows_to_df
from shelfwise.types import COST, PERCENT, RULE_PRICE

# Floor over unit cost, and signals of inputs that do not carry them.
FLOOR_FACTOR = "1.05"
ASSUMED_DAYS_IN_STOCK = 15.0
ASSUMED_TREND_SCORE = 50.0
ASSUMED_COST_SHARE = "0.6"
#: Rule tables with more bands are looked up as data instead of compiled to expressions.
COMPILED = 500
# Reasons that are no rule's name.
FLOOR_REASON = "FLOOR_GUARDRAIL"
NO_RULE_REASON = "NO_RULE"


def _rates(units: str) -> dict[str, Column]:
    price = F.col("original_price")
    return {
        "sell_through_rate": percent_of(F.col(units), F.col("stock_level"), PERCENT),
        "competitor_gap_pct": percent_of(price - F.col("competitor_price"), price, PERCENT),
    }


def assumed_signals(df: DataFrame) -> DataFrame:
    """Signals of a sales history without stock age, trend and cost: those three
    are assumed, the rating is the customers' and sold units are past sales."""
    return df.withColumns(
        _rates("historical_sales")
        | {
            "days_in_stock": F.lit(ASSUMED_DAYS_IN_STOCK),
            "product_rating": F.col("customer_ratings"),
            "trend_score": F.lit(ASSUMED_TREND_SCORE),
            "unit_cost": (F.col("original_price") * exact(ASSUMED_COST_SHARE)).cast(COST),
        }
    )


def measured_signals(df: DataFrame) -> DataFrame:
    """Signals of an input with ``units_sold``, ``days_in_stock``, ``product_rating``,
    ``trend_score`` and ``unit_cost`` columns."""
    return df.withColumns(
        _rates("units_sold") | {"days_in_stock": F.col("days_in_stock").cast("double")}
    )


def _bound(rule: Row, side: str) -> Column:
    if rule[side] is None:
        raise ValueError(f"rule {rule['rule_name']!r}: {rule['condition_operator']} needs {side}")
    value = rule[side]
    return F.lit(int(value)) if value == int(value) else exact(value)


# Which operand an operator reads; the other one holds a dummy and is ignored.
_OPERATORS: dict[str, Callable[[Column, Row], Column]] = {
    "BETWEEN": lambda c, r: c.between(_bound(r, "condition_min"), _bound(r, "condition_max")),
    ">": lambda c, r: c > _bound(r, "condition_min"),
    ">=": lambda c, r: c >= _bound(r, "condition_min"),
    "<": lambda c, r: c < _bound(r, "condition_max"),
    "<=": lambda c, r: c <= _bound(r, "condition_max"),
    "=": lambda c, r: c == F.lit(r["condition_str_value"]),
}


def band_condition(rule: Row) -> Column:
    """The predicate of one band."""
    build = _OPERATORS.get(rule["condition_operator"])
    if build is None:
        raise ValueError(
            f"rule {rule['rule_name']!r}: unknown operator {rule['condition_operator']!r}"
        )
    return build(F.col(rule["trigger_column"]), rule)


def bands_by_rule(
    rules: DataFrame, rule_names: Sequence[str] | None = None
) -> dict[str, list[Row]]:
    """Bands of each selected rule; rules and bands in evaluation order."""
    return _grouped(fetch_rules(select_rules(rules, rule_names), *BAND_ORDER))


def _grouped(rows: Sequence[Row]) -> dict[str, list[Row]]:
    grouped: dict[str, list[Row]] = {}
    for row in rows:
        if row["price_multiplier"] is None:
            raise ValueError(f"rule {row['rule_name']!r}: a band has no multiplier")
        grouped.setdefault(row["rule_name"], []).append(row)
    _check_names(list(grouped))
    return grouped


def _check_names(names: Sequence[str]) -> None:
    if len({_price_column(name) for name in names}) < len(names):
        raise ValueError(f"rule names differ only in case: {sorted(names)}")


def _price_column(rule_name: str) -> str:
    return f"price_{rule_name.lower()}"


def rule_multiplier(bands: Sequence[Row]) -> Column:
    """Multiplier of the first matching band, 1 where none matches."""
    kind = decimal_for([r["price_multiplier"] for r in bands], whole=3, decimals=4)
    return first_match(
        [(band_condition(r), exact(r["price_multiplier"]).cast(kind)) for r in bands],
        exact(1).cast(kind),
    )


def rule_prices(df: DataFrame, bands: dict[str, list[Row]]) -> DataFrame:
    """Add one ``price_<rule>`` column per rule; where no band matches, the price stays.

    A rule multiplies once, after its band is found. That keeps the generated code
    of all rules together within what the JVM compiles.
    """
    price = F.col("original_price")
    products = df.select(
        [(price * rule_multiplier(rows)).alias(_price_column(name)) for name, rows in bands.items()]
    )
    return df.withColumns(
        {
            _price_column(name): (price * rule_multiplier(rows)).cast(
                _rule_price(products.schema[_price_column(name)].dataType)
            )
            for name, rows in bands.items()
        }
    )


def joined_rule_prices(
    df: DataFrame, rules: DataFrame, rule_names: Sequence[str] | None = None
) -> tuple[DataFrame, list[str]]:
    """The columns that ``rule_prices`` adds, from bands that are joined as data, and the rules' names."""
    found = joined_bands.described(rules, rule_names)
    names = [rule.name for rule in found]
    _check_names(names)
    banded, multipliers = joined_bands.with_multipliers(df, rules, found)
    price, columns = F.col("original_price"), [F.col(f"`{c}`") for c in df.columns]
    for rule, multiplier in zip(found, multipliers, strict=True):
        scale = max(4, rule.decimals)
        kind = T.DecimalType(min(MAX_DIGITS, max(3, rule.whole) + scale), scale)
        product = price * F.coalesce(multiplier, F.lit(1)).cast(kind)
        to = _rule_price(banded.select(product.alias("product")).schema["product"].dataType)
        columns.append(product.cast(to).alias(_price_column(rule.name)))
    return banded.select(columns), names


def _rule_price(product: T.DataType) -> T.DecimalType:
    """RULE_PRICE, or wider if the product of price and multiplier has more digits."""
    if not isinstance(product, T.DecimalType):
        return RULE_PRICE
    scale = max(RULE_PRICE.scale, product.scale)
    whole = max(RULE_PRICE.precision - RULE_PRICE.scale, product.precision - product.scale - 1)
    return T.DecimalType(min(MAX_DIGITS, whole + scale), scale)


def apply_banded_rules(
    df: DataFrame, rules: DataFrame, rule_names: Sequence[str] | None = None, joined: bool | None = None
) -> tuple[DataFrame, list[str]]:
    """Recommend a price for every row.

    Adds the rules' prices, ``raw_recommended_price``, ``floor_price``,
    ``recommended_price``, ``floor_bound`` and ``markdown_reason``, and returns the
    names of the rule price columns as well. The reason is the first rule whose
    price was taken, also where a floor then lifted it or no band matched.

    ``joined``: bands are joined as data, not fetched and compiled. By default that is so for tables of
    more than ``COMPILED`` bands; the rows are the same.
    """
    first = [] if joined else select_rules(rules, rule_names).take(COMPILED + 1)
    if joined or joined is None and len(first) > COMPILED:
        priced, bands = joined_rule_prices(df, rules, rule_names)
    else:
        bands = _grouped(first) if len(first) <= COMPILED else bands_by_rule(rules, rule_names)
        priced = rule_prices(df, bands) if bands else df
    columns = [_price_column(name) for name in bands]

    candidates = [F.col(c) for c in columns] or [F.col("original_price").cast(RULE_PRICE)]
    lowest = F.least(*candidates) if len(candidates) > 1 else candidates[0]
    floor = (F.col("unit_cost") * exact(FLOOR_FACTOR)).cast(RULE_PRICE)
    bounded = priced.withColumns({"raw_recommended_price": lowest, "floor_price": floor})

    raw = F.col("raw_recommended_price")
    reason = first_match(
        [(F.col(c) == raw, F.lit(name.upper())) for c, name in zip(columns, bands)],
        F.lit(FLOOR_REASON if bands else NO_RULE_REASON),
    )
    result = bounded.withColumns(
        {
            "recommended_price": F.greatest("raw_recommended_price", "floor_price"),
            "floor_bound": F.col("floor_price") > raw,
            "markdown_reason": reason,
        }
    )
    return result, columns


def rule_usage(
    df: DataFrame, rules: DataFrame, rule_names: Sequence[str] | None = None
) -> DataFrame:
    """The selected bands in evaluation order, each with the number of rows it prices.

    All bands are counted side by side in one aggregation: one pass, and one row
    leaves each task.
    """
    grouped = bands_by_rule(rules, rule_names)
    places = [(name, i) for name, rows in grouped.items() for i in range(1, len(rows) + 1)]
    if not places:
        empty = select_rules(rules, rule_names)
        return empty.withColumns(
            {"evaluation_order": F.lit(0), "priced_rows": F.lit(0).cast("bigint")}
        )
    hits = df.select(
        [
            first_match(
                [(band_condition(r), F.lit(i)) for i, r in enumerate(rows, 1)], F.lit(0)
            ).alias(f"hit_{_price_column(name)}")
            for name, rows in grouped.items()
        ]
    )
    counts = hits.agg(
        F.array(
            [
                F.struct(
                    F.lit(name).alias("rule_name"),
                    F.lit(i).alias("evaluation_order"),
                    F.count_if(F.col(f"hit_{_price_column(name)}") == i).alias("priced_rows"),
                )
                for name, i in places
            ]
        ).alias("counts")
    ).select(F.inline("counts"))
    ordered = rows_to_df(
        df.sparkSession,
        [(*row, i) for rows in grouped.values() for i, row in enumerate(rows, 1)],
        select_rules(rules).withColumn("evaluation_order", F.lit(0)).schema,
    )
    return ordered.join(counts, ["rule_name", "evaluation_order"], "left").orderBy(*BAND_ORDER)
