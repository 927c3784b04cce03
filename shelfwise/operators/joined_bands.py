"""Bands as data, for rule tables too large to become generated code.

The bands of a rule overlap and the first one counts, so they are first made disjoint. All bounds
are cut points of a rule's trigger; ranked in order, a band is a run of ranks. A run is
put together from dyadic ranges of ranks (two for each power of two at most), of which each keeps its first band
only; the segment between two cut points then looks up the dyadic ranges that it lies in, one for each
power of two, and takes the first band of these. Cost grows with n log n however bands overlap. Prices
look up disjoint segments by range; the priced rows are never compared with all bands.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.joins import range_lookup
from shelfwise.operators.keys import number_members
from shelfwise.operators.rules import BAND_ORDER, select_rules
from shelfwise.sinks.staging import stage

BOUND = "decimal(38,12)"
MULTIPLIER = "decimal(20,12)"
OPERATORS = ("BETWEEN", ">", ">=", "<", "<=", "=")
# Kinds of cut points, in order: before all values, at a value, behind all values.
_FIRST, _AT, _LAST = 0, 1, 2
_CUT = ("rule_name", "trigger_column", "kind", "value", "side")


def _bounds(rules: DataFrame) -> DataFrame:
    """Bands on numbers as a low and a high cut point. ``side`` is 1 behind the value, 0 before it."""
    op = F.col("condition_operator")

    def cut(value: Column, given: Column, missing: int, behind: Column) -> Column:
        return F.struct(
            F.when(given, _AT).otherwise(missing).alias("kind"),
            F.when(given, value.cast(BOUND)).alias("value"),
            F.when(given & behind, 1).otherwise(0).alias("side"),
        )

    return rules.where(op != "=").select(
        "rule_name", "trigger_column", _order().alias("place"),
        cut(F.col("condition_min"), op.isin("BETWEEN", ">", ">="), _FIRST, op == ">").alias("low"),
        cut(F.col("condition_max"), op.isin("BETWEEN", "<", "<="), _LAST, op.isin("BETWEEN", "<=")).alias("high"),
    )


def _order() -> Column:
    """Place of a band in the order of evaluation (NULL bounds first), and its multiplier."""
    return F.struct(*BAND_ORDER, F.col("price_multiplier").cast(MULTIPLIER).alias("multiplier"))


def _shift(number: Column, by: Column) -> Column:
    return F.call_function("shiftright", number, by)


def _dyadic(first: Column, end: Column, levels: int) -> Column:
    """The dyadic ranges (level, at) that make up the ranks from ``first`` to before ``end``."""

    def of_level(k: Column) -> Column:
        width = F.call_function("shiftleft", F.lit(1).cast("long"), k)
        low, high = _shift(first + width - 1, k), _shift(end, k)
        left = F.when((low < high) & (low % 2 == 1), F.struct(k.alias("level"), low.alias("at")))
        right = F.when((low < high) & (high % 2 == 1), F.struct(k.alias("level"), (high - 1).alias("at")))
        return F.array(left, right)

    every = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), of_level))
    return F.filter(every, lambda r: r.isNotNull())


def segments(rules: DataFrame) -> DataFrame:
    """Disjoint segments of each rule's triggers with the first band there: rule_name, trigger_column, low,
    low_side, high, high_side, place. A NULL bound is none. Segments without a band are left out."""
    bands = stage(_bounds(rules), "bands")
    ends = [
        bands.select("rule_name", "trigger_column", F.lit(kind).alias("kind"), F.lit(None).cast(BOUND).alias("value"), F.lit(0).alias("side"))
        for kind in (_FIRST, _LAST)
    ]
    bounds = [bands.select("rule_name", "trigger_column", f"{side}.*") for side in ("low", "high")]
    cuts = bounds[0].unionAll(bounds[1]).unionAll(ends[0]).unionAll(ends[1]).distinct()
    ranked = stage(number_members(cuts, "cut", _CUT), "band_cuts")
    levels = max(1, ranked.count().bit_length())

    def rank(side: str, name: str) -> DataFrame:
        return ranked.select(
            F.col("rule_name").alias("_rule"), F.col("trigger_column").alias("_trigger"),
            F.struct("kind", "value", "side").alias("_cut"), F.col("cut").alias(name),
        )

    runs = bands
    for side, name in (("low", "first"), ("high", "end")):
        at = rank(side, name)
        same = (F.col("rule_name") == F.col("_rule")) & (F.col("trigger_column") == F.col("_trigger"))
        runs = runs.join(at, same & F.col(side).eqNullSafe(F.col("_cut"))).drop("_rule", "_trigger", "_cut")
    ranges = runs.select("place", F.explode(_dyadic(F.col("first"), F.col("end"), levels)).alias("r"))
    best = ranges.groupBy("r.level", "r.at").agg(F.min("place").alias("place"))

    probes = F.transform(F.sequence(F.lit(0), F.lit(levels)), lambda k: F.struct(k.alias("level"), _shift(F.col("cut"), k).alias("at")))
    asked = ranked.where(F.col("kind") < _LAST).select("cut", F.explode(probes).alias("r")).select("cut", "r.level", "r.at")
    won = asked.join(best, ["level", "at"]).groupBy("cut").agg(F.min("place").alias("place"))
    after = ranked.select((F.col("cut") - 1).alias("cut"), F.col("value").alias("high"), F.col("side").alias("high_side"))
    found = ranked.join(won, "cut").join(after, "cut").select(
        "rule_name", "trigger_column", F.col("value").alias("low"), F.col("side").alias("low_side"), "high", "high_side", "place"
    )
    return stage(found, "band_segments")


class Rule(NamedTuple):
    name: str
    #: (column, whether the bands compare texts)
    triggers: list[tuple[str, bool]]
    #: Decimals that the multipliers are written with, and their largest number of whole digits.
    decimals: int
    whole: int
    #: The same of the bounds.
    bound_decimals: int
    bound_whole: int

    def bound(self) -> str:
        """No wider a DECIMAL than the bounds need; those of up to 18 digits are compared as LONGs."""
        return f"decimal({self.bound_whole + self.bound_decimals}, {self.bound_decimals})"


def described(rules: DataFrame, rule_names: Sequence[str] | None = None) -> list[Rule]:
    """The selected rules in order of evaluation; one row for each rule and trigger is fetched."""
    chosen = select_rules(rules, rule_names)
    op, times = F.col("condition_operator"), F.col("price_multiplier").cast(MULTIPLIER)
    needs_min, needs_max = op.isin("BETWEEN", ">", ">="), op.isin("BETWEEN", "<", "<=")

    def decimals(c: Column) -> Column:
        return F.max(F.length(F.regexp_extract(c.cast("string"), r"\.(\d*?)0*$", 1)))

    def whole(c: Column) -> Column:
        return F.max(F.length(F.abs(F.floor(c)).cast("string")))

    bounds = F.greatest(*[F.coalesce(F.abs(F.col(c)), F.lit(0.0)) for c in ("condition_min", "condition_max")]).cast(BOUND)
    places = [decimals(F.col(c).cast(BOUND)) for c in ("condition_min", "condition_max")]
    rows = chosen.groupBy("rule_name", "trigger_column", (op == "=").alias("is_text")).agg(
        F.min(F.struct(*BAND_ORDER)).alias("first"), decimals(times).alias("decimals"), whole(times).alias("whole"),
        F.coalesce(F.greatest(*places), F.lit(0)).alias("bound_decimals"), whole(bounds).alias("bound_whole"),
        F.count_if(F.coalesce(~op.isin(*OPERATORS), F.lit(True))).alias("unknown"),
        F.count_if(F.col("price_multiplier").isNull()).alias("no multiplier"),
        F.count_if(needs_min & F.col("condition_min").isNull() | needs_max & F.col("condition_max").isNull()).alias("no bound"),
    ).collect()
    for r in rows:
        for fault, says in (("unknown", "unknown operator"), ("no multiplier", "a band has no multiplier"), ("no bound", "a band needs a bound")):
            if r[fault]:
                raise ValueError(f"rule {r['rule_name']!r}: {says}")

    def place(r) -> tuple:
        return tuple((x is not None, x if x is not None else 0) for x in r["first"][:3]) + ((r["first"][3] is not None, r["first"][3] or ""),)

    found: dict[str, Rule] = {}
    for r in sorted(rows, key=place):
        rule = found.setdefault(r["rule_name"], Rule(r["rule_name"], [], 0, 0, 0, 1))
        rule.triggers.append((r["trigger_column"], bool(r["is_text"])))
        digits = ("decimals", "whole", "bound_decimals", "bound_whole")
        found[rule.name] = rule._replace(**{d: max(getattr(rule, d), r[d] or 0) for d in digits})
    return list(found.values())


def with_multipliers(df: DataFrame, rules: DataFrame, described_rules: Sequence[Rule]) -> tuple[DataFrame, list[Column]]:
    """``df`` with the first matching band of each rule, and per rule its multiplier (NULL where none matches).

    Every row stays one row: segments are disjoint, and a text has one first band."""
    names = [r.name for r in described_rules]
    chosen = select_rules(rules, names).drop("discount_pct") if names else select_rules(rules).limit(0)
    numbers = segments(chosen) if any(not text for r in described_rules for _, text in r.triggers) else None
    texts = chosen.where("condition_operator = '='").groupBy("rule_name", "trigger_column", "condition_str_value").agg(
        F.min(_order()).alias("place")
    )
    columns, out = [], df
    for i, rule in enumerate(described_rules):
        places = []
        # Only where a rule has several triggers does it take the order to tell which band is first.
        taken = F.col("place") if len(rule.triggers) > 1 else F.col("place.multiplier")
        for j, (trigger, is_text) in enumerate(rule.triggers):
            name = f"_band_{i}_{j}"
            side = (texts if is_text else numbers).where((F.col("rule_name") == rule.name) & (F.col("trigger_column") == trigger))
            side = side.withColumn("place", taken)
            if is_text:
                keyed = side.select(F.col("condition_str_value").alias("_text"), F.col("place").alias(name))
                out = out.join(keyed, F.col(trigger) == F.col("_text"), "left").drop("_text")
            else:
                out = _in_segment(out, F.col(trigger), side, name, rule.bound())
            places.append(F.col(name))
        columns.append(F.least(*places)["multiplier"] if len(places) > 1 else places[0])
    return out, columns


def _in_segment(df: DataFrame, value: Column, side: DataFrame, name: str, bound: str) -> DataFrame:
    # As DOUBLEs the bounds may be a little off, but never leave out a value that fits; ``fits`` tells exactly.
    ranged = side.select(
        F.coalesce(F.col("low").cast("double"), F.lit(-1e300)).alias("lowest"),
        F.coalesce(F.col("high").cast("double"), F.lit(1e300)).alias("highest"),
        F.col("low").cast(bound).alias("low"), "low_side", F.col("high").cast(bound).alias("high"), "high_side",
        F.col("place").alias(name),
    )

    def fits(c) -> Column:
        above = c("low").isNull() | (value > c("low")) | (value == c("low")) & (c("low_side") == 0)
        below = c("high").isNull() | (value < c("high")) | (value == c("high")) & (c("high_side") == 1)
        return above & below

    inner = ("low", "low_side", "high", "high_side")
    return range_lookup(df, value.cast("double"), ranged, "lowest", "highest", name, hidden=inner, fits=fits)
