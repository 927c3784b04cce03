"""Range lookup and rules joined as data, for ranges and rule tables of any size."""

import random
from bisect import bisect_right
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import banded, joins
from shelfwise.operators.joined_bands import segments
from shelfwise.operators.rules import select_rules
from shelfwise.types import TABLES
from tests.test_plans import plan

RANGES = "id int, lo decimal(18,2), hi decimal(18,2)"


def _ranges(spark, rows):
    return spark.createDataFrame([(i, Decimal(str(lo)), Decimal(str(hi))) for i, lo, hi in rows], RANGES)


def _found(spark, values, ranges):
    df = spark.createDataFrame([(None if v is None else Decimal(str(v)),) for v in values], "v decimal(18,2)")
    found = joins.range_lookup(df, F.col("v"), ranges, "lo", "hi", "id")
    return sorted(((None if r[0] is None else float(r[0])), r[1]) for r in found.collect()) if None not in values else found.collect()


def _expected(values, rows):
    out = []
    for v in values:
        hits = [i for i, lo, hi in rows if lo <= v <= hi]
        out += [(float(v), i) for i in hits] or [(float(v), None)]
    return sorted(out, key=str)


def test_a_range_to_a_trillion_takes_few_rows(spark):
    rows = [(1, 0, 500), (2, 501, 10**12), (3, -(10**12), 10**12), (4, 7, 7)]
    ranges = _ranges(spark, rows)
    widths = joins.cell_widths(ranges, "lo", "hi")
    assert joins.range_cells(ranges, "lo", "hi", widths, "id").count() <= 3 * len(rows)
    values = [-(10**12), -0.01, 0, 7, 7.01, 500, 500.5, 501, 10**12, 2 * 10**12]
    assert sorted(_found(spark, values, ranges), key=str) == _expected(values, rows)


def test_many_ranges_of_all_widths(spark):
    """Overlapping, of one cent to a trillion: cells of several widths, three rows a range at most."""
    rng = random.Random(3)
    rows = []
    for i in range(400):
        low = rng.choice([0, 10, 10**4, 10**9]) + rng.randint(-300, 300) / 100
        rows.append((i, round(low, 2), round(low + 10 ** rng.uniform(-2, 11), 2)))
    rows.append((400, 5, 4))
    ranges = _ranges(spark, rows)
    widths = joins.cell_widths(ranges, "lo", "hi")
    assert len(set(widths.values())) > 3
    assert joins.range_cells(ranges, "lo", "hi", widths, "id").count() <= 3 * 400
    values = [round(rng.choice([0, 10, 10**4, 10**9]) + rng.uniform(-300, 300), 2) for _ in range(300)]
    assert sorted(_found(spark, values, ranges), key=str) == _expected(values, rows)


def test_null_values_and_bounds_match_nothing(spark):
    ranges = spark.createDataFrame([(1, None, Decimal(5)), (2, Decimal(1), None)], RANGES)
    assert [tuple(r) for r in _found(spark, [None, 3], ranges)] in ([(None, None), (Decimal(3), None)], [(Decimal(3), None), (None, None)])
    assert _found(spark, [3], ranges.limit(0)) == [(3.0, None)]


# --- rules as data


def _band(rule_id, name, trigger, op, low, high, text, times):
    low, high = (None if x is None else float(x) for x in (low, high))
    return (rule_id, name, trigger, op, low, high, text, times, None, "t", None)


def _rules(spark, rows):
    return spark.createDataFrame(rows, TABLES["banded_rules"])


PRODUCTS = "n int, original_price decimal(10,2), unit_cost decimal(12,4), d double, c decimal(10,2), t string"


def _products(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = [
        (i, Decimal(rng.randint(1, 99999)) / 100, Decimal(1), rng.choice([None, float(rng.randint(-20, 120)), rng.uniform(-20, 120)]),
         rng.choice([None, Decimal(rng.randint(-200, 1200)) / 10]), rng.choice([None, "a", "b", "c"]))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, PRODUCTS)


def _both(df, rules, names=None):
    one, columns = banded.apply_banded_rules(df, rules, names, joined=False)
    two, same = banded.apply_banded_rules(df, rules, names, joined=True)
    assert columns == same and one.schema == two.schema
    return sorted(map(str, one.collect())), sorted(map(str, two.collect()))


def test_joined_rules_give_the_rows_of_compiled_ones(spark):
    """All operators, overlaps, shared bounds, texts, two triggers in one rule, missing triggers."""
    rng = random.Random(2)
    rows = []
    for i in range(240):
        name = rng.choice(["R1", "R2", "R3"])
        trigger = {"R1": "d", "R2": "c", "R3": rng.choice(["d", "c", "t"])}[name]
        op = "=" if trigger == "t" else rng.choice(["BETWEEN", "BETWEEN", "BETWEEN", ">", ">=", "<", "<="])
        low = rng.choice([rng.randint(-20, 120), rng.randint(-200, 1200) / 10])
        high = low + rng.choice([-1, 0, 0.1, 3, 40])
        rows.append(_band(int(name[1]), name, trigger, op, None if op == "=" else low, None if op == "=" else high,
                          rng.choice("abcd") if op == "=" else None, round(rng.uniform(0.3, 1.2), rng.choice([1, 2, 5]))))
    # Bands that agree in all that orders them have no first one.
    rules = _rules(spark, list({(r[0], *r[4:7]): r for r in rows}.values()))
    df = _products(spark)
    for names in (None, ["R3"], ["R2", "R1"], ["none"]):
        one, two = _both(df, rules, names)
        assert one == two


def test_fifty_thousand_bands(spark):
    """Far beyond what can be compiled; the first band by lower bound counts."""
    n = 50_000
    rng = random.Random(4)
    bands = sorted({(i / 10, round(i / 10 + rng.choice([0.05, 0.1, 0.35, 40]), 2)) for i in range(n)})
    rows = [_band(1, "MANY", "c", "BETWEEN", lo, hi, None, round(0.5 + (i % 1000) / 10_000, 4)) for i, (lo, hi) in enumerate(bands)]
    rows += [_band(2, "OPEN", "c", "<", -1e9 + i, i / 10, None, 0.9) for i in range(0, n, 10)]
    rules = _rules(spark, rows).repartition(4)
    prices = [Decimal(rng.randint(0, n + 100)) / 10 for _ in range(2000)]
    df = spark.createDataFrame([(i, Decimal(100), Decimal(1), None, p, None) for i, p in enumerate(prices)], PRODUCTS)
    result, columns = banded.apply_banded_rules(df, rules)
    assert columns == ["price_many", "price_open"]
    text = plan(result)
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    lows = [lo for lo, _ in bands]
    found = {r["n"]: (r["price_many"], r["price_open"]) for r in result.select("n", *columns).collect()}
    assert len(found) == len(prices)
    for i, p in enumerate(prices):
        v = float(p)
        first = next((k for k in range(max(0, bisect_right(lows, v) - 402), len(bands)) if lows[k] <= v <= bands[k][1] or lows[k] > v), None)
        times = 0.5 + (first % 1000) / 10_000 if first is not None and lows[first] <= v else 1
        assert found[i] == (pytest.approx(Decimal(str(round(100 * times, 4)))), 90 if v < (n - 10) / 10 else 100)


def test_segments_are_disjoint_and_few(spark):
    rows = [_band(1, "R", "c", "BETWEEN", i, 1000 - i, None, 0.5) for i in range(300)] + [_band(1, "R", "c", "<", -5, i, None, 0.7) for i in range(300)]
    found = segments(select_rules(_rules(spark, rows)))
    assert found.count() <= 2 * len(rows) + 1
    bounds = sorted((r.low if r.low is not None else Decimal(-(10**9)), r.low_side) for r in found.collect())
    assert len(set(bounds)) == len(bounds)


def test_unsound_rules_are_named(spark):
    df = _products(spark, 3)
    for band, says in (
        (_band(1, "R", "c", "!=", 1.0, 2.0, None, 0.5), "unknown operator"),
        (_band(1, "R", "c", "BETWEEN", None, 2.0, None, 0.5), "needs a bound"),
        (_band(1, "R", "c", "<", 1.0, 2.0, None, None), "no multiplier"),
    ):
        with pytest.raises(ValueError, match=says):
            banded.apply_banded_rules(df, _rules(spark, [band]), joined=True)
