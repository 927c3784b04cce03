"""Dimension lookups. All are left outer joins: a row without a member keeps a
NULL key. None carries a broadcast hint; dimensions are stored or local tables of
known size, so Spark broadcasts those below its threshold and shuffles larger ones.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lookup(df: DataFrame, value: Column, dim: DataFrame, member: str, *take: str) -> DataFrame:
    """Add the columns ``take`` of the dimension row whose ``member`` equals ``value``."""
    side = dim.select(F.col(member).alias("_member"), *take)
    return df.join(side, value == F.col("_member"), "left").drop("_member")


# Bits of the numbers that values are placed by, and the decimals of a DOUBLE that count there.
_BITS = 62
_DECIMALS = 6

#: Ranges that share one width of cells, however narrow they are.
FEW = 16
#: Widths of cells differ by two to this power at least.
STEP = 4


def _place(value: Column, decimals: int) -> Column:
    """A whole number that does not fall while the value grows, the ends of LONG at most."""
    return F.floor(value.cast("double") * F.lit(float(10**decimals)))


def _decimals(df: DataFrame, *columns: str) -> int:
    kinds = [df.schema[c].dataType for c in columns]
    scales = [k.scale if isinstance(k, T.DecimalType) else _DECIMALS for k in kinds if not isinstance(k, T.IntegralType)]
    return min(max(scales, default=0), _DECIMALS)


def _level(low: Column, high: Column, decimals: int) -> Column:
    """Power of two that is about as wide as the range, so that the range touches few cells of that width."""
    width = _place(high, decimals).cast("double") - _place(low, decimals).cast("double")
    return F.least(F.ceil(F.log2(width + 1)), F.lit(_BITS)).cast("int")


Widths = dict[int, int]


def cell_widths(ranges: DataFrame, low: str, high: str) -> Widths:
    """The width of cells (as power of two) that each width of range is laid out over.

    Reads ``FEW`` rows and, if there are more, one row per width. A few ranges share the cells of the
    widest; otherwise ranges of about the same width share theirs.
    """
    level = _level(F.col(low), F.col(high), _decimals(ranges, low, high)).alias("level")
    found = ranges.where(F.col(low) <= F.col(high)).select(level)
    first = [r[0] for r in found.limit(FEW + 1).collect()]
    if len(first) <= FEW:
        return dict.fromkeys(first, max(first, default=0))
    widths = {}
    waiting: list[int] = []
    total = 0
    counts = sorted((r[0], r[1]) for r in found.groupBy("level").count().collect())
    for (level_, n), (following, _) in zip(counts, [*counts[1:], (None, 0)], strict=True):
        waiting.append(level_)
        total += n
        top = min(-(-level_ // STEP) * STEP, _BITS)
        if following is None or total > FEW and following > top:
            widths |= dict.fromkeys(waiting, max(top, level_))
            waiting, total = [], 0
    return widths


def range_cells(ranges: DataFrame, low: str, high: str, widths: Widths | int, *take: str) -> DataFrame:
    """Each range once for each cell that it touches: _width, _cell, _low, _high and ``take``.

    A cell is about as wide as the range or wider, so a range touches two cells, three at most, be it one
    cent wide or a trillion. One number as ``widths`` is the width of all cells.
    """
    decimals = _decimals(ranges, low, high)
    level = _level(F.col(low), F.col(high), decimals)
    if isinstance(widths, int):
        width = F.lit(widths)
    else:
        width = F.element_at(F.create_map(*[F.lit(x) for pair in widths.items() for x in pair]), level) if widths else level
    sound = ranges.where(F.col(low) <= F.col(high)).withColumn("_width", width)

    def cell(c: str) -> Column:
        return F.call_function("shiftright", _place(F.col(c), decimals), F.col("_width"))

    return sound.select(
        "_width", F.explode(F.sequence(cell(low), cell(high))).alias("_cell"), F.col(low).alias("_low"), F.col(high).alias("_high"), *take
    )


def range_lookup(
    df: DataFrame, value: Column, ranges: DataFrame, low: str, high: str, *take: str,
    cell: float | None = None, hidden: Sequence[str] = (), fits: Callable[[Callable[[str], Column]], Column] | None = None,
) -> DataFrame:
    """Add the columns ``take`` of the ranges with ``low <= value <= high``; a row comes once for
    each such range, and once without one. Ranges without a bound match nothing. ``fits`` is a further
    condition on columns of the range, those named ``hidden`` and ``take``.

    The join is an equality on the cell that a value lies in, with the range as a further condition, never a
    comparison of each row with each range. Ranges are laid out over cells of about their own width, so
    the side of the ranges stays within three rows a range. Where widths differ much, one join
    follows for each width of cells (at most ``_BITS / STEP``). With ``cell``, all ranges are laid out over cells
    of at least this width instead, and their widths are not looked at.
    """
    decimals = _decimals(ranges, low, high)
    if cell is None:
        widths = cell_widths(ranges, low, high)
        groups = sorted(set(widths.values())) or [0]
    else:
        widths = max(0, ceil(log2(cell * 10**decimals)))
        groups = [widths]
    cells = range_cells(ranges, low, high, widths, *hidden, *take)

    def within(c: Callable[[str], Column]) -> Column:
        inside = value.between(c("_low"), c("_high"))
        return inside & fits(c) if fits else inside

    if len(groups) == 1:
        here = F.shiftright(_place(value, decimals), groups[0])
        return df.join(cells, (here == F.col("_cell")) & within(F.col), "left").drop("_width", "_cell", "_low", "_high", *hidden)
    # A value meets one cell of each width; what lies there is put together before it is told by range.
    found = df
    for i, width in enumerate(groups):
        side = cells.where(F.col("_width") == width).groupBy(F.col("_cell").alias(f"_c{i}")).agg(
            F.collect_list(F.struct("_low", "_high", *hidden, *take)).alias(f"_r{i}")
        )
        found = found.join(side, F.shiftright(_place(value, decimals), width) == F.col(f"_c{i}"), "left").drop(f"_c{i}")
    lists = [F.coalesce(f"_r{i}", F.array().cast(found.schema[f"_r{i}"].dataType)) for i in range(len(groups))]
    near = F.filter(F.concat(*lists), lambda r: within(lambda c: r[c]))
    hit = found.withColumn("_hit", near).drop(*(f"_r{i}" for i in range(len(groups))))
    hit = hit.withColumn("_hit", F.explode_outer("_hit"))
    return hit.select(*df.columns, *(F.col(f"_hit.{c}").alias(c) for c in take))
