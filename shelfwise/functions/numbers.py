"""Exact number literals, ratios and NaN handling."""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


MAX_DIGITS = 38


def exact(value: float | int | str | Decimal) -> Column:
    """Literal with the decimal digits the number is written with."""
    return F.lit(Decimal(str(value)))


def decimal_for(values: Iterable[float], whole: int, decimals: int) -> T.DecimalType:
    """DECIMAL with at least ``whole`` digits before the point and ``decimals`` after it,
    more if the values are written with more."""
    numbers = [Decimal(str(v)) for v in values]
    scale = max([decimals, *(-n.as_tuple().exponent for n in numbers)])
    digits = max([whole, *(n.adjusted() + 1 for n in numbers)]) + scale
    if digits > MAX_DIGITS:
        raise ValueError(f"the values need {digits} decimal digits; {MAX_DIGITS} are the most")
    return T.DecimalType(digits, scale)


def percent_of(part: Column, whole: Column, to: T.DecimalType) -> Column:
    """``part / whole * 100`` rounded half up; NULL where ``whole`` is zero or NULL.

    The quotient is a DOUBLE, as dividing DECIMALs would round it once more. The
    cast rounds on its decimal digits, like ``round`` on a DOUBLE does.
    """
    return (F.try_divide(part.cast("double"), whole.cast("double")) * 100).cast(to)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every float column, so that ``coalesce``,
    ``IS NOT NULL`` and outer bands see a missing value as missing."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floats:
        return df
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in floats})
