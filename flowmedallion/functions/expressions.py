"""Small column expressions: guarded ratios, finite numbers, shares."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

FLOATING = (T.DoubleType, T.FloatType)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``; 0.0 on a zero and null on a null denominator."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / denominator)


def ratio_or_null(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``; null on a zero or null denominator."""
    return F.when(denominator != 0, numerator / denominator)


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share in percent as a double, rounded; null when ``whole`` is zero."""
    share = ratio_or_null(part.cast("double") * F.lit(100.0), whole.cast("double"))
    return F.round(share, digits)


def is_finite(column: Column) -> Column:
    """True for finite numbers, false for NaN (which sorts above infinity) and infinities."""
    return F.abs(column) < F.lit(float("inf"))


def null_if_nonfinite(column: Column) -> Column:
    return F.when(is_finite(column), column)


def zero_filled_float(column: Column, data_type: T.DataType) -> Column:
    """Numeric clean-up before learning: NaN, infinities and nulls become 0, then float32."""
    if isinstance(data_type, T.StringType):
        column, data_type = column.try_cast("double"), T.DoubleType()
    if isinstance(data_type, FLOATING):
        column = null_if_nonfinite(column)
    return F.coalesce(column.cast("float"), F.lit(0.0).cast("float"))


def is_one(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null (an integer, not a boolean)."""
    return F.when(condition, 1).otherwise(0)


def count_where(condition: Column) -> Column:
    """Number of rows meeting the condition; 0 on empty input."""
    return F.count(F.when(condition, F.lit(1)))
