"""Types of text columns, as states that merge.

The kind of a value is one bit, and the state of a column is the bitwise or of its values'
kinds.  States of files, entries and loads merge by the same or, in any order, so one
aggregate types any number of files, and an increment reads its own files only.  The type of
a state is the narrowest that holds every kind in it; values are then cast as they were
tested, so no value that counted for a type is lost by the cast.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

INT, LONG, BIG, REAL, TRUTH, DAY, TIME, TEXT = (1 << i for i in range(8))
LONGEST = T.DecimalType(38, 0)
_SHORT = r"^\s*[+-]?\d{1,9}\s*$"
_MIDDLE = r"^\s*[+-]?\d{1,18}\s*$"
_WHOLE = r"^\s*[+-]?\d{1,38}\s*$"
_REAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_ODD_REAL = r"(?i)^\s*[+-]?(inf|infinity|nan)\s*$"
_DAY = r"^\d{4}-\d{2}-\d{2}$"
_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"

Kinds = dict[str, int]
"""Column -> state; 0 where every value is null or empty."""


def kind(value: Column) -> Column:
    """The kind of a text value; 0 for null and empty text.

    Shapes are tested before any cast: a cast that fails costs some fifty times one that succeeds, and
    most numbers are told by their shape alone.
    """
    middle, whole = value.try_cast("bigint"), value.try_cast(LONGEST)
    return (
        F.when(value.isNull() | (value == ""), 0)
        .when(value.rlike(_SHORT), INT)
        .when(value.rlike(_REAL) & ~value.rlike(_WHOLE), REAL)
        .when(value.rlike(_MIDDLE), F.when(middle.between(-(2**31), 2**31 - 1), INT).otherwise(LONG))
        .when(value.rlike(_WHOLE), F.when(whole.between(-(2**31), 2**31 - 1), INT).when(whole.between(-(2**63), 2**63 - 1), LONG).otherwise(BIG))
        .when(value.rlike(_ODD_REAL) & value.try_cast("double").isNotNull(), REAL)
        .when(F.lower(value).isin("true", "false"), TRUTH)
        .when(value.rlike(_DAY) & value.try_cast("date").isNotNull(), DAY)
        .when(value.rlike(_TIME) & value.try_cast("timestamp").isNotNull(), TIME)
        .otherwise(TEXT)
    )


def column_state(value: Column) -> Column:
    """Aggregate: the state of a text column."""
    return F.bit_or(kind(value))


def merge_kinds(states: Iterable[Kinds]) -> Kinds:
    merged: Kinds = {}
    for state in states:
        for name, bits in state.items():
            merged[name] = merged.get(name, 0) | bits
    return merged


def type_of(state: int) -> T.DataType:
    """Numbers take the widest among them, days and times a time, any other mixture text."""
    whole = INT | LONG | BIG
    if not state:
        return T.StringType()
    if state == TRUTH:
        return T.BooleanType()
    if not state & ~(DAY | TIME):
        return T.TimestampType() if state & TIME else T.DateType()
    if state & ~(whole | REAL):
        return T.StringType()
    if state & REAL:
        return T.DoubleType()
    return LONGEST if state & BIG else T.LongType() if state & LONG else T.IntegerType()


def typed(value: Column, kind_: T.DataType) -> Column:
    """A text value as its column's type."""
    return value if isinstance(kind_, T.StringType) else value.try_cast(kind_)
