"""Gold to a numeric feature frame that keeps target and metadata in the same row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from flowmedallion import vocabulary as V
from flowmedallion.functions.expressions import zero_filled_float

TARGET = "is_attack"
METADATA = ("label", "day_of_week")
# text that holds a number after the type casts
NUMERIC_TEXT = ("protocol",)


def drop_leakage(df: DataFrame) -> DataFrame:
    """Without the columns that tell, or hint at, the label."""
    return df.drop(*V.LEAKAGE_COLUMNS)


def one_hot_columns(column: str = "protocol_name", prefix: str = "protocol") -> dict:
    """Indicator columns over the fixed vocabulary, so that every frame has the same ones."""
    return {
        f"{prefix}_{value}": F.when(F.col(column) == value, 1).otherwise(0)
        for value in V.PROTOCOL_VOCABULARY
    }


def one_hot_protocol(df: DataFrame, column: str = "protocol_name") -> DataFrame:
    return df.withColumns(one_hot_columns(column)).drop(column) if column in df.columns else df


def sanitize_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NaN, infinities and nulls of the named columns become 0; all become float32."""
    return df.withColumns({c: zero_filled_float(F.col(c), df.schema[c].dataType) for c in columns})


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns a model may see: numbers, and number-like text; no target, label or metadata."""
    hidden = set(V.LEAKAGE_COLUMNS) | {TARGET, "split", "protocol_name"}
    return [
        f.name
        for f in df.schema.fields
        if f.name not in hidden
        and not f.name.startswith("_")
        and (isinstance(f.dataType, (T.NumericType, T.BooleanType)) or f.name in NUMERIC_TEXT)
    ]


def feature_names(df: DataFrame) -> list[str]:
    """Feature columns that ``feature_frame`` gives for this frame, in order."""
    encoded = list(one_hot_columns()) if "protocol_name" in df.columns else []
    return numeric_columns(df) + encoded


def feature_frame(df: DataFrame, keep: Sequence[str] = (*METADATA, TARGET, "split")) -> DataFrame:
    """One projection: kept columns as they are, then every feature as float32.

    Text columns such as addresses are not features and are left out.
    """
    kept = [F.col(c) for c in keep if c in df.columns]
    numbers = [zero_filled_float(F.col(c), df.schema[c].dataType).alias(c) for c in numeric_columns(df)]
    encoded = []
    if "protocol_name" in df.columns:
        encoded = [c.cast("float").alias(n) for n, c in one_hot_columns().items()]
    return df.select(*kept, *numbers, *encoded)
