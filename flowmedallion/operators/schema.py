"""Column names, types and alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from flowmedallion import vocabulary as V


def clean_column_name(name: str) -> str:
    """Trimmed lower-case name with spaces, slashes and hyphens as underscores."""
    return name.strip().lower().translate(str.maketrans(" /-", "___"))


def clean_columns(df: DataFrame) -> DataFrame:
    """Clean every column name in one projection; names that fall together are an error."""
    names = [clean_column_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"several columns are named {', '.join(clashes)} after cleaning")
    return df.toDF(*names)


def cast_types(df: DataFrame) -> DataFrame:
    """Identity columns to their types, where present; text that does not parse becomes null."""
    casts = {}
    for name, wanted in V.COLUMN_TYPES.items():
        if name in df.columns and df.schema[name].dataType.simpleString() != wanted:
            casts[name] = F.col(name).try_cast(wanted)
    return df.withColumns(casts) if casts else df


def align_columns(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames with the union of columns in one order; a missing column is 0."""
    names = left.columns + [c for c in right.columns if c not in left.columns]

    def with_all(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c) if c in df.columns else F.lit(0).alias(c) for c in names])

    return with_all(left), with_all(right)


def align_to_schema(df: DataFrame, schema: T.StructType, drop_extra: bool = False) -> DataFrame:
    """The frame in the order and types of ``schema``; a missing column is null."""
    extra = [c for c in df.columns if c not in schema.names]
    if extra and not drop_extra:
        raise ValueError(f"columns not in the target: {', '.join(extra)}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def union_by_name(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """All frames stacked by column name; differing columns are an error by default."""
    united = frames[0]
    for frame in frames[1:]:
        united = united.unionByName(frame, allowMissingColumns=allow_missing)
    return united
