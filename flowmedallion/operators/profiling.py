"""Table profiles: counts, nulls, constants, duplicates, quality rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from flowmedallion import vocabulary as V
from flowmedallion.functions.expressions import count_where, ratio_or_null
from flowmedallion.functions.hashing import row_keys

METADATA_PREFIX = "_"


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def _per_column(df: DataFrame, measures: dict[str, dict[str, Column]]) -> DataFrame:
    """One aggregate over the whole table, turned to one row per column.

    ``measures`` maps column -> measure name -> aggregate.
    """
    if not measures:
        raise ValueError("no column to measure")
    aggregates = [
        agg.alias(f"{name}#{i}")
        for i, per_column in enumerate(measures.values())
        for name, agg in per_column.items()
    ]
    rows = [
        F.struct(
            F.lit(column).alias("column"),
            *[F.col(f"`{name}#{i}`").alias(name) for name in per_column],
        )
        for i, (column, per_column) in enumerate(measures.items())
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def _constancy(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """For each column an aggregate: at most one distinct value, null being a value.

    Numbers: all null, or no null and min = max.  Texts and other types whose extremes would
    keep the aggregate from hashing: no row differs from the table's first.
    """
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType))}
    others = [c for c in columns if c not in numeric]
    first = None
    if others:
        first = df.limit(1).agg(F.first(F.struct(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(others)]))).scalar()

    def one(name: str) -> Column:
        column = F.col(f"`{name}`")
        if name not in numeric:
            differs = ~column.eqNullSafe(first.getField(f"v{others.index(name)}"))
            return F.coalesce(F.max(differs.cast("int")) == 0, F.lit(True))
        present = F.count(column)
        same = F.coalesce(F.min(column) == F.max(column), F.lit(False))
        return (present == 0) | ((present == F.count("*")) & same)

    return {c: one(c) for c in columns}


def checked_columns(df: DataFrame, protected: Sequence[str] = ("label",)) -> list[str]:
    return [c for c in df.columns if not c.startswith(METADATA_PREFIX) and c not in protected]


def constant_columns(df: DataFrame, protected: Sequence[str] = ("label",)) -> DataFrame:
    """Names of the columns with at most one distinct value, from a single aggregate."""
    columns = checked_columns(df, protected)
    if not columns:
        return df.sparkSession.createDataFrame([], "column string")
    flags = _per_column(df, {c: {"constant": flag} for c, flag in _constancy(df, columns).items()})
    return flags.filter("constant").select("column")


def varying_in_head(df: DataFrame, rows: int) -> set[str]:
    """Columns with two distinct values among the first rows; at most ``rows`` rows are fetched."""

    def same(value: object) -> object:
        # NaN equals itself here, as it does when Spark groups
        return "NaN" if value != value else value

    head = df.head(rows)
    return {
        c for i, c in enumerate(df.columns) if any(same(row[i]) != same(head[0][i]) for row in head)
    }


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, from one aggregate."""
    return _per_column(
        df, {c: {"nulls": count_where(F.col(f"`{c}`").isNull())} for c in df.columns}
    )


def profile(df: DataFrame, protected: Sequence[str] = ("label",)) -> DataFrame:
    """Rows, nulls and constancy of each column together in one pass."""
    constant = _constancy(df, checked_columns(df, protected))
    measures = {}
    for c in df.columns:
        column = F.col(f"`{c}`")
        measures[c] = {
            "row_count": F.count("*"),
            "nulls": count_where(column.isNull()),
            "constant": constant.get(c, F.first(F.lit(False))),
        }
    return _per_column(df, measures)


def totals_of_groups(groups: DataFrame) -> DataFrame:
    """One row of ``total``, ``distinct`` and ``nulls`` from one row per distinct row with ``_copies`` and ``_nulls``."""
    return groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total"),
        F.count("*").alias("distinct"),
        F.coalesce(F.sum(F.col("_copies") * F.col("_nulls")), F.lit(0)).alias("nulls"),
    )


def duplicates_of_totals(totals: DataFrame) -> DataFrame:
    return totals.select(
        F.col("total").alias("total_rows"),
        F.col("distinct").alias("distinct_rows"),
        (F.col("total") - F.col("distinct")).alias("duplicates"),
    )


def duplicate_count(df: DataFrame) -> DataFrame:
    """Total and distinct rows and their difference; copies collapse before the shuffle, which carries digests."""
    return (
        df.groupBy(*row_keys(df))
        .agg(F.count("*").alias("_copies"))
        .agg(
            F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_rows"),
            F.count("*").alias("distinct_rows"),
        )
        .withColumn("duplicates", F.col("total_rows") - F.col("distinct_rows"))
    )


def describe_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, stddev, min and max of numeric columns, one row per column."""
    measures = {}
    for c in columns:
        value = F.col(c).cast("double")
        measures[c] = {
            "value_count": F.count(value),
            "mean": F.avg(value),
            "stddev": F.stddev_samp(value),
            "min": F.min(value),
            "max": F.max(value),
        }
    return _per_column(df, measures)


def quality_gate(df: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """One row per rule: measured value, threshold, passed.

    The null ratio is taken over all cells.  Grouping equal rows, by digest, gives row,
    copy and null counts in one pass.
    """
    nulls = sum((F.when(F.col(f"`{c}`").isNull(), 1).otherwise(0) for c in df.columns), F.lit(0))
    groups = df.groupBy(*row_keys(df)).agg(
        F.count("*").alias("_copies"), F.first(nulls).alias("_nulls")
    )
    return gate_of_totals(totals_of_groups(groups), len(df.columns), thresholds)


def gate_of_totals(totals: DataFrame, width: int, thresholds: dict[str, float] | None = None) -> DataFrame:
    """The rules of ``quality_gate`` on the totals of a table of ``width`` columns."""
    limits = dict(V.QUALITY_THRESHOLDS) | (thresholds or {})
    totals = totals.select(*[F.col(c).cast("double").alias(c) for c in totals.columns])
    null_ratio = F.coalesce(ratio_or_null(F.col("nulls"), F.col("total") * width), F.lit(0.0))
    copy_ratio = F.coalesce(
        ratio_or_null(F.col("total") - F.col("distinct"), F.col("total")), F.lit(0.0)
    )

    def rule(name: str, measured: Column, at_most: bool) -> Column:
        limit = F.lit(float(limits[name]))
        passed = measured <= limit if at_most else measured >= limit
        return F.struct(
            F.lit(name).alias("rule"),
            measured.alias("measured"),
            limit.alias("threshold"),
            passed.alias("passed"),
        )

    return totals.select(
        F.inline(
            F.array(
                rule("max_null_ratio", null_ratio, True),
                rule("max_duplicate_ratio", copy_ratio, True),
                rule("min_rows_bronze", F.col("total"), False),
            )
        )
    )


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Row count of each named layer."""
    counted = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        for name, df in layers.items()
    ]
    united = counted[0]
    for one in counted[1:]:
        united = united.unionByName(one)
    return united
