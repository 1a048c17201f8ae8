"""Train/test overlap, label presence, and frame equality.

All counts come from grouping equal rows first: copies collapse before the
shuffle, so a feature vector that a third of all flows share costs one row per
task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from flowmedallion import vocabulary as V
from flowmedallion.functions.expressions import count_where, percentage
from flowmedallion.functions.hashing import row_keys
from flowmedallion.operators.sampling import SPLIT, TEST, TRAIN

# A feature vector with at least 1/HOT_PARTS of all rows is hot; there are at most HOT_PARTS of them.
HOT_PARTS = 1000


def feature_groups(df: DataFrame, features: Sequence[str], split: str = SPLIT, values: bool = True) -> DataFrame:
    """Train and test rows of every distinct feature vector; without ``values``, vectors are known by digest."""
    keys = list(features) if values else row_keys(df, features)
    return df.groupBy(*keys).agg(
        count_where(F.col(split) == TRAIN).alias("train_rows"),
        count_where(F.col(split) == TEST).alias("test_rows"),
    )


def on_both_sides() -> Column:
    return (F.col("train_rows") > 0) & (F.col("test_rows") > 0)


def shared_feature_groups(df: DataFrame, features: Sequence[str], split: str = SPLIT) -> DataFrame:
    """Feature vectors found on both sides, with the rows of each side."""
    both = (F.col("train_rows") > 0) & (F.col("test_rows") > 0)
    return feature_groups(df, features, split).filter(both)


def feature_identical_rows(df: DataFrame, features: Sequence[str], split: str = SPLIT) -> DataFrame:
    """All rows of one side that have a feature-identical row on the other side.

    Values compare as columns do (``-0.0 = 0.0``).  Features must not be null, as
    in a feature frame.  Hot vectors, shared or on one side only, are broadcast, at most
    ``HOT_PARTS`` by counting, and settle their rows; the rest has no hot key and is
    joined by a shuffle.
    """
    features = list(features)
    groups = feature_groups(df, features, split)
    size = F.col("train_rows") + F.col("test_rows")
    both = (F.col("train_rows") > 0) & (F.col("test_rows") > 0)
    limit = groups.agg(F.sum(size)).scalar() / F.lit(HOT_PARTS)
    hot = groups.filter(size >= limit)
    cold = groups.filter((size < limit) & both).select(*features)
    from_hot = df.join(F.broadcast(hot.filter(both).select(*features)), features, "left_semi")
    from_cold = df.join(F.broadcast(hot.select(*features)), features, "left_anti").join(cold, features, "left_semi")
    return from_hot.unionByName(from_cold)


def feature_identical_summary(df: DataFrame, features: Sequence[str], split: str = SPLIT) -> DataFrame:
    """One row: sizes, rows with a counterpart on the other side, shares, shared vectors."""
    return summary_of_groups(feature_groups(df, features, split, values=False))


def summary_of_groups(groups: DataFrame) -> DataFrame:
    """``feature_identical_summary`` from the train and test rows of each vector."""
    shared = on_both_sides()

    def total(column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0))

    return (
        groups.agg(
            total(F.col("train_rows")).alias("train_size"),
            total(F.col("test_rows")).alias("test_size"),
            total(F.when(shared, F.col("test_rows"))).alias("test_with_counterpart"),
            total(F.when(shared, F.col("train_rows"))).alias("train_with_counterpart"),
            count_where(shared).alias("shared_vectors"),
        )
        .withColumns(
            {
                "pct_of_test": percentage(F.col("test_with_counterpart"), F.col("test_size")),
                "pct_of_train": percentage(F.col("train_with_counterpart"), F.col("train_size")),
            }
        )
    )


def label_split_comparison(df: DataFrame, label_col: str = "label", split: str = SPLIT) -> DataFrame:
    """Train and test rows of each label and on which side it occurs, from one aggregate."""
    counts = df.filter(F.col(label_col).isNotNull()).groupBy(F.col(label_col).alias("attack_type")).agg(
        count_where(F.col(split) == TRAIN).alias("train_count"),
        count_where(F.col(split) == TEST).alias("test_count"),
    )
    in_train, in_test = F.col("train_count") > 0, F.col("test_count") > 0
    status = (
        F.when(in_train & in_test, V.STATUS_BOTH).when(in_train, V.STATUS_TRAIN).otherwise(V.STATUS_TEST)
    )
    return (
        counts.filter(in_train | in_test)
        .withColumn("status", status)
        .orderBy(F.col("train_count").desc(), "attack_type")
    )


def split_status_counts(comparison: DataFrame) -> DataFrame:
    """Number of labels per status; a status without labels counts 0."""
    counted = comparison.agg(
        *[count_where(F.col("status") == s).alias(s) for s in (V.STATUS_BOTH, V.STATUS_TRAIN, V.STATUS_TEST)]
    )
    return counted.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(s).alias("status"), F.col(f"`{s}`").alias("labels")) for s in counted.columns]
            )
        )
    )


def common_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows found in both frames (columns matched by name)."""
    return left.intersect(right.select(*left.columns))


def frames_equal(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: same columns and types in order, and rows found on one side only.

    Rows are compared as multisets by one grouping of both frames together.
    """
    same_schema = [(f.name, f.dataType) for f in left.schema] == [(f.name, f.dataType) for f in right.schema]
    columns = [f"`{c}`" for c in left.columns]
    sided = left.select(*columns, F.lit(1).alias("_side")).unionByName(
        right.select(*columns, F.lit(-1).alias("_side"))
    )
    surplus = sided.groupBy(*columns).agg(F.sum("_side").alias("_surplus"))
    counts = surplus.agg(
        F.coalesce(F.sum(F.greatest(F.col("_surplus"), F.lit(0))), F.lit(0)).cast("bigint").alias("only_left"),
        F.coalesce(F.sum(F.greatest(-F.col("_surplus"), F.lit(0))), F.lit(0)).cast("bigint").alias("only_right"),
    )
    equal = F.lit(same_schema) & (F.col("only_left") == 0) & (F.col("only_right") == 0)
    return counts.withColumns({"same_schema": F.lit(same_schema), "equal": equal})
