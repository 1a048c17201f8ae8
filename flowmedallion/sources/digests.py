"""Digests kept in bucketed tables, so that overlap and quality checks do not shuffle the rows again.

A digest is 128 bits, two 64-bit hashes of the same columns under different seeds, and stands for the values:
null is a value, ``-0.0`` equals ``0.0`` and NaN equals NaN, as they do when Spark groups.  Tables are
bucketed by both halves, so grouping by digest and joining on it read each bucket in one task, without an exchange.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowmedallion.functions.hashing import DIGEST, digest_columns
from flowmedallion.operators.leakage import HOT_PARTS, feature_groups, on_both_sides, summary_of_groups
from flowmedallion.operators.profiling import duplicates_of_totals, gate_of_totals, totals_of_groups
from flowmedallion.operators.sampling import SPLIT
from flowmedallion.sources.session import materialize
from flowmedallion.sources.tables import LOAD_ID, drop_partition, get_property, insert_partitions, set_property

COPIES, NULLS = "_copies", "_nulls"
ROWS_PER_BUCKET, LEAST_BUCKETS = 1_000_000, 8
STATE_COLUMNS, STATE_BUCKETS = "flowmedallion.state_columns", "flowmedallion.state_buckets"


def buckets_for(rows: int) -> int:
    """Buckets for so many rows, so that a bucket, which one task reads, does not grow with the table."""
    return max(LEAST_BUCKETS, math.ceil(rows / ROWS_PER_BUCKET))


def _bucketed(df: DataFrame, name: str, buckets: int, path: str | None, partition_by: Sequence[str] = ()) -> None:
    """Write a table bucketed by digest, each bucket by one task."""
    writer = df.repartition(buckets, *DIGEST).write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.partitionBy(*partition_by).bucketBy(buckets, *DIGEST).saveAsTable(name)


# -- overlap of train and test ------------------------------------------------------------


def store_by_features(
    df: DataFrame, name: str, features: Sequence[str], buckets: int | None = None, path: str | None = None
) -> None:
    """Store rows by the digest of their features: ``name``, bucketed, and ``name_hot``, as the rows come.

    Vectors that hold at least 1/HOT_PARTS of all rows, so at most HOT_PARTS of them, are hot: their rows
    would fill single buckets, and lie in ``name_hot``.  All columns are kept.  The number of buckets follows the number of
    rows unless it is given.
    """
    rows = df.withColumns(digest_columns(features))
    counts = materialize(rows.groupBy(*DIGEST).agg(F.count("*").alias(COPIES)), "vectors")
    if buckets is None:
        buckets = buckets_for(counts.agg(F.sum(COPIES)).first()[0] or 0)
    limit = counts.agg(F.sum(COPIES)).scalar() / F.lit(HOT_PARTS)
    hot = F.broadcast(materialize(counts.filter(F.col(COPIES) >= limit).select(*DIGEST), "hot-vectors"))
    _bucketed(rows.join(hot, DIGEST, "left_anti"), name, buckets, path)
    writer = rows.join(hot, DIGEST, "left_semi").write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", f"{path}_hot")
    writer.saveAsTable(f"{name}_hot")


def stored_feature_groups(spark: SparkSession, name: str, split: str = SPLIT) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of every stored feature vector, by digest: of other vectors, without an exchange, and of hot ones."""
    return feature_groups(spark.read.table(name), DIGEST, split), feature_groups(spark.read.table(f"{name}_hot"), DIGEST, split)


def stored_identical_rows(spark: SparkSession, name: str, split: str = SPLIT) -> DataFrame:
    """All rows of ``store_by_features`` with a feature-identical row on the other side, as they were stored.

    Groups and rows of a bucket meet in one task by a hash join, with neither exchange nor sort of the
    rows.  Hot vectors are at most HOT_PARTS groups, combined in each task, and are broadcast.
    """
    groups, hot_groups = (g.filter(on_both_sides()).select(*DIGEST) for g in stored_feature_groups(spark, name, split))
    cold = spark.read.table(name).join(groups.hint("shuffle_hash"), DIGEST, "left_semi")
    hot = spark.read.table(f"{name}_hot").join(F.broadcast(hot_groups), DIGEST, "left_semi")
    return cold.unionByName(hot).drop(*DIGEST)


def stored_identical_summary(spark: SparkSession, name: str, split: str = SPLIT) -> DataFrame:
    """``feature_identical_summary`` from the stored digests; reads the digests and the split column only."""
    groups, hot_groups = stored_feature_groups(spark, name, split)
    return summary_of_groups(groups.unionByName(hot_groups))


# -- state of loads -----------------------------------------------------------------------


def add_load_state(df: DataFrame, name: str, load_id: int, buckets: int | None = None, path: str | None = None) -> None:
    """Record one load in a state table: each distinct row's digest, its copies, and its number of nulls.

    The table is partitioned by load and bucketed by digest; unless given, the number of buckets follows
    the rows of the first load and stays.  Copies collapse before the shuffle.  The
    same load again replaces itself; a load with other columns than the first is refused.
    """
    spark, columns = df.sparkSession, json.dumps(df.columns)
    nulls = sum((F.when(F.col(f"`{c}`").isNull(), 1).otherwise(0) for c in df.columns), F.lit(0))
    state = (
        df.select(*[c.alias(n) for n, c in digest_columns(df.columns).items()], nulls.alias(NULLS))
        .groupBy(*DIGEST)
        .agg(F.count("*").alias(COPIES), F.first(NULLS).alias(NULLS))
        .withColumn(LOAD_ID, F.lit(load_id))
    )
    if not spark.catalog.tableExists(name):
        buckets = buckets_for(df.count()) if buckets is None else buckets
        _bucketed(state, name, buckets, path, (LOAD_ID,))
        set_property(spark, name, STATE_COLUMNS, columns)
        set_property(spark, name, STATE_BUCKETS, str(buckets))
        return
    known = get_property(spark, name, STATE_COLUMNS)
    if known != columns:
        raise ValueError(f"{name} holds the state of {known}, not of {columns}")
    buckets = int(get_property(spark, name, STATE_BUCKETS))
    if spark.read.table(name).filter(F.col(LOAD_ID) == load_id).isEmpty() or not df.isEmpty():
        insert_partitions(state.repartition(buckets, *DIGEST), name)
    else:
        drop_partition(spark, name, {LOAD_ID: load_id})


def _state_totals(spark: SparkSession, name: str, load_id: int | None) -> DataFrame:
    state = spark.read.table(name)
    if load_id is not None:
        state = state.filter(F.col(LOAD_ID) <= load_id)
    return totals_of_groups(state.groupBy(*DIGEST).agg(F.sum(COPIES).alias(COPIES), F.first(NULLS).alias(NULLS)))


def state_duplicate_count(spark: SparkSession, name: str, load_id: int | None = None) -> DataFrame:
    """``duplicate_count`` of all loads, or of those up to one, from the state alone."""
    return duplicates_of_totals(_state_totals(spark, name, load_id))


def state_quality_gate(
    spark: SparkSession, name: str, thresholds: dict[str, float] | None = None, load_id: int | None = None
) -> DataFrame:
    """``quality_gate`` of all loads, or of those up to one, from the state alone.

    After an increment only its own rows are read, to record it; copies of a row in
    different loads meet by digest, bucket by bucket, without an exchange.
    """
    width = len(json.loads(get_property(spark, name, STATE_COLUMNS)))
    return gate_of_totals(_state_totals(spark, name, load_id), width, thresholds)
