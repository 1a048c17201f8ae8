"""Aggregate reports over Silver and Gold.

All are grouped by a low-cardinality column, so partial aggregates leave a few
rows per task to shuffle, whatever the share of the largest group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowmedallion.functions.expressions import percentage


def _ordered(df: DataFrame, measure: str, key: str) -> DataFrame:
    return df.orderBy(F.col(measure).desc(), F.col(key).asc_nulls_last())


def count_by(df: DataFrame, column: str, by_key: bool = False) -> DataFrame:
    """Rows per value, most frequent first (or in key order)."""
    counts = df.groupBy(column).agg(F.count("*").alias("row_count"))
    return counts.orderBy(column) if by_key else _ordered(counts, "row_count", column)


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """Rows and distinct non-null values of a column."""
    per_value = df.groupBy(column).agg(F.count("*").alias("_rows"))
    return per_value.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
        F.count(column).alias("distinct_values"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def share_of_total(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and their share of all rows in percent.

    The total is summed from the per-value counts, so the table is read once.
    """
    counts = df.groupBy(column).agg(F.count("*").alias("row_count"))
    total = counts.agg(F.sum("row_count")).scalar()
    return _ordered(counts.withColumn("percentage", percentage(F.col("row_count"), total)), "row_count", column)


def attack_rate_by(df: DataFrame, column: str, target: str = "is_attack") -> DataFrame:
    """Flows, attacks and attack rate in percent per value."""
    return (
        df.groupBy(column)
        .agg(F.count("*").alias("total_flows"), F.sum(target).cast("bigint").alias("attacks"))
        .withColumn("attack_rate", percentage(F.col("attacks"), F.col("total_flows")))
        .orderBy(column)
    )


def top_protocols(df: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` protocols with most bytes: flows, bytes, packets, bytes per packet."""
    return (
        df.groupBy("protocol_name")
        .agg(
            F.count("*").alias("flow_count"),
            F.sum("total_bytes").alias("total_bytes_sum"),
            F.sum("total_packets").alias("total_packets_sum"),
            F.round(F.avg("bytes_per_packet"), 2).alias("avg_bytes_per_packet"),
        )
        .orderBy(F.col("total_bytes_sum").desc_nulls_last(), "protocol_name")
        .limit(k)
    )


def averages_by(df: DataFrame, column: str) -> DataFrame:
    """Flows and average bytes and packets per value."""
    averages = df.groupBy(column).agg(
        F.count("*").alias("flow_count"),
        F.round(F.avg("total_bytes"), 2).alias("avg_bytes"),
        F.round(F.avg("total_packets"), 2).alias("avg_packets"),
    )
    return _ordered(averages, "flow_count", column)


def top_attack_types(df: DataFrame, label_col: str = "label", target: str = "is_attack") -> DataFrame:
    return count_by(df.filter(F.col(target) == 1), label_col)


def class_balance(df: DataFrame, target: str = "is_attack") -> DataFrame:
    """Benign rows, attack rows and attack percentage."""
    return df.agg(
        F.count(F.when(F.col(target) == 0, 1)).alias("benign"),
        F.count(F.when(F.col(target) == 1, 1)).alias("attacks"),
    ).withColumn("attack_percentage", percentage(F.col("attacks"), F.col("benign") + F.col("attacks")))
