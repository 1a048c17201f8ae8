"""Overlap and quality checks from stored digests; each equals the check that reads the rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowmedallion.queries import adapter as A
from flowmedallion.queries.evaluation_queries import _COARSE, _coarse
from flowmedallion.queries.registry import REGISTRY, query
from flowmedallion.sources import digests
from flowmedallion.sources.session import scratch_path

_WIDTH = len(A.FLOW_COLUMNS)


def _stored_by_features(spark, sf, name: str) -> str:
    digests.store_by_features(_coarse(spark, sf), name, _COARSE, path=scratch_path(spark, name))
    return name


@query("stored_identical_rows", REGISTRY["feature_identical_rows"].sql)
def _stored_identical_rows(spark, sf):
    return digests.stored_identical_rows(spark, _stored_by_features(spark, sf, "flowmedallion_vectors_rows"))


@query("stored_identical_summary", REGISTRY["feature_identical_summary"].sql)
def _stored_identical_summary(spark, sf):
    return digests.stored_identical_summary(spark, _stored_by_features(spark, sf, "flowmedallion_vectors_summary"))


def _two_loads(spark, sf, name: str) -> str:
    """Days of two loads; the second also brings rows of the first again, and is recorded twice."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    flows = A.flows(spark, sf)
    late = F.col("day_of_week").isin("Thursday", "Friday")
    digests.add_load_state(flows.filter(~late), name, 1, path=scratch_path(spark, name))
    for _ in range(2):
        digests.add_load_state(flows.filter(late | (F.col("protocol") == 6)), name, 2)
    return name


_LOADS_SQL = """, k AS (SELECT * FROM flows
                        UNION ALL SELECT * FROM flows WHERE protocol = 6 AND day_of_week NOT IN ('Thursday', 'Friday')),
     m AS (SELECT count(*) AS total, {} AS nulls, (SELECT count(*) FROM (SELECT DISTINCT * FROM k)) AS once FROM k)
   """.format(" + ".join(f"count(*) FILTER ({c} IS NULL)" for c in A.FLOW_COLUMNS))


@query(
    "quality_gate_loads",
    A.on_flows(
        f"""{_LOADS_SQL}
           SELECT 'max_null_ratio' AS rule, round(nulls / CAST(total * {_WIDTH} AS DOUBLE), 10) AS measured,
                  CAST(0.05 AS DOUBLE) AS threshold, nulls / CAST(total * {_WIDTH} AS DOUBLE) <= 0.05 AS passed FROM m
           UNION ALL
           SELECT 'max_duplicate_ratio', round((total - once) / CAST(total AS DOUBLE), 10), 0.01,
                  (total - once) / CAST(total AS DOUBLE) <= 0.01 FROM m
           UNION ALL
           SELECT 'min_rows_bronze', CAST(total AS DOUBLE), 1000, total >= 1000 FROM m"""
    ),
)
def _quality_gate_loads(spark, sf):
    gate = digests.state_quality_gate(spark, _two_loads(spark, sf, "flowmedallion_state_gate"))
    return gate.withColumn("measured", F.round("measured", 10))


@query(
    "duplicate_count_loads",
    A.on_flows(
        f"""{_LOADS_SQL}
           SELECT total AS total_rows, once AS distinct_rows, total - once AS duplicates FROM m"""
    ),
)
def _duplicate_count_loads(spark, sf):
    return digests.state_duplicate_count(spark, _two_loads(spark, sf, "flowmedallion_state_duplicates"))
