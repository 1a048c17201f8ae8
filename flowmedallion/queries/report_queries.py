"""Profiles and aggregate reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowmedallion.operators import profiling as P
from flowmedallion.operators import reports as R
from flowmedallion.queries import adapter as A
from flowmedallion.queries.registry import query


@query("row_count", A.on_flows("SELECT count(*) AS row_count FROM flows"))
def _row_count(spark, sf):
    return P.row_count(A.flows(spark, sf))


@query("count_by_label", A.on_gold("SELECT label, count(*) AS row_count FROM gold GROUP BY label"))
def _count_by_label(spark, sf):
    return R.count_by(A.gold(spark, sf), "label")


@query(
    "count_by_category",
    A.on_silver("SELECT attack_category, count(*) AS row_count FROM silver GROUP BY attack_category"),
)
def _count_by_category(spark, sf):
    return R.count_by(A.silver(spark, sf), "attack_category")


@query("count_by_day", A.on_flows("SELECT day_of_week, count(*) AS row_count FROM flows GROUP BY day_of_week"))
def _count_by_day(spark, sf):
    return R.count_by(A.flows(spark, sf), "day_of_week", by_key=True)


@query("count_by_target", A.on_gold("SELECT is_attack, count(*) AS row_count FROM gold GROUP BY is_attack"))
def _count_by_target(spark, sf):
    return R.count_by(A.gold(spark, sf), "is_attack", by_key=True)


@query("count_by_protocol", A.on_gold("SELECT protocol_name, count(*) AS row_count FROM gold GROUP BY protocol_name"))
def _count_by_protocol(spark, sf):
    return R.count_by(A.gold(spark, sf), "protocol_name")


@query(
    "count_distinct_files",
    A.on_flows("SELECT count(*) AS row_count, count(DISTINCT _source_file) AS distinct_values FROM flows"),
)
def _count_distinct_files(spark, sf):
    return R.distinct_count(A.flows(spark, sf), "_source_file")


@query(
    "null_counts",
    A.on_flows(
        " UNION ALL ".join(
            f"SELECT '{c.strip(chr(34))}' AS \"column\", count(*) - count({c}) AS nulls FROM flows"
            for c in A.FLOW_COLUMNS
        )
    ),
)
def _null_counts(spark, sf):
    return P.null_counts(A.flows(spark, sf))


@query(
    "table_profile",
    A.on_flows(
        " UNION ALL ".join(
            f"""SELECT '{c.strip(chr(34))}' AS "column", count(*) AS row_count, count(*) - count({c}) AS nulls,
                       {"false" if c in ("label", "_source_file") else
                        f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) <= 1"} AS constant
                FROM flows"""
            for c in A.FLOW_COLUMNS
        )
    ),
)
def _table_profile(spark, sf):
    return P.profile(A.flows(spark, sf))


@query(
    "duplicate_count",
    A.on_flows(
        """, k AS (SELECT * FROM flows UNION ALL SELECT * FROM flows WHERE protocol = 6),
             d AS (SELECT DISTINCT * FROM k)
           SELECT (SELECT count(*) FROM k) AS total_rows, (SELECT count(*) FROM d) AS distinct_rows,
                  (SELECT count(*) FROM k) - (SELECT count(*) FROM d) AS duplicates"""
    ),
)
def _duplicate_count(spark, sf):
    """Whole rows, some of them twice."""
    flows = A.flows(spark, sf)
    return P.duplicate_count(flows.unionByName(flows.filter("protocol = 6")))


_DESCRIBED = ["total_packets", "total_bytes", "bytes_per_packet", "total_flag_count"]


@query(
    "describe_features",
    A.on_gold(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count({c}) AS value_count, round(avg({c}), 4) AS mean,
                       round(stddev_samp({c}), 4) AS stddev, CAST(min({c}) AS DOUBLE) AS min,
                       CAST(max({c}) AS DOUBLE) AS max FROM gold"""
            for c in _DESCRIBED
        )
    ),
)
def _describe_features(spark, sf):
    described = P.describe_features(A.gold(spark, sf), _DESCRIBED)
    return described.withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


@query(
    "quality_gate",
    A.on_flows(
        f""", m AS (
             SELECT CAST(count(*) AS DOUBLE) AS total,
                    CAST({" + ".join(f"count(*) FILTER ({c} IS NULL)" for c in A.FLOW_COLUMNS)} AS DOUBLE) AS nulls,
                    (SELECT CAST(count(*) AS DOUBLE) FROM (SELECT DISTINCT * FROM flows)) AS once
             FROM flows)
           SELECT 'max_null_ratio' AS rule, round(nulls / (total * {len(A.FLOW_COLUMNS)}), 10) AS measured,
                  CAST(0.05 AS DOUBLE) AS threshold, nulls / (total * {len(A.FLOW_COLUMNS)}) <= 0.05 AS passed FROM m
           UNION ALL
           SELECT 'max_duplicate_ratio', round((total - once) / total, 10), 0.01, (total - once) / total <= 0.01 FROM m
           UNION ALL
           SELECT 'min_rows_bronze', total, 1000, total >= 1000 FROM m"""
    ),
)
def _quality_gate(spark, sf):
    gate = P.quality_gate(A.flows(spark, sf))
    return gate.withColumn("measured", F.round("measured", 10))


@query(
    "layer_counts",
    A.on_gold(
        """SELECT 'bronze' AS layer, count(*) AS row_count FROM flows
           UNION ALL SELECT 'silver', count(*) FROM silver
           UNION ALL SELECT 'gold', count(*) FROM gold"""
    ),
)
def _layer_counts(spark, sf):
    return P.layer_counts(
        {"bronze": A.flows(spark, sf), "silver": A.silver(spark, sf), "gold": A.gold(spark, sf)}
    )


@query(
    "share_of_total",
    A.on_gold(
        """SELECT protocol_name, count(*) AS row_count,
                  round(CAST(count(*) AS DOUBLE) * 100.0 / (SELECT count(*) FROM gold), 2) AS percentage
           FROM gold GROUP BY protocol_name"""
    ),
)
def _share_of_total(spark, sf):
    return R.share_of_total(A.gold(spark, sf), "protocol_name")


def _rate_sql(column: str) -> str:
    return A.on_gold(
        f"""SELECT {column}, count(*) AS total_flows, CAST(sum(is_attack) AS BIGINT) AS attacks,
                   round(CAST(sum(is_attack) AS DOUBLE) * 100.0 / count(*), 2) AS attack_rate
            FROM gold GROUP BY {column}"""
    )


@query("attack_rate_by_day", _rate_sql("day_of_week"))
def attack_rate_by_day(spark, sf):
    return R.attack_rate_by(A.gold(spark, sf), "day_of_week")


@query("attack_rate_by_syn", _rate_sql("has_syn_flag"))
def _attack_rate_by_syn(spark, sf):
    return R.attack_rate_by(A.gold(spark, sf), "has_syn_flag")


@query(
    "top_protocols",
    A.on_gold(
        """SELECT protocol_name, count(*) AS flow_count, round(sum(total_bytes), 2) AS total_bytes_sum,
                  CAST(sum(total_packets) AS BIGINT) AS total_packets_sum,
                  round(avg(bytes_per_packet), 2) AS avg_bytes_per_packet
           FROM gold GROUP BY protocol_name ORDER BY sum(total_bytes) DESC, protocol_name LIMIT 5"""
    ),
)
def _top_protocols(spark, sf):
    return R.top_protocols(A.gold(spark, sf)).withColumn("total_bytes_sum", F.round("total_bytes_sum", 2))


def _averages_sql(column: str) -> str:
    return A.on_gold(
        f"""SELECT {column}, count(*) AS flow_count, round(avg(total_bytes), 2) AS avg_bytes,
                   round(avg(total_packets), 2) AS avg_packets FROM gold GROUP BY {column}"""
    )


@query("avg_by_protocol", _averages_sql("protocol_name"))
def _avg_by_protocol(spark, sf):
    return R.averages_by(A.gold(spark, sf), "protocol_name")


@query("avg_by_label", _averages_sql("label"))
def _avg_by_label(spark, sf):
    return R.averages_by(A.gold(spark, sf), "label")


@query(
    "top_attack_types",
    A.on_gold("SELECT label, count(*) AS row_count FROM gold WHERE is_attack = 1 GROUP BY label"),
)
def _top_attack_types(spark, sf):
    return R.top_attack_types(A.gold(spark, sf))


@query(
    "class_balance",
    A.on_gold(
        """SELECT count(*) FILTER (is_attack = 0) AS benign, count(*) FILTER (is_attack = 1) AS attacks,
                  round(100.0 * count(*) FILTER (is_attack = 1) / CAST(count(*) AS DOUBLE), 2) AS attack_percentage
           FROM gold"""
    ),
)
def _class_balance(spark, sf):
    return R.class_balance(A.gold(spark, sf))
