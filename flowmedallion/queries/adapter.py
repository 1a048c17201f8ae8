"""The given tables seen as flow tables, in Spark and, independently, in SQL.

``lineitem`` is projected to a flow table that has every case the operators
handle: odd labels, nulls, values out of range, zeros, constants, ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowmedallion.operators import cleaning as C
from flowmedallion.operators import features as X
from flowmedallion.operators.sampling import stratified_split, temporal_split
from flowmedallion.operators.schema import cast_types

# Columns that tell flows of this view apart and print alike in every engine.
KEYS = [
    "bytes",
    "source_ip",
    "destination_ip",
    "protocol",
    "port",
    "total_fwd_packets",
    "total_backward_packets",
    "ack_flag_count",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _flows(lineitem: DataFrame) -> DataFrame:
    order, part, line = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    forward = F.col("l_quantity").cast("bigint")
    backward = F.round(F.col("l_tax") * 100).cast("bigint")
    day = F.date_format("l_shipdate", "EEEE")
    protocol = (
        F.when(line == 2, 17).when(line == 3, 1).when(line == 4, 0).when(line == 7, F.lit(None)).otherwise(6)
    )
    label = (
        F.when((flag == "N") & (status == "O"), " BENIGN ")
        .when(flag == "N", "Benign")
        .when((flag == "A") & (status == "F"), "DoS Hulk")
        .when(flag == "A", "PortScan")
        .when(status == "F", "Web Attack \\x96 XSS")
        .when(order % 50 == 0, F.lit(None))
        .otherwise("Bot")
    )
    return lineitem.select(
        F.concat(F.lit("192.168.1."), F.col("l_suppkey") % 50).alias("source_ip"),
        F.concat(F.lit("10.0.0."), part % 20).alias("destination_ip"),
        protocol.cast("int").alias("protocol"),
        F.when(order % 97 == 0, 70000).when(order % 89 == 0, F.lit(None)).otherwise(part % 1024).cast("int").alias("port"),
        (order * 7 - 100).alias("bytes"),
        label.alias("label"),
        F.col("l_shipdate").alias("timestamp"),
        day.alias("day_of_week"),
        forward.alias("total_fwd_packets"),
        backward.alias("total_backward_packets"),
        F.col("l_extendedprice").alias("fwd_packets_length_total"),
        F.when(F.col("l_discount") == 0, 0.0)
        .otherwise(F.col("l_extendedprice") * F.col("l_discount"))
        .alias("bwd_packets_length_total"),
        F.lit(0).alias("fin_flag_count"),
        F.when(line == 1, part % 3).otherwise(0).cast("int").alias("syn_flag_count"),
        F.when(line == 3, 1).otherwise(0).alias("rst_flag_count"),
        F.lit(0).alias("psh_flag_count"),
        (part % 5).cast("int").alias("ack_flag_count"),
        F.lit(0).alias("cwr_flag_count"),
        F.when(line == 2, F.lit(None)).otherwise(0).cast("int").alias("ece_flag_count"),
        F.col("l_extendedprice").alias("flow_iat_max"),
        F.col("l_quantity").alias("flow_iat_min"),
        F.col("l_quantity").alias("active_max"),
        F.lit(1.0).alias("active_min"),
        F.round(F.col("l_tax") * 100).alias("active_mean"),
        F.lit(0.0).alias("idle_max"),
        F.lit(0.0).alias("idle_min"),
        F.round(F.col("l_discount") * 100).alias("idle_mean"),
        (forward * 20).alias("fwd_header_length"),
        (backward * 20).alias("bwd_header_length"),
        F.when(order % 31 == 0, 0).otherwise(order % 10000).alias("flow_duration"),
        F.concat(F.lit("flows-"), day, F.lit(".parquet")).alias("_source_file"),
        F.col("l_discount").alias("score"),
    )


def scored_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flow view with a score in [0, 0.1] that has many ties."""
    return _flows(table(spark, sf_dir, "lineitem"))


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flow view as it would arrive in Bronze (no duplicates in it)."""
    return scored_flows(spark, sf_dir).drop("score")


def _clean(df: DataFrame) -> DataFrame:
    """All row rules of the cleaning, without the two whole-table steps."""
    df = df.filter(C.not_null(C.default_critical_columns(df)) & C.valid_values(df))
    return C.add_derived_columns(cast_types(C.standardize_labels(df)))


def _featured(df: DataFrame) -> DataFrame:
    for step in (
        X.add_packet_aggregate_features,
        X.add_flag_aggregate_features,
        X.add_iat_features,
        X.add_protocol_name,
        X.add_binary_target,
        X.add_flow_efficiency_features,
    ):
        df = step(df)
    return df


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(flows(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _featured(silver(spark, sf_dir))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold rows with a score and the predictions of two threshold models."""
    featured = _featured(_clean(scored_flows(spark, sf_dir)))
    return featured.withColumns(
        {
            "pred": F.when(F.col("score") >= 0.05, 1).otherwise(0),
            "champion_pred": F.when(F.col("score") >= 0.05, 1).otherwise(0),
            "candidate_pred": F.when(F.col("score") >= 0.03, 1).otherwise(0),
        }
    )


def split_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_split(predictions(spark, sf_dir), KEYS)


def temporal_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal_split(predictions(spark, sf_dir))


# --- the same views in SQL, written on their own ---

_FLOWS = """
flows AS (
  SELECT
    '192.168.1.' || CAST(l_suppkey % 50 AS VARCHAR) AS source_ip,
    '10.0.0.' || CAST(l_partkey % 20 AS VARCHAR) AS destination_ip,
    CASE l_linenumber WHEN 1 THEN 6 WHEN 2 THEN 17 WHEN 3 THEN 1 WHEN 4 THEN 0
                      WHEN 7 THEN NULL ELSE 6 END AS protocol,
    CASE WHEN l_orderkey % 97 = 0 THEN 70000
         WHEN l_orderkey % 89 = 0 THEN NULL
         ELSE CAST(l_partkey % 1024 AS INTEGER) END AS port,
    l_orderkey * 7 - 100 AS bytes,
    CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN ' BENIGN '
         WHEN l_returnflag = 'N' THEN 'Benign'
         WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'DoS Hulk'
         WHEN l_returnflag = 'A' THEN 'PortScan'
         WHEN l_linestatus = 'F' THEN 'Web Attack ' || chr(92) || 'x96 XSS'
         WHEN l_orderkey % 50 = 0 THEN NULL
         ELSE 'Bot' END AS label,
    l_shipdate AS "timestamp",
    dayname(l_shipdate) AS day_of_week,
    CAST(l_quantity AS BIGINT) AS total_fwd_packets,
    CAST(round(l_tax * 100) AS BIGINT) AS total_backward_packets,
    l_extendedprice AS fwd_packets_length_total,
    CASE WHEN l_discount = 0 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice * l_discount END
      AS bwd_packets_length_total,
    0 AS fin_flag_count,
    CASE WHEN l_linenumber = 1 THEN CAST(l_partkey % 3 AS INTEGER) ELSE 0 END AS syn_flag_count,
    CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END AS rst_flag_count,
    0 AS psh_flag_count,
    CAST(l_partkey % 5 AS INTEGER) AS ack_flag_count,
    0 AS cwr_flag_count,
    CASE WHEN l_linenumber = 2 THEN NULL ELSE 0 END AS ece_flag_count,
    l_extendedprice AS flow_iat_max,
    l_quantity AS flow_iat_min,
    l_quantity AS active_max,
    CAST(1 AS DOUBLE) AS active_min,
    round(l_tax * 100) AS active_mean,
    CAST(0 AS DOUBLE) AS idle_max,
    CAST(0 AS DOUBLE) AS idle_min,
    round(l_discount * 100) AS idle_mean,
    20 * CAST(l_quantity AS BIGINT) AS fwd_header_length,
    20 * CAST(round(l_tax * 100) AS BIGINT) AS bwd_header_length,
    CASE WHEN l_orderkey % 31 = 0 THEN 0 ELSE l_orderkey % 10000 END AS flow_duration,
    'flows-' || dayname(l_shipdate) || '.parquet' AS _source_file,
    l_discount AS score
  FROM lineitem
)"""

_SILVER = """
labelled AS (
  SELECT * REPLACE (
    CASE trim(label, ' ')
      WHEN 'Web Attack ' || chr(92) || 'x96 XSS' THEN 'Web Attack - XSS'
      WHEN 'DoS Hulk' THEN 'DoS-Hulk'
      ELSE trim(label, ' ') END AS label,
    CAST(protocol AS VARCHAR) AS protocol)
  FROM flows
  WHERE source_ip IS NOT NULL AND destination_ip IS NOT NULL AND label IS NOT NULL
    AND (bytes >= 0 OR bytes IS NULL)
    AND (port BETWEEN 0 AND 65535 OR port IS NULL)
),
silver AS (
  SELECT *,
    CASE WHEN label = 'BENIGN' THEN 0 ELSE 1 END AS is_attack,
    CASE WHEN label = 'BENIGN' THEN 'Benign'
         WHEN label IN ('DoS-Hulk', 'DoS-GoldenEye', 'DoS-Slowloris', 'DoS-SlowHTTPTest', 'DDoS') THEN 'DoS'
         WHEN label = 'PortScan' THEN 'Probe'
         WHEN label IN ('Brute Force', 'FTP-Patator', 'SSH-Patator') THEN 'Brute Force'
         WHEN label LIKE 'Web Attack%' THEN 'Web Attack'
         WHEN label IN ('Bot', 'Infiltration', 'Heartbleed') THEN 'Other Attack'
         ELSE 'Unknown' END AS attack_category
  FROM labelled
)"""

PACKET_SQL = """
    total_fwd_packets + total_backward_packets AS total_packets,
    fwd_packets_length_total + bwd_packets_length_total AS total_bytes,
    CASE WHEN total_backward_packets = 0 THEN 0.0
         ELSE CAST(total_fwd_packets AS DOUBLE) / total_backward_packets END AS fwd_bwd_packet_ratio,
    CASE WHEN bwd_packets_length_total = 0 THEN 0.0
         ELSE fwd_packets_length_total / bwd_packets_length_total END AS fwd_bwd_bytes_ratio,
    CASE WHEN total_fwd_packets + total_backward_packets = 0 THEN 0.0
         ELSE (fwd_packets_length_total + bwd_packets_length_total)
              / (total_fwd_packets + total_backward_packets) END AS bytes_per_packet"""

FLAG_SQL = """
    CAST(fin_flag_count + syn_flag_count + rst_flag_count + psh_flag_count + ack_flag_count
         + cwr_flag_count + ece_flag_count AS BIGINT) AS total_flag_count,
    CASE WHEN syn_flag_count > 0 THEN 1 ELSE 0 END AS has_syn_flag,
    CASE WHEN rst_flag_count > 0 THEN 1 ELSE 0 END AS has_rst_flag"""

IAT_SQL = """
    flow_iat_max - flow_iat_min AS flow_iat_range,
    active_max - active_min AS active_range,
    idle_max - idle_min AS idle_range,
    CASE WHEN active_mean = 0 THEN 0.0 ELSE idle_mean / active_mean END AS idle_active_ratio"""

PROTOCOL_SQL = """
    CASE protocol WHEN '6' THEN 'TCP' WHEN '17' THEN 'UDP' WHEN '1' THEN 'ICMP'
                  ELSE 'Other' END AS protocol_name"""

EFFICIENCY_SQL = """
    CASE WHEN flow_duration = 0 THEN 0.0
         ELSE CAST(total_packets AS DOUBLE) / flow_duration END AS packet_rate,
    CASE WHEN flow_duration = 0 THEN 0.0 ELSE total_bytes / flow_duration END AS byte_rate,
    fwd_header_length + bwd_header_length AS total_header_length,
    CASE WHEN total_bytes = 0 THEN 0.0
         ELSE (fwd_header_length + bwd_header_length) / total_bytes END AS header_payload_ratio"""

_GOLD = f"""
featured AS (
  SELECT * REPLACE (CASE WHEN lower(label) = 'benign' THEN 0 ELSE 1 END AS is_attack),
    {PACKET_SQL},{FLAG_SQL},{IAT_SQL},{PROTOCOL_SQL}
  FROM silver
),
gold AS (SELECT *, {EFFICIENCY_SQL} FROM featured)"""


def digest_sql(columns: list[str], seed: int) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns)
    return f"md5(concat_ws('|', '{seed}', {parts}))"


def unit_sql(digest: str) -> str:
    return f"(CAST('0x' || substr({digest}, 1, 8) AS BIGINT) / 4294967296.0)"


_PREDICTIONS = f"""
predictions AS (
  SELECT *,
    CASE WHEN score >= 0.05 THEN 1 ELSE 0 END AS pred,
    CASE WHEN score >= 0.05 THEN 1 ELSE 0 END AS champion_pred,
    CASE WHEN score >= 0.03 THEN 1 ELSE 0 END AS candidate_pred,
    CASE WHEN substr({digest_sql(KEYS, 42)}, 1, 8) < '33333333' THEN 'test' ELSE 'train' END AS split
  FROM gold
),
by_day AS (
  SELECT * REPLACE (CASE WHEN day_of_week IN ('Thursday', 'Friday') THEN 'test' ELSE 'train' END AS split)
  FROM predictions
  WHERE day_of_week IN ('Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday')
)"""

FLOW_COLUMNS = [
    "source_ip", "destination_ip", "protocol", "port", "bytes", "label", '"timestamp"', "day_of_week",
    "total_fwd_packets", "total_backward_packets", "fwd_packets_length_total", "bwd_packets_length_total",
    "fin_flag_count", "syn_flag_count", "rst_flag_count", "psh_flag_count", "ack_flag_count",
    "cwr_flag_count", "ece_flag_count", "flow_iat_max", "flow_iat_min", "active_max", "active_min",
    "active_mean", "idle_max", "idle_min", "idle_mean", "fwd_header_length", "bwd_header_length",
    "flow_duration", "_source_file",
]


def on_flows(body: str) -> str:
    return f"WITH {_FLOWS} {body}"


def on_silver(body: str) -> str:
    return f"WITH {_FLOWS}, {_SILVER} {body}"


def on_gold(body: str) -> str:
    return f"WITH {_FLOWS}, {_SILVER}, {_GOLD} {body}"


def on_predictions(body: str, *more: str) -> str:
    """``more`` are further named queries (``name AS (...)``) before the body."""
    return "WITH " + ", ".join([_FLOWS, _SILVER, _GOLD, _PREDICTIONS, *more]) + " " + body


def as_text(column: str) -> Column:
    """A moment as text, so that time types of two engines compare."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def text_sql(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"
