"""Schema steps, row cleaning, label columns, Silver."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowmedallion.operators import cleaning as C
from flowmedallion.operators import schema as S
from flowmedallion.operators.encoding import feature_frame, one_hot_protocol, sanitize_numeric
from flowmedallion.plans.layers import clean_bronze_to_silver
from flowmedallion.queries import adapter as A
from flowmedallion.queries.registry import query

_KEY = "source_ip, destination_ip, protocol, port, bytes"
_KEY_COLUMNS = ["source_ip", "destination_ip", "protocol", "port", "bytes"]


def _messy(name: str) -> str:
    """A raw-file spelling of a clean column name."""
    return " " + name.replace("_", " ").title()


@query(
    "rename_all",
    A.on_flows('SELECT source_ip, "label", total_fwd_packets, flow_duration, bytes FROM flows'),
)
def _rename_all(spark, sf):
    columns = ["source_ip", "label", "total_fwd_packets", "flow_duration", "bytes"]
    raw = A.flows(spark, sf).select(*[F.col(c).alias(_messy(c)) for c in columns])
    return S.clean_columns(raw)


@query(
    "cast_types",
    A.on_flows(
        f"""SELECT TRY_CAST(port_text AS INTEGER) AS port, TRY_CAST(bytes_text AS BIGINT) AS bytes,
                   CAST(protocol AS VARCHAR) AS protocol, {A.text_sql('TRY_CAST(ts_text AS TIMESTAMP)')} AS ts,
                   source_ip
            FROM (SELECT *, CASE WHEN port = 70000 THEN 'n/a' ELSE CAST(port AS VARCHAR) END AS port_text,
                         CAST(bytes AS VARCHAR) AS bytes_text,
                         CASE WHEN port = 70000 THEN 'unknown' ELSE {A.text_sql('"timestamp"')} END AS ts_text
                  FROM flows)"""
    ),
)
def _cast_types(spark, sf):
    odd = F.col("port") == 70000
    raw = A.flows(spark, sf).select(
        F.when(odd, "n/a").otherwise(F.col("port").cast("string")).alias("port"),
        F.col("bytes").cast("string").alias("bytes"),
        "protocol",
        F.when(odd, "unknown").otherwise(A.as_text("timestamp")).alias("timestamp"),
        "source_ip",
    )
    return S.cast_types(raw).withColumn("ts", A.as_text("timestamp")).drop("timestamp")


@query(
    "align_columns",
    A.on_flows(
        """SELECT label, bytes, 0 AS port FROM flows WHERE day_of_week IN ('Monday', 'Tuesday', 'Wednesday')
           UNION ALL
           SELECT label, 0 AS bytes, port FROM flows WHERE day_of_week NOT IN ('Monday', 'Tuesday', 'Wednesday')"""
    ),
)
def _align_columns(spark, sf):
    flows = A.flows(spark, sf)
    early = F.col("day_of_week").isin("Monday", "Tuesday", "Wednesday")
    left, right = S.align_columns(
        flows.filter(early).select("label", "bytes"), flows.filter(~early).select("port", "label")
    )
    return left.union(right)


@query(
    "union_by_name",
    A.on_flows(
        """SELECT source_ip, label, bytes, 'lineitem' AS origin FROM flows
           UNION ALL
           SELECT event_type, props, event_id, 'events' FROM events"""
    ),
)
def _union_by_name(spark, sf):
    first = A.flows(spark, sf).select("source_ip", "label", "bytes", F.lit("lineitem").alias("origin"))
    second = A.table(spark, sf, "events").select(
        F.lit("events").alias("origin"),
        F.col("event_id").alias("bytes"),
        F.col("props").alias("label"),
        F.col("event_type").alias("source_ip"),
    )
    return S.union_by_name([first, second])


@query(
    "dedup_exact",
    A.on_flows(
        f"""SELECT DISTINCT {', '.join(c for c in A.FLOW_COLUMNS if c != '"timestamp"')}, {A.text_sql('"timestamp"')} AS ts
            FROM (SELECT * FROM flows UNION ALL SELECT * FROM flows WHERE protocol = 6)"""
    ),
)
def _dedup_exact(spark, sf):
    """Whole rows, many of them twice."""
    flows = A.flows(spark, sf)
    twice = flows.unionByName(flows.filter("protocol = 6"))
    return C.remove_duplicates(twice).withColumn("ts", A.as_text("timestamp")).drop("timestamp")


@query(
    "dedup_all_columns",
    A.on_flows(f"SELECT {_KEY}, flow_duration, label, bwd_packets_length_total, {A.text_sql('\"timestamp\"')} AS ts FROM flows"),
)
def _dedup_all_columns(spark, sf):
    """Every flow twice; over all columns exactly one copy of each is left."""
    flows = A.flows(spark, sf)
    return C.remove_duplicates(flows.union(flows)).select(
        *_KEY_COLUMNS, "flow_duration", "label", "bwd_packets_length_total", A.as_text("timestamp").alias("ts")
    )


@query(
    "drop_critical_nulls",
    A.on_flows(f"SELECT {_KEY}, label FROM flows WHERE label IS NOT NULL AND source_ip IS NOT NULL"),
)
def _drop_critical_nulls(spark, sf):
    flows = A.flows(spark, sf).select(*_KEY_COLUMNS, "label")
    return C.handle_nulls(flows, critical_columns=["source_ip", "label"])


@query(
    "fill_string_nulls",
    A.on_flows(
        """SELECT source_ip, port, coalesce(label, 'unknown') AS label,
                  coalesce(CAST(protocol AS VARCHAR), 'unknown') AS protocol FROM flows"""
    ),
)
def _fill_string_nulls(spark, sf):
    flows = A.flows(spark, sf).select("source_ip", "port", "label", F.col("protocol").cast("string").alias("protocol"))
    return C.handle_nulls(flows)


@query("filter_bytes", A.on_flows(f"SELECT {_KEY} FROM flows WHERE bytes >= 0 OR bytes IS NULL"))
def _filter_bytes(spark, sf):
    flows = A.flows(spark, sf)
    return flows.filter(C.valid_bytes(flows)).select(*_KEY_COLUMNS)


@query("filter_port", A.on_flows(f"SELECT {_KEY} FROM flows WHERE port BETWEEN 0 AND 65535 OR port IS NULL"))
def _filter_port(spark, sf):
    flows = A.flows(spark, sf)
    return flows.filter(C.valid_port(flows)).select(*_KEY_COLUMNS)


@query(
    "filter_invalid",
    A.on_flows(
        f"""SELECT {_KEY} FROM flows WHERE (bytes >= 0 OR bytes IS NULL)
            AND (port BETWEEN 0 AND 65535 OR port IS NULL)"""
    ),
)
def _filter_invalid(spark, sf):
    return C.filter_invalid_values(A.flows(spark, sf)).select(*_KEY_COLUMNS)


@query(
    "standardize_labels",
    A.on_flows(
        """SELECT bytes, CASE trim(label, ' ') WHEN 'Web Attack ' || chr(92) || 'x96 XSS' THEN 'Web Attack - XSS'
                              WHEN 'DoS Hulk' THEN 'DoS-Hulk' ELSE trim(label, ' ') END AS label
           FROM flows"""
    ),
)
def _standardize_labels(spark, sf):
    return C.standardize_labels(A.flows(spark, sf).select("bytes", "label"))


@query("silver_is_attack", A.on_silver("SELECT bytes, label, is_attack FROM silver"))
def _silver_is_attack(spark, sf):
    return A.silver(spark, sf).select("bytes", "label", "is_attack")


@query("attack_category", A.on_silver("SELECT bytes, label, attack_category FROM silver"))
def _attack_category(spark, sf):
    return A.silver(spark, sf).select("bytes", "label", "attack_category")


@query("distinct_labels", A.on_silver("SELECT DISTINCT label FROM silver"))
def _distinct_labels(spark, sf):
    return A.silver(spark, sf).select("label").distinct()


_CONSTANT_SQL = A.on_flows(
    "SELECT name AS \"column\" FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c.strip(chr(34))}' AS name, count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n FROM flows"
        for c in A.FLOW_COLUMNS
        if c not in ("label", "_source_file")
    )
    + ") WHERE n <= 1"
)


@query("constant_columns", _CONSTANT_SQL)
def _constant_columns(spark, sf):
    return C.constant_columns(A.flows(spark, sf))


# The columns of the flow view that vary, as the oracle of constant_columns lists the others.
_VARYING = [
    c
    for c in A.FLOW_COLUMNS
    if c not in ("fin_flag_count", "psh_flag_count", "cwr_flag_count", "active_min", "idle_max", "idle_min")
]
_VARYING_SQL = ", ".join(c for c in _VARYING if c != '"timestamp"') + f", {A.text_sql('\"timestamp\"')} AS ts"


@query("drop_constant", A.on_flows(f"SELECT {_VARYING_SQL} FROM flows"))
def _drop_constant(spark, sf):
    kept = C.drop_constant_columns(A.flows(spark, sf))
    return kept.withColumn("ts", A.as_text("timestamp")).drop("timestamp")


@query(
    "bronze_to_silver",
    A.on_silver(f"SELECT {_VARYING_SQL}, is_attack, attack_category FROM silver"),
)
def _bronze_to_silver(spark, sf):
    """The whole cleaning; every flow arrives twice, so de-duplication has work to do."""
    flows = A.flows(spark, sf)
    cleaned = clean_bronze_to_silver(flows.union(flows))
    return cleaned.withColumn("ts", A.as_text("timestamp")).drop("timestamp")


@query(
    "cleaning_step_counts",
    A.on_flows(
        """, twice AS (SELECT * FROM flows UNION ALL SELECT * FROM flows),
             once AS (SELECT DISTINCT * EXCLUDE (score) FROM twice),
             complete AS (SELECT * FROM once WHERE source_ip IS NOT NULL AND destination_ip IS NOT NULL
                                              AND label IS NOT NULL)
           SELECT 0 AS position, 'input' AS step, count(*) AS row_count FROM twice
           UNION ALL SELECT 1, 'remove_duplicates', count(*) FROM once
           UNION ALL SELECT 2, 'handle_nulls', count(*) FROM complete
           UNION ALL SELECT 3, 'filter_invalid_values', count(*) FROM complete
             WHERE (bytes >= 0 OR bytes IS NULL) AND (port BETWEEN 0 AND 65535 OR port IS NULL)"""
    ),
)
def _cleaning_step_counts(spark, sf):
    flows = A.flows(spark, sf)
    return C.cleaning_step_counts(flows.union(flows))


@query(
    "one_hot_protocol",
    A.on_gold(
        """SELECT bytes, CASE WHEN protocol_name = 'ICMP' THEN 1 ELSE 0 END AS protocol_ICMP,
                  CASE WHEN protocol_name = 'Other' THEN 1 ELSE 0 END AS protocol_Other,
                  CASE WHEN protocol_name = 'TCP' THEN 1 ELSE 0 END AS protocol_TCP,
                  CASE WHEN protocol_name = 'UDP' THEN 1 ELSE 0 END AS protocol_UDP
           FROM gold"""
    ),
)
def _one_hot_protocol(spark, sf):
    return one_hot_protocol(A.gold(spark, sf).select("bytes", "protocol_name"))


@query(
    "sanitize_numeric",
    A.on_flows(
        """SELECT bytes AS id,
             CASE WHEN flow_duration = 0 THEN 0 ELSE CAST(CAST(total_fwd_packets / flow_duration AS FLOAT) AS DOUBLE) END AS rate,
             CASE WHEN active_mean = 0 THEN 0 ELSE CAST(CAST(idle_mean / active_mean AS FLOAT) AS DOUBLE) END AS ratio,
             CAST(coalesce(port, 0) AS DOUBLE) AS port
           FROM flows"""
    ),
)
def _sanitize_numeric(spark, sf):
    infinity, missing = F.lit(float("inf")), F.lit(float("nan"))
    raw = A.flows(spark, sf).select(
        F.col("bytes").alias("id"),
        F.when(F.col("flow_duration") == 0, infinity)
        .otherwise(F.col("total_fwd_packets") / F.col("flow_duration"))
        .alias("rate"),
        F.when(F.col("active_mean") == 0, missing)
        .otherwise(F.col("idle_mean") / F.col("active_mean"))
        .alias("ratio"),
        "port",
    )
    columns = ["rate", "ratio", "port"]
    clean = sanitize_numeric(raw, columns)
    return clean.withColumns({c: F.col(c).cast("double") for c in columns})


_FEATURES = [
    "protocol", "port", "bytes", "total_fwd_packets", "total_backward_packets", "fwd_packets_length_total",
    "bwd_packets_length_total", "fin_flag_count", "syn_flag_count", "rst_flag_count", "psh_flag_count",
    "ack_flag_count", "cwr_flag_count", "ece_flag_count", "flow_iat_max", "flow_iat_min", "active_max",
    "active_min", "active_mean", "idle_max", "idle_min", "idle_mean", "fwd_header_length",
    "bwd_header_length", "flow_duration", "total_packets", "total_bytes", "fwd_bwd_packet_ratio",
    "fwd_bwd_bytes_ratio", "bytes_per_packet", "total_flag_count", "has_syn_flag", "has_rst_flag",
    "flow_iat_range", "active_range", "idle_range", "idle_active_ratio", "packet_rate", "byte_rate",
    "total_header_length", "header_payload_ratio",
]
FEATURES_SQL = ", ".join(
    [f"CAST(coalesce(CAST({c} AS FLOAT), 0) AS DOUBLE) AS {c}" for c in _FEATURES]
    + [
        f"CAST(CASE WHEN protocol_name = '{p}' THEN 1 ELSE 0 END AS DOUBLE) AS protocol_{p}"
        for p in ("ICMP", "Other", "TCP", "UDP")
    ]
)


@query("feature_frame", A.on_gold(f"SELECT label, day_of_week, is_attack, {FEATURES_SQL} FROM gold"))
def _feature_frame(spark, sf):
    frame = feature_frame(A.gold(spark, sf))
    kept = ("label", "day_of_week", "is_attack")
    return frame.select(*kept, *[F.col(c).cast("double").alias(c) for c in frame.columns if c not in kept])
