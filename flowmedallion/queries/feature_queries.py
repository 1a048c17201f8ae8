"""Flow features and Gold."""

from __future__ import annotations

from flowmedallion.operators import features as X
from flowmedallion.plans.layers import clean_bronze_to_silver, transform_silver_to_gold
from flowmedallion.queries import adapter as A
from flowmedallion.queries.cleaning_queries import _VARYING
from flowmedallion.queries.registry import query


@query("packet_features", A.on_flows(f"SELECT bytes, {A.PACKET_SQL} FROM flows"))
def _packet_features(spark, sf):
    return X.add_packet_aggregate_features(A.flows(spark, sf)).select(
        "bytes", "total_packets", "total_bytes", "fwd_bwd_packet_ratio", "fwd_bwd_bytes_ratio", "bytes_per_packet"
    )


@query("flag_features", A.on_flows(f"SELECT bytes, {A.FLAG_SQL} FROM flows"))
def _flag_features(spark, sf):
    return X.add_flag_aggregate_features(A.flows(spark, sf)).select(
        "bytes", "total_flag_count", "has_syn_flag", "has_rst_flag"
    )


@query("iat_features", A.on_flows(f"SELECT bytes, {A.IAT_SQL} FROM flows"))
def _iat_features(spark, sf):
    return X.add_iat_features(A.flows(spark, sf)).select(
        "bytes", "flow_iat_range", "active_range", "idle_range", "idle_active_ratio"
    )


@query("protocol_name", A.on_silver(f"SELECT bytes, protocol, {A.PROTOCOL_SQL} FROM silver"))
def _protocol_name(spark, sf):
    return X.add_protocol_name(A.silver(spark, sf)).select("bytes", "protocol", "protocol_name")


@query("gold_is_attack", A.on_gold("SELECT bytes, label, is_attack FROM gold"))
def _gold_is_attack(spark, sf):
    return X.add_binary_target(A.silver(spark, sf)).select("bytes", "label", "is_attack")


@query(
    "efficiency_features",
    A.on_gold("SELECT bytes, packet_rate, byte_rate, total_header_length, header_payload_ratio FROM gold"),
)
def _efficiency_features(spark, sf):
    packets = X.add_packet_aggregate_features(A.silver(spark, sf))
    return X.add_flow_efficiency_features(packets).select(
        "bytes", "packet_rate", "byte_rate", "total_header_length", "header_payload_ratio"
    )


# Gold after constant columns went: flags that remain add up, ranges of constants are gone.
_GOLD_COLUMNS = ", ".join(c for c in _VARYING if c != '"timestamp"')
_GOLD_NEW = """total_packets, total_bytes, fwd_bwd_packet_ratio, fwd_bwd_bytes_ratio, bytes_per_packet,
  total_flag_count, has_syn_flag, has_rst_flag, flow_iat_range, idle_active_ratio, protocol_name,
  packet_rate, byte_rate, total_header_length, header_payload_ratio, is_attack, attack_category"""


@query("silver_to_gold", A.on_gold(f"SELECT {_GOLD_COLUMNS}, {_GOLD_NEW} FROM gold"))
def _silver_to_gold(spark, sf):
    return transform_silver_to_gold(clean_bronze_to_silver(A.flows(spark, sf))).drop("timestamp")
