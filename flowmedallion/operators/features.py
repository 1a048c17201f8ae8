"""Flow features (Silver to Gold).

Constant columns are dropped in Silver, so every feature is added only when the
columns it needs are there.  Each group is one projection.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from flowmedallion import vocabulary as V
from flowmedallion.functions.expressions import is_one, ratio_or_zero

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType)


def _has(df: DataFrame, *names: str) -> bool:
    return all(n in df.columns for n in names)


def _wide(df: DataFrame, name: str) -> Column:
    """Integer counters as bigint, so that sums cannot overflow."""
    if isinstance(df.schema[name].dataType, INTEGERS):
        return F.col(name).cast("bigint")
    return F.col(name)


def _with(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    return df.withColumns(new) if new else df


def add_packet_aggregate_features(df: DataFrame) -> DataFrame:
    """``total_packets, total_bytes, fwd_bwd_packet_ratio, fwd_bwd_bytes_ratio, bytes_per_packet``."""
    new: dict[str, Column] = {}
    packets = ("total_fwd_packets", "total_backward_packets")
    lengths = ("fwd_packets_length_total", "bwd_packets_length_total")
    if _has(df, *packets):
        forward, backward = (_wide(df, c) for c in packets)
        new["total_packets"] = forward + backward
        new["fwd_bwd_packet_ratio"] = ratio_or_zero(forward, backward)
    if _has(df, *lengths):
        forward, backward = (_wide(df, c) for c in lengths)
        new["total_bytes"] = forward + backward
        new["fwd_bwd_bytes_ratio"] = ratio_or_zero(forward, backward)
    known = {c: F.col(c) for c in df.columns} | new
    if "total_packets" in known and "total_bytes" in known:
        new["bytes_per_packet"] = ratio_or_zero(known["total_bytes"], known["total_packets"])
    return _with(df, new)


def add_flag_aggregate_features(df: DataFrame) -> DataFrame:
    """``total_flag_count`` (null when any flag is null), ``has_syn_flag, has_rst_flag``."""
    flags = [c for c in V.FLAG_COLUMNS if c in df.columns]
    new: dict[str, Column] = {}
    if flags:
        new["total_flag_count"] = reduce(add, [_wide(df, c) for c in flags])
    for flag in ("syn", "rst"):
        if f"{flag}_flag_count" in flags:
            new[f"has_{flag}_flag"] = is_one(F.col(f"{flag}_flag_count") > 0)
    return _with(df, new)


def add_iat_features(df: DataFrame) -> DataFrame:
    """``flow_iat_range, active_range, idle_range, idle_active_ratio``."""
    new: dict[str, Column] = {}
    for stem in ("flow_iat", "active", "idle"):
        if _has(df, f"{stem}_max", f"{stem}_min"):
            new[f"{stem}_range"] = F.col(f"{stem}_max") - F.col(f"{stem}_min")
    if _has(df, "idle_mean", "active_mean"):
        new["idle_active_ratio"] = ratio_or_zero(F.col("idle_mean"), F.col("active_mean"))
    return _with(df, new)


def protocol_name(protocol: Column, data_type: T.DataType, accept_names: bool = False) -> Column:
    """Name of a protocol number, given as a number or as text; anything else is Other."""
    text = isinstance(data_type, T.StringType)
    number = protocol.try_cast("double") if text else protocol
    name = F.when(F.lit(False), F.lit(""))
    for value, label in V.PROTOCOL_NAMES.items():
        matches = number == value
        if text and accept_names:
            matches = matches | (F.upper(F.trim(protocol)) == label)
        name = name.when(matches, label)
    return name.otherwise(V.PROTOCOL_DEFAULT)


def add_protocol_name(df: DataFrame, accept_names: bool = False) -> DataFrame:
    if "protocol" not in df.columns:
        return df
    name = protocol_name(F.col("protocol"), df.schema["protocol"].dataType, accept_names)
    return df.withColumn("protocol_name", name)


def binary_target(label: Column) -> Column:
    """0 for benign in any case, 1 for everything else, null included."""
    return F.when(F.lower(label) == "benign", 0).otherwise(1)


def add_binary_target(df: DataFrame, label_col: str = "label") -> DataFrame:
    """``is_attack`` for learning; replaces the case-sensitive Silver column."""
    if label_col not in df.columns:
        return df
    return df.withColumn("is_attack", binary_target(F.col(label_col)))


def add_flow_efficiency_features(df: DataFrame) -> DataFrame:
    """``packet_rate`` and ``byte_rate`` (per microsecond), ``total_header_length, header_payload_ratio``."""
    new: dict[str, Column] = {}
    for rate, total in (("packet_rate", "total_packets"), ("byte_rate", "total_bytes")):
        if _has(df, total, "flow_duration"):
            new[rate] = ratio_or_zero(F.col(total), F.col("flow_duration"))
    if _has(df, "fwd_header_length", "bwd_header_length"):
        header = _wide(df, "fwd_header_length") + _wide(df, "bwd_header_length")
        new["total_header_length"] = header
        if _has(df, "total_bytes"):
            new["header_payload_ratio"] = ratio_or_zero(header, F.col("total_bytes"))
    return _with(df, new)
