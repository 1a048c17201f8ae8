"""Synthetic flows drawn from a hash of each row's id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowmedallion import vocabulary as V
from flowmedallion.functions.hashing import digest_unit, row_digest


def _pick(values: tuple, draw: Column) -> Column:
    index = F.floor(draw * len(values)).cast("int") + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), index)


def _pick_weighted(weighted: tuple, draw: Column) -> Column:
    picked, bound = None, 0.0
    for value, weight in weighted[:-1]:
        bound = round(bound + weight, 10)
        picked = F.when(draw < bound, value) if picked is None else picked.when(draw < bound, value)
    return picked.otherwise(weighted[-1][0])


def synthesize_flows(ids: DataFrame, id_col: str = "id", seed: int = V.SEED) -> DataFrame:
    """One synthetic flow per id; the same id gives the same flow on any partitioning."""

    def draw(name: str) -> Column:
        return digest_unit(row_digest([F.lit(name), F.col(id_col)], seed))

    low, high = V.SYNTH_BYTES
    second = F.floor(draw("timestamp") * (V.SYNTH_SECONDS + 1)).cast("int")
    moment = F.lit(V.SYNTH_START).cast("timestamp_ntz") + F.make_dt_interval(secs=second)
    return ids.select(
        F.col(id_col),
        _pick(V.SYNTH_SOURCES, draw("source_ip")).alias("source_ip"),
        _pick(V.SYNTH_DESTINATIONS, draw("destination_ip")).alias("destination_ip"),
        _pick(V.SYNTH_PROTOCOLS, draw("protocol")).alias("protocol"),
        _pick(V.SYNTH_PORTS, draw("port")).alias("port"),
        (F.floor(draw("bytes") * (high - low + 1)) + low).cast("bigint").alias("bytes"),
        _pick_weighted(V.SYNTH_LABELS, draw("label")).alias("label"),
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
    )


def generate_sample_dataset(
    spark: SparkSession, output_path: str, n_rows: int = 10_000, seed: int = V.SEED
) -> str:
    """Write ``n_rows`` synthetic flows as CSV under ``output_path``; returns the entry's path."""
    target = f"{output_path.rstrip('/')}/flow_sample.csv"
    flows = synthesize_flows(spark.range(n_rows), seed=seed).drop("id")
    flows.write.mode("overwrite").option("header", True).csv(target)
    return target
