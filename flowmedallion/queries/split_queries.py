"""Samples and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowmedallion.operators import sampling
from flowmedallion.queries import adapter as A
from flowmedallion.queries.registry import query

_ROW = ["bytes", "source_ip", "destination_ip", "port", "label", "is_attack"]
_ROW_SQL = ", ".join(_ROW)
SAMPLE = 20_000


@query(
    "random_n",
    A.on_flows(
        f"""SELECT bytes, source_ip, destination_ip, port, label FROM flows
            ORDER BY {A.digest_sql(A.KEYS, 42)} LIMIT 10"""
    ),
)
def _random_n(spark, sf):
    picked = sampling.random_rows(A.flows(spark, sf), 10, A.KEYS)
    return picked.select("bytes", "source_ip", "destination_ip", "port", "label")


@query(
    "stratified_sample",
    A.on_gold(
        f"""SELECT {_ROW_SQL} FROM gold
            WHERE {A.unit_sql(A.digest_sql(A.KEYS, 42))} < least(1.0, {SAMPLE}.0 / (SELECT count(*) FROM gold))"""
    ),
)
def _stratified_sample(spark, sf):
    sample = sampling.stratified_sample(A.gold(spark, sf), key_cols=A.KEYS, sample_size=SAMPLE)
    return sample.select(*_ROW)


@query("stratified_split", A.on_predictions(f"SELECT {_ROW_SQL}, split FROM predictions"))
def _stratified_split(spark, sf):
    return sampling.stratified_split(A.gold(spark, sf), A.KEYS).select(*_ROW, "split")


_EXACT_SQL = A.on_gold(
    f"""SELECT {_ROW_SQL}, CASE WHEN d <= cut THEN 'test' ELSE 'train' END AS split
        FROM (SELECT *, max(d) FILTER (place = quota) OVER (PARTITION BY is_attack) AS cut
              FROM (SELECT *, row_number() OVER (PARTITION BY is_attack ORDER BY d) AS place,
                           round(0.2 * count(*) OVER (PARTITION BY is_attack)) AS quota
                    FROM (SELECT *, {A.digest_sql(A.KEYS, 42)} AS d FROM gold)))"""
)


@query("stratified_split_exact", _EXACT_SQL)
def _stratified_split_exact(spark, sf):
    return sampling.stratified_split_exact(A.gold(spark, sf), key_cols=A.KEYS).select(*_ROW, "split")


@query("stratified_split_stored", _EXACT_SQL)
def _stratified_split_stored(spark, sf):
    return sampling.stratified_split_stored(A.gold(spark, sf), key_cols=A.KEYS).select(*_ROW, "split")


@query("temporal_split", A.on_predictions(f"SELECT {_ROW_SQL}, day_of_week, split FROM by_day"))
def _temporal_split(spark, sf):
    return sampling.temporal_split(A.gold(spark, sf)).select(*_ROW, "day_of_week", "split")


@query(
    "split_class_shares",
    A.on_predictions(
        """SELECT split, is_attack, count(*) AS row_count FROM predictions GROUP BY split, is_attack"""
    ),
)
def _split_class_shares(spark, sf):
    split = sampling.stratified_split(A.gold(spark, sf), A.KEYS)
    return split.groupBy("split", "is_attack").agg(F.count("*").alias("row_count"))
