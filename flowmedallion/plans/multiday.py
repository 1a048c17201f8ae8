"""Multi-day and incremental loads over catalog tables."""

from __future__ import annotations

import json
from collections.abc import Sequence
from contextlib import nullcontext
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowmedallion.operators import reports
from flowmedallion.operators.cleaning import is_plain
from flowmedallion.operators.profiling import layer_counts
from flowmedallion.operators.schema import align_to_schema
from flowmedallion.plans.layers import clean_bronze_to_silver, cleaned_rows, constants_of, transform_silver_to_gold
from flowmedallion.sources.readers import ingest_multi_day
from flowmedallion.sources.session import materialized
from flowmedallion.sources.tables import (
    LOAD_ID,
    append_table,
    get_property,
    overwrite_partitions,
    partition_rows,
    replace_table,
    set_property,
    table_partitions,
    write_table,
)

CONSTANTS = "flowmedallion.constants"
"""Table property: the columns that the load dropped as constant, with their values as text."""


@dataclass(frozen=True)
class Layers:
    """Names of the three layer tables and, for external tables, their folder."""

    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    location: str | None = None

    def path(self, name: str) -> str | None:
        return f"{self.location}/{name}" if self.location else None


def load_layers(
    spark: SparkSession,
    bronze: DataFrame,
    layers: Layers,
    label_col: str = "label",
    fmt: str = "parquet",
    load_id: str | None = None,
    gather: bool = True,
) -> DataFrame:
    """Write bronze, silver and gold; each layer is read back from its table.

    Gold is partitioned by day, so that the temporal split and reports by day
    read only the days they need, and, with a ``load_id``, by load as well, so that
    increments can be repeated.  Silver's files hold one day each, so Gold is written as
    it is read from them, without a shuffle.  With ``gather=False`` Bronze and Silver are written as they come, too: only
    rows that may have a copy are shuffled, and a day has a file for each task that held rows of it.
    """

    def store(df: DataFrame, name: str, more: tuple[str, ...] = (), gather: bool = True) -> DataFrame:
        days = ("day_of_week",) if "day_of_week" in df.columns else ()
        write_table(df, name, fmt=fmt, path=layers.path(name), partition_by=(*days, *more), gather=gather)
        return spark.read.table(name)

    stored_bronze = store(bronze, layers.bronze, gather=gather)
    together = [] if gather else [c for c in table_partitions(spark, layers.bronze) if c in bronze.columns]
    silver = store(clean_bronze_to_silver(stored_bronze, label_col=label_col, together=together, stored=True), layers.silver, gather=gather)
    features = transform_silver_to_gold(silver, label_col)
    if load_id is None:
        gold = store(features, layers.gold, gather=False)
    else:
        gold = store(features.withColumn(LOAD_ID, F.lit(load_id)), layers.gold, (LOAD_ID,), gather=False)
    dropped = [c for c in stored_bronze.columns if c not in silver.columns]
    set_property(spark, layers.gold, CONSTANTS, json.dumps(constants_of(stored_bronze, dropped, label_col)))
    return gold


def load_multi_day(spark: SparkSession, input_path: str, layers: Layers) -> DataFrame:
    """All day files of a folder through the three layers; returns Gold."""
    bronze = ingest_multi_day(spark, input_path)
    if bronze is None:
        raise ValueError(f"no day files in {input_path}")
    return load_layers(spark, bronze, layers, gather=False)


def layer_reports(spark: SparkSession, layers: Layers) -> dict[str, DataFrame]:
    """The reports of a finished load, each a lazy frame."""
    bronze, silver, gold = (spark.read.table(n) for n in (layers.bronze, layers.silver, layers.gold))
    found = {
        "layer_counts": layer_counts({"bronze": bronze, "silver": silver, "gold": gold}),
        "share_by_target": reports.share_of_total(gold, "is_attack"),
        "count_by_label": reports.count_by(gold, "label"),
        "top_attack_types": reports.top_attack_types(gold),
    }
    optional = {
        "attack_category": ("count_by_category", reports.count_by),
        "protocol_name": ("share_by_protocol", reports.share_of_total),
        "day_of_week": ("attack_rate_by_day", reports.attack_rate_by),
        "has_syn_flag": ("attack_rate_by_syn", reports.attack_rate_by),
    }
    for column, (name, report) in optional.items():
        if column in gold.columns:
            found[name] = report(gold, column)
    if {"total_bytes", "total_packets"} <= set(gold.columns):
        found["averages_by_label"] = reports.averages_by(gold, "label")
    return found


def varying_columns(silver: DataFrame, extra: list[str], known: dict | None, gold_table: str) -> list[str]:
    """Those of the columns that the table lacks which are more than the constant they were (one aggregate)."""
    if not extra:
        return []
    texts = {c: F.col(f"`{c}`").cast("string") for c in extra}
    if known is not None:
        differs = {c: F.lit(True) if c not in known else ~texts[c].eqNullSafe(F.lit(known[c])) for c in extra}
        found = silver.agg(*[F.max(differs[c]).alias(c) for c in extra]).first()
    else:
        spread = lambda x: F.count_distinct(x) + F.max(x.isNull().cast("int")) > 1
        found = silver.agg(*[spread(texts[c]).alias(c) for c in extra]).first()
    return [c for c in extra if found[c]]


def take_in(gold_table: str, silver: DataFrame, columns: list[str], known: dict, label_col: str) -> None:
    """Give the table columns that it dropped as constant, filled with their value, and work its features out anew."""
    spark = silver.sparkSession
    table = spark.read.table(gold_table)
    filled = table.withColumns({c: F.lit(known[c]).cast(silver.schema[c].dataType) for c in columns})
    replace_table(transform_silver_to_gold(filled, label_col), gold_table, gather=False)
    rest = {c: value for c, value in known.items() if c not in columns}
    set_property(spark, gold_table, CONSTANTS, json.dumps(rest))


def _partitions_given(new_rows: DataFrame, gold_table: str) -> list[str]:
    """The table's partition columns, by which the rows can be brought together; none if the rows lack one."""
    found = table_partitions(new_rows.sparkSession, gold_table)
    return found if set(found) <= set(new_rows.columns) else []


def increment_to_gold(
    new_rows: DataFrame,
    gold_table: str,
    label_col: str = "label",
    evolve: bool = False,
    together: Sequence[str] = (),
    stored: bool = False,
) -> DataFrame:
    """New Bronze rows through cleaning and features, on the columns that the table was built from.

    Columns that the table dropped as constant must still hold their one value (where it
    is not on record, one value within the increment), and there may be no other column
    that the table lacks: such an increment is refused, because its features and values
    would not mean what the table's mean.  With ``evolve``, columns whose constant is on record are taken
    into the table first: its rows get the constant, and all features are worked out again.
    ``together`` and ``stored`` as in ``clean_bronze_to_silver``.
    """
    spark = new_rows.sparkSession
    table = spark.read.table(gold_table)
    silver = clean_bronze_to_silver(new_rows, label_col=label_col, drop_constants=False, together=together, stored=stored)
    extra = [c for c in silver.columns if c not in table.columns]
    recorded = get_property(spark, gold_table, CONSTANTS)
    known = None if recorded is None else json.loads(recorded)
    # copies do not make a column vary, so it is measured before the shuffle
    changed = varying_columns(cleaned_rows(new_rows, label_col), extra, known, gold_table)
    if evolve and known is not None and changed and set(changed) <= set(known):
        take_in(gold_table, silver, changed, known, label_col)
        extra = [c for c in extra if c not in changed]
    elif changed:
        raise ValueError(f"columns that {gold_table} does not have vary now: {', '.join(changed)}")
    return transform_silver_to_gold(silver.drop(*extra), label_col)


def append_increment(
    new_rows: DataFrame,
    gold_table: str,
    label_col: str = "label",
    evolve: bool = False,
    load_id: str | None = None,
    gather: bool = True,
) -> None:
    """Append new Bronze rows to the Gold table, in the columns of that table.

    With a ``load_id``, for a table that is partitioned by load, an increment that is repeated replaces
    its own rows, whatever part of an earlier run was written.  Its new rows are stored while it runs, since they are read
    several times, and ``gather`` is as in ``load_layers``.
    """
    spark = new_rows.sparkSession
    by_load = LOAD_ID in table_partitions(spark, gold_table)
    if by_load != (load_id is not None):
        raise ValueError(f"{gold_table} is {'' if by_load else 'not '}partitioned by load, so it {'needs' if by_load else 'takes no'} load_id")
    if load_id is None:
        together = _partitions_given(new_rows, gold_table)
        rows = increment_to_gold(new_rows, gold_table, label_col, evolve, together)
        append_table(rows, gold_table, drop_extra=True, gather=not together)
        return
    partitions, plain = table_partitions(spark, gold_table), is_plain(new_rows)
    together = [] if gather else [c for c in partitions if c in new_rows.columns]
    with materialized(new_rows, "increment") if plain else nullcontext(new_rows) as given:
        rows = increment_to_gold(given, gold_table, label_col, evolve, together, stored=plain)
        table = spark.read.table(gold_table)
        own = {tuple(row) for row in partition_rows(table.filter(F.col(LOAD_ID) == load_id), partitions)}
        aligned = align_to_schema(rows.withColumn(LOAD_ID, F.lit(load_id)), table.schema, drop_extra=True)
        overwrite_partitions(aligned, gold_table, own, gather=gather)
