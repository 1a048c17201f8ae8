"""Row cleaning and label columns (Bronze to Silver).

Everything here is lazy except ``drop_constant_columns``, whose result schema
depends on the data and which therefore looks at it first.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from flowmedallion import vocabulary as V
from flowmedallion.functions.expressions import is_one
from flowmedallion.functions.hashing import PLACE, is_flat, row_hash, row_keys, row_place
from flowmedallion.operators.profiling import checked_columns, constant_columns, varying_in_head
from flowmedallion.sources.session import materialize

MAX_PORT = 65_535
PROBE_ROWS = 1000
MOST_SHARED = 1_000_000
"""Hashes of more than one row that are broadcast."""


def is_plain(df: DataFrame) -> bool:
    """Whether equal rows have equal hashes: columns of plain numbers, texts and times, each with a name of its own."""
    names = {c.lower() for c in df.columns}
    return 0 < len(names) == len(df.columns) and all(is_flat(f.dataType) for f in df.schema.fields)


def _unused(name: str, df: DataFrame) -> str:
    """The name, made longer until the frame has no column of it."""
    while name in {c.lower() for c in df.columns}:
        name += "_"
    return name


def remove_duplicates(
    df: DataFrame, subset: list[str] | None = None, collapse_first: bool = False, together: Sequence[str] = ()
) -> DataFrame:
    """Exact duplicates over all columns, metadata included, or over ``subset``.

    Rows of plain columns go to their task by a hash of their values and are compared, value by value, there only:
    no task holds more distinct rows than its share of the shuffle, whatever the size of the tasks before it.
    Every copy travels.  ``collapse_first`` drops copies before the shuffle as well, for frames of few
    distinct rows or with rows that make up much of the frame; each task then holds all its distinct rows.
    So it is for a subset, for nested and collated columns, whose equality the hash does not follow, for streams, and
    for columns that share a name.  With ``together`` the tasks after the shuffle hold ranges of these columns, so that
    a table partitioned by them can be written without gathering its rows again; the input is read once more, to find
    the ranges.
    """
    if subset or collapse_first or df.isStreaming or not is_plain(df):
        once = df.dropDuplicates(subset) if subset else df.dropDuplicates()
        return once.hint("rebalance", *together) if together else once
    place = _unused(PLACE, df)
    placed = df.withColumn(place, row_place(df.columns))
    placed = placed.repartitionByRange(*together, place) if together else placed.repartition(place)
    return placed.dropDuplicates().drop(place)


def remove_stored_duplicates(df: DataFrame, together: Sequence[str] = (), most_shared: int = MOST_SHARED) -> DataFrame:
    """``remove_duplicates`` of a frame that gives the same rows whenever it is read, such as a stored one.

    Eager: a first pass shuffles nothing but a 64-bit hash of each row and keeps those that rows share.  A row with a hash of its
    own has no copy and stays in its task; only the others are shuffled whole and compared, value by value.  Where more than
    ``most_shared`` hashes are shared, too many to broadcast, all rows are shuffled, as in ``remove_duplicates``.
    """
    if not is_plain(df):
        return remove_duplicates(df, together=together)
    name = _unused("_hash", df)
    hashes = df.select(row_hash(df.columns).alias(name)).repartition(name).groupBy(name)
    shared = materialize(hashes.agg(F.count("*").alias("_rows")).filter("_rows > 1").select(name), "shared-hashes")
    found = shared.limit(most_shared + 1).count()
    if found > most_shared:
        return remove_duplicates(df, together=together)
    if not found:
        return df
    hashed = df.withColumn(name, row_hash(df.columns))
    alone, others = (hashed.join(F.broadcast(shared), name, how).select(*[F.col(f"`{c}`") for c in df.columns]) for how in ("left_anti", "left_semi"))
    return alone.unionByName(remove_duplicates(others))


def not_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns], F.lit(True))


def handle_nulls(
    df: DataFrame,
    critical_columns: Sequence[str] | None = None,
    fill_value: str = "unknown",
) -> DataFrame:
    """Drop rows that miss a critical column; fill the other nulls of text columns."""
    if critical_columns:
        df = df.dropna(how="any", subset=list(critical_columns))
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.fillna(fill_value, subset=text) if text else df


def _number(df: DataFrame, name: str) -> Column:
    """The column itself when numeric, so that the filter reaches the file scan."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.col(name).try_cast("double")
    return F.col(name)


def valid_bytes(df: DataFrame) -> Column:
    return (_number(df, "bytes") >= 0) | F.col("bytes").isNull()


def valid_port(df: DataFrame) -> Column:
    port = _number(df, "port")
    return port.between(0, MAX_PORT) | F.col("port").isNull()


def valid_values(df: DataFrame) -> Column:
    """Both range rules, for the columns that are present."""
    rules = F.lit(True)
    if "bytes" in df.columns:
        rules = rules & valid_bytes(df)
    if "port" in df.columns:
        rules = rules & valid_port(df)
    return rules


def filter_invalid_values(df: DataFrame) -> DataFrame:
    """Keep rows whose bytes are not negative and whose port is in range; null passes."""
    return df.filter(valid_values(df))


def _label_spellings() -> dict[str, str]:
    spellings = dict(V.LABEL_SPELLINGS)
    for raw, canonical in V.LABEL_SPELLINGS.items():
        for dash in V.DASH_SPELLINGS:
            spellings[raw.replace(V.DASH_TEXT, dash)] = canonical
    return spellings


def _lookup(values: dict[str, str], key: Column) -> Column:
    """Value of a key in a small fixed table, else null; names the key expression only once."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), key)


def canonical_label(label: Column, unify_benign: bool = False) -> Column:
    """Trimmed label under its canonical name; unknown labels are kept."""
    label = F.trim(label)
    result = F.coalesce(_lookup(_label_spellings(), label), label)
    return F.when(F.lower(result) == "benign", "BENIGN").otherwise(result) if unify_benign else result


def standardize_labels(df: DataFrame, label_col: str = "label", unify_benign: bool = False) -> DataFrame:
    if label_col not in df.columns:
        return df
    return df.withColumn(label_col, canonical_label(F.col(label_col), unify_benign))


def drop_constant_columns(
    df: DataFrame,
    protected_columns: Sequence[str] = ("label",),
    measured_on: DataFrame | None = None,
    probe_rows: int = PROBE_ROWS,
) -> DataFrame:
    """Drop columns with at most one distinct value, null counting as a value.

    A column that varies within the first ``probe_rows`` rows varies in the whole
    table, so only the others are measured, by one aggregate whose scan reads
    just those columns.  ``measured_on`` may name a cheaper frame with the same
    values, such as the frame before de-duplication.
    """
    measured = measured_on if measured_on is not None else df
    open_columns = checked_columns(measured, protected_columns)
    if probe_rows and open_columns:
        varying = varying_in_head(measured.select(*open_columns), probe_rows)
        open_columns = [c for c in open_columns if c not in varying]
    if not open_columns:
        return df
    constants = constant_columns(measured.select(*open_columns), protected_columns)
    return df.drop(*[row["column"] for row in constants.collect()])


def silver_is_attack(label: Column) -> Column:
    return F.when(label == "BENIGN", 0).otherwise(1)


def attack_category(label: Column) -> Column:
    by_label = {label: name for name, labels in V.CATEGORY_LABELS.items() for label in labels}
    by_prefix = [F.when(label.like(f"{prefix}%"), name) for name, prefix in V.CATEGORY_PREFIXES.items()]
    return F.coalesce(_lookup(by_label, label), *by_prefix, F.lit(V.CATEGORY_DEFAULT))


def add_derived_columns(df: DataFrame, label_col: str = "label") -> DataFrame:
    """``is_attack`` (case-sensitive) and ``attack_category`` from the label."""
    if label_col not in df.columns:
        return df
    label = F.col(label_col)
    return df.withColumns({"is_attack": silver_is_attack(label), "attack_category": attack_category(label)})


def default_critical_columns(df: DataFrame) -> list[str]:
    return [c for c in V.CRITICAL_COLUMNS if c in df.columns]


def cleaning_step_counts(df: DataFrame, critical_columns: Sequence[str] | None = None) -> DataFrame:
    """Rows left after each cleaning step, all from one pass (one row per step)."""
    if critical_columns is None:
        critical_columns = default_critical_columns(df)
    complete = not_null(critical_columns)
    # Copies of a row agree on every rule, so the rules are read once per distinct row, known by its digest.
    rules = {"_complete": is_one(complete), "_valid": is_one(complete & valid_values(df))}
    totals = (
        df.groupBy(*row_keys(df))
        .agg(F.count("*").alias("_copies"), *[F.first(rule).alias(name) for name, rule in rules.items()])
        .agg(
            F.coalesce(F.sum("_copies"), F.lit(0)).alias("input"),
            F.count("*").alias("remove_duplicates"),
            F.coalesce(F.sum("_complete"), F.lit(0)).cast("bigint").alias("handle_nulls"),
            F.coalesce(F.sum("_valid"), F.lit(0)).cast("bigint").alias("filter_invalid_values"),
        )
    )
    return totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).alias("position"), F.lit(c).alias("step"), F.col(c).alias("row_count"))
                    for i, c in enumerate(totals.columns)
                ]
            )
        )
    )
