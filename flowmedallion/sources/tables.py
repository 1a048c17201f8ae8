"""Layer tables: overwrite, append, keyed upsert, compaction, load log."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from contextlib import AbstractContextManager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowmedallion.operators.schema import align_to_schema
from flowmedallion.sources.session import materialize, materialized, split_methods, unsorted_writes

LOAD_ID = "_load_id"
FROM_LOAD, TO_LOAD = "_from_load", "_to_load"
OPEN = 2**31 - 1
"""_to_load of rows that no load has replaced."""
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
OWN_PROPERTIES = ("spark.", "transient_", "numFiles", "totalSize", "rawDataSize", "numRows", "EXTERNAL", "option.")


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def gathered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The frame with the rows of one partition in few tasks, so that each writes few files.

    Adaptive execution sizes the tasks and splits a partition that is too large for one.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def rename_path(spark: SparkSession, old: str, new: str) -> None:
    """Rename a file or folder on whatever file system it lies."""
    paths = [spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in (old, new)]
    system = paths[0].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.exists(paths[0]) and not system.rename(*paths):
        raise OSError(f"cannot rename {old}")


def write_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    path: str | None = None,
    partition_by: tuple[str, ...] = (),
    gather: bool = True,
) -> None:
    """Replace a table; the schema may change.  ``fmt="delta"`` works where its package is present.

    ``gather=False`` spares the shuffle of a frame whose rows come, row by row, from a table with these partitions, or
    were cleaned with these columns ``together``: its tasks hold rows of few partitions as it is.  They write the files of
    several partitions at a time and sort nothing.
    """
    writer = (gathered(df, partition_by) if gather else df).write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    if path:
        writer = writer.option("path", path)
    with split_methods(df.sparkSession), _writes(df.sparkSession, gather):
        writer.partitionBy(*partition_by).saveAsTable(name)


def _writes(spark: SparkSession, gather: bool) -> AbstractContextManager:
    """Settings for writing rows that were gathered, or that come as they are."""
    return nullcontext() if gather else unsorted_writes(spark)


def set_property(spark: SparkSession, name: str, key: str, value: str) -> None:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{key}' = '{escaped}')")


def get_property(spark: SparkSession, name: str, key: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return next((r["value"] for r in rows if r["key"] == key), None)


def append_table(df: DataFrame, name: str, fmt: str = "parquet", drop_extra: bool = False, gather: bool = True) -> None:
    """Append to a table in the table's own column order and types.

    A column the frame lacks is appended as null.  A column the table lacks is an
    error unless ``drop_extra`` is set.  ``gather`` as in ``write_table``.
    """
    table = df.sparkSession.read.table(name)
    aligned = align_to_schema(df, table.schema, drop_extra=drop_extra)
    # partition columns are taken from the table by saveAsTable only when named again
    partitions = [c.name for c in df.sparkSession.catalog.listColumns(name) if c.isPartition]
    with split_methods(df.sparkSession), _writes(df.sparkSession, gather):
        rows = gathered(aligned, partitions) if gather else aligned
        rows.write.format(fmt).mode("append").partitionBy(*partitions).saveAsTable(name)


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Matched target rows take the source's values, unmatched source rows are added.

    Null keys match nothing.  Two source rows with one key stop the job.  The
    source is aggregated by key before any join, and the large target is always
    the left side, whose hot keys adaptive execution can split.
    """
    columns = target.columns
    payload = [c for c in columns if c not in keys]
    no_null_key = F.lit(True)
    for key in keys:
        no_null_key = no_null_key & F.col(key).isNotNull()

    source = source.select(*columns)
    keyed = (
        source.filter(no_null_key)
        .groupBy(*keys)
        .agg(F.count("*").alias("_copies"), F.first(F.struct(*columns)).alias("_new"))
        .withColumn(
            "_new",
            F.when(F.col("_copies") == 1, F.col("_new")).otherwise(
                F.raise_error(F.lit("two source rows share one key")).cast(source.select(F.struct(*columns)).schema[0].dataType)
            ),
        )
        .drop("_copies")
    )
    kept_or_updated = target.join(keyed, keys, "left").select(
        *[
            F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
            if c in payload
            else F.col(c)
            for c in columns
        ]
    )
    existing = target.select(*keys).distinct()
    added = keyed.join(existing, keys, "left_anti").select("_new.*")
    return kept_or_updated.unionByName(added).unionByName(source.filter(~no_null_key))


def table_partitions(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def copy_properties(spark: SparkSession, old: str, new: str) -> None:
    """Give a table the properties that users set on another; those that Spark keeps for itself stay behind."""
    for row in spark.sql(f"SHOW TBLPROPERTIES {old}").collect():
        if not row["key"].startswith(OWN_PROPERTIES):
            set_property(spark, new, row["key"], row["value"])


def replace_table(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet", gather: bool = True) -> None:
    """Put a frame that may read the table in the table's place, with the table's partitioning and properties.

    The rows are written to a folder of their own (``path``, or one beside the old folder) under another
    name, from the old table, which stays whole until they are complete; then the names are swapped, and the old
    table and its folder go.  A job that fails before the swap leaves the table as it was, and if
    the second name cannot be given, the first is given back.  ``gather`` as in ``write_table``.
    """
    spark = df.sparkSession
    mark = uuid.uuid4().hex[:12]
    fresh, aside = f"{name}_new_{mark}", f"{name}_old_{mark}"
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()
    folder = described["data_type"].rstrip("/")
    # partitions know their own folders, which renaming a managed table would leave behind
    write_table(df, fresh, fmt, path or f"{re.sub('-[0-9a-f]{12}$', '', folder)}-{mark}", tuple(table_partitions(spark, name)), gather)
    copy_properties(spark, name, fresh)
    spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
    try:
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    except Exception:
        spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
        raise
    spark.sql(f"DROP TABLE {aside}")
    old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)


def partition_rows(df: DataFrame, partitions: Sequence[str]) -> list:
    """The frame's partition values; as many rows as partitions."""
    return df.select(*partitions).distinct().collect()


def in_partitions(rows: Sequence, partitions: Sequence[str]) -> Column:
    """Whether a row lies in one of these partitions, as a condition that prunes the scan."""
    found = F.lit(False)
    for row in rows:
        same = F.lit(True)
        for c in partitions:
            same = same & (F.col(c).isNull() if row[c] is None else F.col(c) == F.lit(row[c]))
        found = found | same
    return found


def upsert_table(source: DataFrame, name: str, keys: list[str], path: str | None = None, fmt: str = "parquet") -> None:
    """Merge rows into a stored table by key (see ``upsert``).

    A table without partitions is replaced as a whole (``replace_table``; ``path`` is then a new
    folder for an external table).  Of a partitioned table only those partitions are read in full and written
    that hold a matched row or get a row; the files of the others stay as they are.  Their
    new state is stored in the scratch folder before the first of them is overwritten, so
    a job that fails while merging changes nothing, and one that fails while overwriting can be repeated.
    A row whose partition changes moves; a partition that loses all its rows goes.
    """
    spark = source.sparkSession
    partitions = table_partitions(spark, name)
    table = spark.read.table(name)
    if not partitions:
        replace_table(upsert(table, source, keys), name, path, fmt)
        return
    source = materialize(source.select(*table.columns), "merge-source")
    matched = table.select(*dict.fromkeys([*keys, *partitions])).join(source.select(*keys).distinct(), keys, "left_semi")
    touched = {tuple(row): row for row in [*partition_rows(matched, partitions), *partition_rows(source, partitions)]}
    if not touched:
        return
    merged = upsert(table.filter(in_partitions(list(touched.values()), partitions)), source, keys)
    overwrite_partitions(merged, name, set(touched), fmt)


def insert_partitions(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Put a frame's rows, in the table's column order, in place of the partitions that they belong to."""
    spark = df.sparkSession
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")  # insertInto takes no such option
    try:
        df.write.format(fmt).mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def overwrite_partitions(df: DataFrame, name: str, old: set[tuple], fmt: str = "parquet", gather: bool = True) -> None:
    """Put a frame's rows, which may come from the table, in place of the ``old`` partitions and of those it has rows in.

    The rows are stored in the scratch folder first, until they are in the table.  Old partitions that get no row are
    dropped with their files.  ``gather`` as in ``write_table``.
    """
    spark = df.sparkSession
    partitions, columns = table_partitions(spark, name), spark.read.table(name).columns
    rows = df.select(*columns)
    with _writes(spark, gather), materialized(gathered(rows, partitions) if gather else rows, "partitions", tuple(partitions)) as stored:
        kept = {tuple(row) for row in partition_rows(stored, partitions)}
        insert_partitions(stored.select(*columns), name, fmt)
    for values in old - kept:
        drop_partition(spark, name, dict(zip(partitions, values)))


def drop_partition(spark: SparkSession, name: str, values: dict) -> None:
    """Drop one partition and its files, of an external table too."""

    def quoted(value) -> str:
        return "null" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

    spec = ", ".join(f"`{c}` = {quoted(v)}" for c, v in values.items())
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION ({spec})").filter("col_name = 'Location'").first()
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(described["data_type"])
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    spark.catalog.refreshTable(name)


def compact(df: DataFrame, path: str, files: int | None = None) -> DataFrame:
    """Write the same rows in fewer files and read them back.

    Without ``files`` adaptive execution sizes the files by its advisory
    partition size, so the number of files follows the amount of data.
    """
    packed = df.repartition(files) if files else df.hint("rebalance")
    packed.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_load(df: DataFrame, path: str, load_id: int) -> None:
    """Add one load to a table that is partitioned by load; the same load again replaces itself."""
    writer = df.withColumn(LOAD_ID, F.lit(load_id)).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(LOAD_ID).parquet(path)


def as_of_load(table: DataFrame, load_id: int) -> DataFrame:
    """The table as it was after the given load; later partitions are not read."""
    return table.filter(F.col(LOAD_ID) <= load_id).drop(LOAD_ID)


def upsert_load(source: DataFrame, path: str, load_id: int, keys: list[str]) -> None:
    """Merge one load into a table of rows with validity: from ``_from_load`` on and before ``_to_load``.

    Rows of the load replace valid rows of the same key, which end with this load; rows with a null key are only
    added.  The table is partitioned by ``_to_load``: a load rewrites the valid rows and the partition of rows that it
    ends, all older ones stay.  The last load may be repeated, also with other rows, and then
    replaces itself; a load before the last one is refused, and so are two rows of a load with one key.
    """
    spark = source.sparkSession
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    rows = source.withColumns({FROM_LOAD: F.lit(load_id), TO_LOAD: F.lit(OPEN)})
    ended = None
    if system.exists(folder):
        table = spark.read.schema(rows.schema).parquet(path)
        last = table.agg(F.max(FROM_LOAD).alias("last")).first()["last"]
        if last is not None and last > load_id:
            raise ValueError(f"load {last} is already there; load {load_id} cannot go before it")
        # as it was before this load: rows it added are gone, rows it ended are valid
        before = table.filter(F.col(TO_LOAD).isin(load_id, OPEN) & (F.col(FROM_LOAD) < load_id)).withColumn(TO_LOAD, F.lit(OPEN))
        hits = source.select(*keys).dropna().groupBy(*keys).agg(F.count("*").alias("_copies"))
        hits = hits.select(
            *keys, F.when(F.col("_copies") == 1, True).otherwise(F.raise_error(F.lit("two source rows share one key")).cast("boolean")).alias("_hit")
        )
        marked = before.join(hits, keys, "left")
        ended = marked.withColumn(TO_LOAD, F.when(F.col("_hit"), F.lit(load_id)).otherwise(F.lit(OPEN))).drop("_hit")
    state = rows if ended is None else ended.select(*rows.columns).unionByName(rows)
    state = materialize(gathered(state, [TO_LOAD]), "load", (TO_LOAD,))
    if state.filter(F.col(TO_LOAD) == load_id).isEmpty():
        system.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{TO_LOAD}={load_id}"), True)
    state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(TO_LOAD).parquet(path)


def as_of_upsert(table: DataFrame, load_id: int) -> DataFrame:
    """The table of ``upsert_load`` as it was after the given load; partitions of rows that ended by then are not read."""
    return table.filter((F.col(TO_LOAD) > load_id) & (F.col(FROM_LOAD) <= load_id)).drop(FROM_LOAD, TO_LOAD)


def load_log(table: DataFrame, ts_col: str = "_ingestion_ts") -> DataFrame:
    """Rows and first and last ingestion time of each load."""
    return table.groupBy(LOAD_ID).agg(
        F.count("*").alias("row_count"),
        F.min(ts_col).alias("first_ts"),
        F.max(ts_col).alias("last_ts"),
    )
