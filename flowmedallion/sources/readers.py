"""Raw files to Bronze frames.

An *entry* is one name directly under the input folder that ends with the wanted
suffix: a file, or a folder that Spark wrote under such a name.
"""

from __future__ import annotations

import logging
import posixpath
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote, urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from flowmedallion.functions.expressions import FLOATING, null_if_nonfinite
from flowmedallion.operators.schema import clean_column_name, clean_columns
from flowmedallion.sources.csv_types import Kinds, kind, merge_kinds, type_of, typed

logger = logging.getLogger(__name__)

SOURCE_FILE = "_source_file"
INGESTION_TS = "_ingestion_ts"
EXPECTED_DAY_FILES = 5
WRITERS = 8
HEAD_READERS = 32


def _entry_of(file: str, base: str) -> str:
    """The entry of a folder that a file belongs to: the file, or the folder it lies in."""
    decoded = unquote(file)
    path, root = unquote(urlsplit(file).path), urlsplit(base).path.strip("/")
    start = path.find(f"/{root}/")
    if start < 0:
        return decoded
    inside = start + len(root) + 2
    return decoded[: len(decoded) - len(path) + inside] + path[inside:].split("/")[0]


def list_entries(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """Sorted full paths of the entries of a folder, on any file system Spark can read."""
    base = path.rstrip("/")
    try:
        files = spark.read.text(f"{base}/*{suffix}").inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted({_entry_of(file, base) for file in files})


def entry_stem(entry: str, suffix: str) -> str:
    return posixpath.basename(entry)[: -len(suffix)]


def add_ingestion_metadata(df: DataFrame, source: str) -> DataFrame:
    return df.withColumns({SOURCE_FILE: F.lit(source), INGESTION_TS: F.current_timestamp()})


def drop_nonfinite(df: DataFrame) -> DataFrame:
    """NaN and infinities in floating columns become null; other columns are untouched."""
    return df.select(
        *[
            null_if_nonfinite(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, FLOATING)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def read_csv(spark: SparkSession, entries: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header row, types inferred unless given; columns are taken by position.

    A file whose header differs from the others' or from ``schema`` is an error.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(entries)


def _bronze_csv(df: DataFrame, keep_nonfinite: bool) -> DataFrame:
    df = clean_columns(df)
    return df if keep_nonfinite else drop_nonfinite(df)


def _entry_name(base: str, file: str = "_metadata.file_path") -> Column:
    """The name of the entry that a row's file belongs to."""
    root = urlsplit(base).path.strip("/")
    path = F.url_decode(F.replace(F.col(file), F.lit("+"), F.lit("%2B")))
    inside = F.regexp_extract(path, rf"\Q/{root}/\E([^/]+)", 1)
    return F.when(inside != "", inside).otherwise(F.substring_index(path, "/", -1))


def _first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file with text in it; only the head of the file is read."""
    jvm, settings = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(settings).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(settings).getCodec(path)
    lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        while (line := lines.readLine()) is not None:
            if line.strip():
                return line
        return None
    finally:
        lines.close()


def csv_headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """First line -> files that begin with it, for all files of the CSV entries of a folder.

    Every file is looked at, part files of folder entries included, so that no file is read
    under another's header.  Like the listing of the files, which Spark does before any scan, this is the
    driver's work, HEAD_READERS files at a time; what is read does not grow with the files.
    """
    base = path.rstrip("/")
    try:
        files = spark.read.text(f"{base}/*.csv").inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    names = sorted(unquote(file) for file in files)
    found: dict[str, list[str]] = {}
    with ThreadPoolExecutor(HEAD_READERS) as pool:
        for name, header in zip(names, pool.map(lambda file: _first_line(spark, file), names)):
            if header is not None:
                found.setdefault(header, []).append(name)
    return dict(sorted(found.items()))


def _text_rows(spark: SparkSession, files: list[str]) -> DataFrame:
    """Files of one header with every column as text."""
    names = spark.read.option("header", True).csv(files[0]).columns
    return read_csv(spark, files, T.StructType([T.StructField(name, T.StringType()) for name in names]))


def csv_kinds(spark: SparkSession, path: str, groups: list[list[str]] | None = None) -> dict[str, Kinds]:
    """Entry name -> clean column -> state of its values (``csv_types``), for the CSV entries of a folder.

    One aggregate reads all files once, whatever their headers, and returns one row for each
    entry, header and column.  ``groups`` are the files of each header, where they are known.
    """
    base = path.rstrip("/")
    groups = list(csv_headers(spark, base).values()) if groups is None else groups
    parts, names = None, []
    for header, files in enumerate(groups):
        rows = _text_rows(spark, files)
        names.append([clean_column_name(c) for c in rows.columns])
        texts = F.array(*[F.col(f"`{c}`") for c in rows.columns])
        # the test of a value is one function over the row's array, so that its method stays small enough for the
        # JVM to compile; the entry is read off the path once for each file and column, not for each value
        values = rows.select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.transform(texts, kind)).alias("at", "kind"))
        states = values.groupBy("file", "at").agg(F.bit_or("kind").alias("state"))
        entries = states.groupBy(_entry_name(base, "file").alias("entry"), "at").agg(F.bit_or("state").alias("state"))
        part = entries.select(F.lit(header).alias("header"), "entry", "at", "state")
        parts = part if parts is None else parts.unionAll(part)
    found: dict[str, Kinds] = {}
    for row in parts.collect() if parts is not None else []:
        own = {names[row["header"]][row["at"]]: row["state"]}
        found[row["entry"]] = merge_kinds([found.get(row["entry"], {}), own])
    return found


def _csv_frame(
    spark: SparkSession,
    base: str,
    groups: list[list[str]],
    schema: T.StructType | None,
    kinds: Kinds,
    keep_nonfinite: bool,
    allow_missing: bool,
) -> DataFrame:
    """Files of one header each share a scan; the scans are united by clean column name."""
    scans = [_text_rows(spark, files) for files in groups]
    given = None
    if schema is not None:
        given = {clean_column_name(f.name): f.dataType for f in schema.fields}
        for scan in scans:
            differing = {clean_column_name(c) for c in scan.columns} ^ set(given)
            if differing and not allow_missing:
                raise ValueError(f"schema and files differ in {', '.join(sorted(differing))}")

    bronze = None
    for files, scan in zip(groups, scans, strict=True):
        raw = scan.columns
        if given is not None:
            types = [given.get(clean_column_name(c), T.StringType()) for c in raw]
            rows = read_csv(spark, files, T.StructType([T.StructField(c, t) for c, t in zip(raw, types)]))
            values = [F.col(f"`{c}`") for c in raw]
        else:
            rows = scan
            values = [typed(F.col(f"`{c}`"), type_of(kinds.get(clean_column_name(c), 0))).alias(c) for c in raw]
        tagged = rows.select(*values, _entry_name(base).alias(SOURCE_FILE))
        frame = _bronze_csv(tagged, keep_nonfinite)
        if given is not None:
            frame = frame.select(
                *[
                    (F.col(f"`{c}`") if c in frame.columns else F.lit(None).cast(kind)).alias(c)
                    for c, kind in given.items()
                ],
                SOURCE_FILE,
            )
        bronze = frame if bronze is None else bronze.unionByName(frame, allowMissingColumns=allow_missing)
    return bronze.withColumn(INGESTION_TS, F.current_timestamp())


def ingest_csv_to_bronze_memory(
    spark: SparkSession,
    input_path: str,
    schema: T.StructType | None = None,
    keep_nonfinite: bool = False,
    first_only: bool = False,
    allow_missing: bool = False,
    known: Kinds | None = None,
) -> DataFrame | None:
    """All CSV entries of a folder as one Bronze frame; ``None`` when there are none.

    Columns are matched by name, file by file.  A column whose type differs between
    files takes the widest number or else text, for ``cast_types`` to settle.  Fields of
    ``schema`` are matched by clean name too, whatever their order; a field that a file
    lacks, or a column that the schema lacks, is an error unless ``allow_missing`` makes
    it null or leaves it out.  Give ``schema`` to save the inference pass.  ``known`` are the
    merged states (``csv_kinds``) of earlier loads: with them no column gets a narrower type than
    all loads together need, and the earlier files are not read again.
    """
    base = input_path.rstrip("/")
    groups = list(csv_headers(spark, base).values())
    if not groups:
        logger.warning("no CSV file in %s", input_path)
        return None
    if first_only:
        first = min(_entry_of(file, base) for files in groups for file in files)
        groups = [own for files in groups if (own := [f for f in files if _entry_of(f, base) == first])]
    kinds = merge_kinds([known or {}, *csv_kinds(spark, base, groups).values()]) if schema is None else {}
    return _csv_frame(spark, base, groups, schema, kinds, keep_nonfinite, allow_missing)


def ingest_csv_to_bronze(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    schema: T.StructType | None = None,
    keep_nonfinite: bool = False,
) -> None:
    """Each CSV entry of a folder to its own Bronze Parquet folder, named after the file.

    Headers and types are looked for once for all entries; each entry has types of its own.
    WRITERS entries are written at a time.
    """
    base = input_path.rstrip("/")
    entries: dict[str, list[list[str]]] = {}
    groups = list(csv_headers(spark, base).values())
    for files in groups:
        own: dict[str, list[str]] = {}
        for file in files:
            own.setdefault(_entry_of(file, base), []).append(file)
        for entry, members in own.items():
            entries.setdefault(entry, []).append(members)
    if not entries:
        logger.warning("no CSV file in %s", input_path)
        return
    found = csv_kinds(spark, base, groups) if schema is None else {}

    def write(entry: str) -> None:
        kinds = found.get(posixpath.basename(entry), {})
        frame = _csv_frame(spark, base, entries[entry], schema, kinds, keep_nonfinite, allow_missing=False)
        frame.write.mode("overwrite").parquet(f"{output_path.rstrip('/')}/{entry_stem(entry, '.csv')}")

    with ThreadPoolExecutor(WRITERS) as pool:
        list(pool.map(write, sorted(entries)))


def ingest_parquet_to_bronze_memory(spark: SparkSession, file_path: str) -> DataFrame:
    """One Parquet file (or folder) as a Bronze frame, tagged with its name."""
    name = posixpath.basename(file_path.rstrip("/"))
    return add_ingestion_metadata(clean_columns(spark.read.parquet(file_path)), name)


def ingest_multi_day(
    spark: SparkSession,
    input_path: str,
    allow_missing: bool = False,
) -> DataFrame | None:
    """All day files of a folder as one Bronze frame with ``day_of_week``.

    The day is the last ``-`` part of the file stem.  Entries of one schema share a scan; their
    footers are read HEAD_READERS entries at a time;
    source and day come from the file's path, so a filter on either skips whole files.
    Columns must agree by name unless ``allow_missing`` is set.
    """
    base = input_path.rstrip("/")
    entries = list_entries(spark, base, ".parquet")
    if not entries:
        logger.warning("no Parquet file in %s", input_path)
        return None
    if len(entries) < EXPECTED_DAY_FILES:
        logger.warning("expected %d day files, found %d", EXPECTED_DAY_FILES, len(entries))
    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(HEAD_READERS) as pool:
        schemas = list(pool.map(lambda entry: spark.read.parquet(entry).schema.json(), entries))
    for entry, found in zip(entries, schemas, strict=True):
        groups.setdefault(found, []).append(entry)
    bronze = None
    for members in groups.values():
        rows = spark.read.parquet(*members)
        names = [F.col(f"`{c}`") for c in rows.columns]
        frame = clean_columns(rows.select(*names, _entry_name(base).alias(SOURCE_FILE)))
        day = F.regexp_extract(SOURCE_FILE, r"([^-]*)\.parquet$", 1)
        frame = frame.withColumns({INGESTION_TS: F.current_timestamp(), "day_of_week": day})
        bronze = frame if bronze is None else bronze.unionByName(frame, allowMissingColumns=allow_missing)
    return bronze
