"""Session and scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

HUGE_METHOD_BYTES = "8000"
OPEN_FILES = {"spark.sql.maxConcurrentOutputFileWriters": "16", "parquet.block.size": str(16 << 20)}
HUGE_METHOD_LIMIT, SPARKS_LIMIT = "spark.sql.codegen.hugeMethodLimit", "65535"
LOCAL_SCRATCH = "spark.flowmedallion.localScratch"


def create_spark_session(
    app_name: str = "flowmedallion",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A session with UTC time and adaptive execution; a running session is reused.

    Partition counts stay with the cluster's own defaults and AQE.  Wide feature
    projections compile to methods that the JVM's compiler skips above 8000 bytes
    of bytecode; the limit makes Spark split those instead (several times faster).
    ``master`` is only for local runs; ``settings`` are added last.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(HUGE_METHOD_LIMIT, HUGE_METHOD_BYTES)
    )
    if master:
        builder = builder.master(master)
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def split_methods(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside run in methods that the JVM compiles, in sessions that were made elsewhere too.

    A session that has a limit of its own keeps it.
    """
    if spark.conf.get(HUGE_METHOD_LIMIT, SPARKS_LIMIT) != SPARKS_LIMIT:
        yield
        return
    spark.conf.set(HUGE_METHOD_LIMIT, HUGE_METHOD_BYTES)
    try:
        yield
    finally:
        spark.conf.set(HUGE_METHOD_LIMIT, SPARKS_LIMIT)


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Tasks that write rows of few partitions keep a file of each open, and do not sort their rows, which may spill, first.

    Row groups are smaller meanwhile, since each open file holds one in memory; from the 17th partition of a task
    on its rows are sorted.  Settings that a session has of its own stay.
    """
    given = [key for key, value in OPEN_FILES.items() if spark.conf.get(key, None) in (None, "0")]
    for key in given:
        spark.conf.set(key, OPEN_FILES[key])
    try:
        yield
    finally:
        for key in given:
            spark.conf.unset(key)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(LOCAL_SCRATCH, None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="flowmedallion-")
        spark.conf.set(LOCAL_SCRATCH, root)
    return root.rstrip("/")


def _scratch_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/flowmedallion/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path that no earlier call returned."""
    return f"{_scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has stored in the scratch folder.

    For the end of a job: frames that were built on stored tables can no longer be read.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_folder(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write the frame to the shared scratch folder once and read it back.

    Cuts the lineage, so that repeated passes and lost executors read the table
    again instead of running the plan again.
    """
    return _stored(df, scratch_path(df.sparkSession, name), partition_by)


def _stored(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> DataFrame:
    with split_methods(df.sparkSession):
        df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def materialized(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> Iterator[DataFrame]:
    """``materialize`` for as long as the block lasts; the stored rows are deleted at its end."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    try:
        yield _stored(df, path, partition_by)
    finally:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
