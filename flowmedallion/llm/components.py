"""Connected components of a graph that is stored as a table of edges.

Large-star and small-star rounds in turn: each node's larger neighbours move to its
smallest neighbour, then its smaller ones do.  Rounds end when the edges no longer
change; every node then hangs on the smallest node of its component.  All steps are
groupings and joins on node ids; groupings combine before their shuffle, and adaptive
execution splits a join on a node with very many edges.  Each round is a table in the
shared scratch folder, and the one before it is removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmedallion.sources.session import scratch_path


def store(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write the frame to the shared scratch folder; the table and its path."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def star_round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges a < b."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    large = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()
    root = large.groupBy("b").agg(F.min("a").alias("m"))
    moved = large.join(root, "b").filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(root.select(F.col("m").alias("a"), "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node that has an edge to another, root being the smallest node reached.

    ``edges`` has columns a and b of one orderable type.  Loops, repeated and reversed edges
    and edges with a null end change nothing.
    """
    spark = edges.sparkSession
    ordered = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    now, path = store(ordered.distinct(), "edges")
    state = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == state or not mark[0]:
            break
        state = mark
        following, new_path = store(star_round(now), "edges")
        remove(spark, path)
        now, path = following, new_path
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
