"""Layers and increments whose rows are stored shuffle only rows that may have a copy."""

import glob

import pytest
from pyspark.sql import functions as F

from flowmedallion.operators import cleaning
from flowmedallion.plans import multiday
from flowmedallion.sources import session, tables


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def scratch(spark):
    root = f"{session.scratch_root(spark)}/flowmedallion/{spark.sparkContext.applicationId}"
    return {path for name in ("increment", "partitions") for path in glob.glob(f"{root}/{name}-*")}


@pytest.fixture
def few_copies(spark, tmp_path):
    nan = float("nan")
    odd = spark.createDataFrame([("a", None, nan), ("a", None, nan), (None, "a", 0.0), (None, "a", -0.0), ("a", None, 0.0), (None, None, None)], "a string, b string, x double")
    plain = spark.range(3000).select(F.concat(F.lit("r"), F.col("id")).alias("a"), F.lit("b").alias("b"), F.col("id").cast("double").alias("x"))
    odd.unionByName(plain).write.parquet(str(tmp_path / "rows"))
    return spark.read.parquet(str(tmp_path / "rows"))


@pytest.mark.parametrize("most", [1000, 1])
def test_stored_duplicates_are_removed(few_copies, most):
    once = cleaning.remove_stored_duplicates(few_copies, most_shared=most)
    assert once.columns == few_copies.columns and once.schema["x"].dataType == few_copies.schema["x"].dataType
    texts = {"x": (F.col("x") + 0.0).cast("string")}  # one spelling of zero, and NaN equals itself
    assert rows_of(once.withColumns(texts)) == rows_of(few_copies.distinct().withColumns(texts)) and once.count() == 3004


def test_rows_of_one_hash_stay_apart(few_copies, monkeypatch):
    monkeypatch.setattr(cleaning, "row_hash", lambda columns: F.lit(7).cast("bigint"))
    assert cleaning.remove_stored_duplicates(few_copies).count() == 3004


def test_rows_without_a_copy_are_not_shuffled(spark, tmp_path):
    spark.range(500).withColumn("_hash", F.lit(1)).write.parquet(str(tmp_path / "rows"))
    once = cleaning.remove_stored_duplicates(spark.read.parquet(str(tmp_path / "rows")))
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString() and once.count() == 500
    nested = spark.sql("SELECT explode(array(array(0.0D), array(-0.0D), array(1.0D))) AS a")
    assert cleaning.remove_stored_duplicates(nested).count() == 2


def test_day_files_and_increments_are_not_gathered(spark, bronze, tmp_path, monkeypatch):
    gathered, plain = [], tables.gathered
    monkeypatch.setattr(tables, "gathered", lambda df, by: gathered.append(tuple(by)) or plain(df, by))
    for day, port in (("Monday", 1000), ("Friday", 6000)):
        bronze.drop("_source_file", "_ingestion_ts").filter(F.col("port") > port).repartition(2).write.parquet(f"{tmp_path}/days/net-{day}.parquet")
    layers = multiday.Layers("plain_bronze", "plain_silver", "plain_gold", str(tmp_path / "layers"))
    gold = multiday.load_multi_day(spark, f"{tmp_path}/days", layers)
    assert not gathered and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    assert spark.conf.get("parquet.block.size", None) is None
    assert {r.day_of_week: r["count"] for r in gold.groupBy("day_of_week").count().collect()} == {"Monday": 3, "Friday": 2}

    days = bronze.withColumn("day_of_week", F.when(F.col("port") > 5000, "Monday").otherwise("Friday"))
    loaded = multiday.Layers("load_bronze", "load_silver", "load_gold", str(tmp_path / "loads"))
    multiday.load_layers(spark, days.withColumn("newcomer", F.lit(0)), loaded, load_id="first", gather=False)
    late, before = bronze.unionByName(bronze).withColumn("day_of_week", F.lit("Friday")).withColumn("newcomer", F.lit(7)), scratch(spark)
    for _ in range(2):
        multiday.append_increment(late, "load_gold", evolve=True, load_id="late", gather=False)
    found = spark.read.table("load_gold").groupBy("_load_id", "newcomer").count()
    assert rows_of(found) == [("first", 0, 5), ("late", 7, 5)] and not gathered
    assert scratch(spark) == before  # what the increments stored is gone
    for table in ("plain_bronze", "plain_silver", "plain_gold", "load_bronze", "load_silver", "load_gold"):
        spark.sql(f"DROP TABLE {table}")
