"""Exact de-duplication keeps no table of whole rows before its one shuffle, and compares values, not hashes."""

import math

import pytest
from pyspark.sql import functions as F

from flowmedallion.functions import hashing
from flowmedallion.operators import cleaning
from flowmedallion.plans import multiday
from flowmedallion.plans.layers import clean_bronze_to_silver, transform_silver_to_gold
from flowmedallion.sources import tables


def operators(df):
    """Names of the plan's operators, from the result down."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [line.lstrip(" :+-").split("(")[0].split(" ")[0] for line in lines if line.strip()]


@pytest.fixture
def rows(spark):
    nan = float("nan")
    values = [("a", 1, 0.0), ("a", 1, -0.0), (None, 1, 0.0), ("a", None, 0.0), ("1", None, nan), ("1", None, nan), ("1", None, None)]
    return spark.createDataFrame(values * 2, "label string, bytes long, x double").repartition(3)


def test_rows_are_shuffled_once_and_compared_after(rows):
    found = operators(cleaning.remove_duplicates(rows.filter("bytes > 0 OR bytes IS NULL")))
    assert found.count("Exchange") == 2  # the fixture's own, and one
    assert "HashAggregate" not in found[found.index("Exchange") :]
    assert "HashAggregate" in found[: found.index("Exchange")]
    first = operators(cleaning.remove_duplicates(rows, collapse_first=True))
    assert "HashAggregate" in first[first.index("Exchange") :]


def test_cleaning_keeps_no_rows_before_its_shuffle(bronze):
    found = operators(clean_bronze_to_silver(bronze, drop_constants=False))
    assert found.count("Exchange") == 1 and "HashAggregate" not in found[found.index("Exchange") :]


@pytest.mark.parametrize("collapse_first", [False, True])
def test_nulls_zeros_and_nan(rows, collapse_first):
    once = cleaning.remove_duplicates(rows, collapse_first=collapse_first)
    assert once.columns == rows.columns and once.schema == rows.schema
    found = {tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in row) for row in once.collect()}
    assert once.count() == 5
    assert found == {("a", 1, 0.0), (None, 1, 0.0), ("a", None, 0.0), ("1", None, "nan"), ("1", None, None)}


def test_rows_of_one_place_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(cleaning, "row_place", lambda columns: F.lit(7))
    df = spark.range(500).select((F.col("id") % 100).alias("a"), (F.col("id") % 100).cast("string").alias("b"))
    assert cleaning.remove_duplicates(df).count() == 100


def test_names_that_are_taken(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, 2, 3), (1, 2, 4)], "_place int, `_PLACE_` int, `odd.``name` int")
    once = cleaning.remove_duplicates(df)
    assert once.columns == df.columns and sorted(map(tuple, once.collect())) == [(1, 2, 3), (1, 2, 4)]
    assert cleaning.remove_duplicates(df.toDF("a", "a", "b")).count() == 2


def test_nested_and_collated_rows_are_compared_as_values(spark):
    nested = spark.sql("SELECT explode(array(array(0.0D), array(-0.0D), array(1.0D))) AS a, 1 AS b")
    assert cleaning.remove_duplicates(nested).count() == 2
    collated = spark.sql("SELECT x COLLATE UTF8_LCASE AS a FROM VALUES ('A'), ('a'), ('b') AS t(x)")
    assert cleaning.remove_duplicates(collated).count() == 2


def test_places_are_spread(spark):
    df = spark.range(20_000).select(F.col("id").alias("a"), F.lit(None).cast("string").alias("b"))
    assert df.select(hashing.row_place(df.columns).alias("p")).agg(F.count_distinct("p"), F.min("p") >= 0).first()[0] > 15_000


def test_rows_of_a_day_come_together(spark):
    day = F.when(F.col("id") % 5 > 0, F.concat(F.lit("day-"), F.col("id") % 5))
    df = spark.range(4000).select((F.col("id") % 1000).alias("a"), day.alias("day")).repartition(4)
    once = cleaning.remove_duplicates(df, together=["day"])
    found = operators(once)
    assert found.count("Exchange") == 2 and "HashAggregate" not in found[found.index("Exchange") :]
    assert sorted(once.collect(), key=repr) == sorted(df.distinct().collect(), key=repr)
    tasks = once.select("day", F.spark_partition_id().alias("p")).distinct().groupBy("p").count()
    assert tasks.agg(F.max("count")).first()[0] <= 5
    nested = df.withColumn("list", F.array("a"))
    assert cleaning.remove_duplicates(nested, together=["day"]).count() == once.count()
    assert cleaning.remove_duplicates(nested, ["day"], together=["day"]).count() == 5


@pytest.mark.parametrize("days", [True, False])
def test_an_increment_is_shuffled_once(spark, bronze, tmp_path, monkeypatch, days):
    """Rows cleaned by day are written as they come; they are gathered only where the days are not known before."""
    by = "day_of_week" if days else "attack_category"
    first = transform_silver_to_gold(clean_bronze_to_silver(bronze.withColumn("day_of_week", F.lit("Monday")), drop_constants=False))
    name, seen = f"placed_increment_{by}", []
    tables.write_table(first, name, path=str(tmp_path / "gold"), partition_by=(by,))
    plain = tables.gathered
    monkeypatch.setattr(tables, "gathered", lambda df, columns: seen.append(columns) or plain(df, columns))
    more = bronze.unionByName(bronze).withColumn("day_of_week", F.when(F.col("port") > 5000, "Friday").otherwise("Thursday"))
    multiday.append_increment(more, name)
    assert bool(seen) != days
    stored = spark.read.table(name)
    assert {r.day_of_week: r["count"] for r in stored.groupBy("day_of_week").count().collect()} == {"Monday": 5, "Thursday": 2, "Friday": 3}
    spark.sql(f"DROP TABLE {name}")
