"""Counts of equal rows travel as digests; nested and collated values keep their own equality."""

import datetime as dt

import pytest

from flowmedallion.operators import cleaning, leakage, profiling


def exchanged(df):
    """The columns that the exchange of rows carries."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    found = [part for part in plan.split("\n(") if ") Exchange" in part.split("\n")[0] and "hashpartitioning" in part]
    return found[0].split("Input [")[1].split("]")[0]


@pytest.fixture
def rows(spark):
    day = dt.datetime(2020, 1, 1)
    values = [("a", 1, 0.0, day), ("a", 1, -0.0, day), (None, 1, 0.0, day), ("a", None, 0.0, day), ("1", None, float("nan"), None)]
    values += [("1", None, float("nan"), None), ("b", -5, 1.0, day)]
    return spark.createDataFrame(values, "label string, bytes long, x double, at timestamp")


def test_duplicate_count_shuffles_digests(rows):
    found = profiling.duplicate_count(rows)
    assert found.first() == (7, 5, 2)
    assert "label" not in exchanged(found)


def test_nested_and_collated_columns_are_compared_as_values(spark):
    nested = spark.sql("SELECT explode(array(array(null, 1), array(1, null), array(1, null))) AS a")
    assert profiling.duplicate_count(nested).first() == (3, 2, 1)
    collated = spark.sql("SELECT x COLLATE UTF8_LCASE AS a FROM VALUES ('A'), ('a'), ('b') AS t(x)")
    assert profiling.duplicate_count(collated).first() == (3, 2, 1)


def test_step_counts_shuffle_digests(rows):
    found = cleaning.cleaning_step_counts(rows)
    assert [r.row_count for r in found.orderBy("position").collect()] == [7, 5, 4, 3]
    assert "label" not in exchanged(found)


def test_quality_gate_shuffles_digests(rows):
    found = profiling.quality_gate(rows)
    measured = {r.rule: r.measured for r in found.collect()}
    assert measured == {"max_null_ratio": 6 / 28, "max_duplicate_ratio": 2 / 7, "min_rows_bronze": 7.0}
    assert "label" not in exchanged(found)


def test_overlap_summary_shuffles_digests(spark):
    df = spark.createDataFrame([(0.0, 1, "train"), (-0.0, 1, "test"), (1.0, 2, "test"), (1.0, 2, "test")], "x double, y int, split string")
    found = leakage.feature_identical_summary(df, ["x", "y"])
    assert found.first()[:5] == (1, 3, 1, 1, 1)
    assert "x#" not in exchanged(found)
    assert leakage.feature_groups(df, ["x", "y"]).columns == ["x", "y", "train_rows", "test_rows"]
