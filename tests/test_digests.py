"""Stored digests against the checks that read the rows."""

import pytest
from pyspark.sql import functions as F

from flowmedallion.operators import leakage, profiling, sampling
from flowmedallion.sources import digests as D


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def framed(spark):
    """A third of all rows share one vector; others occur on one side or both, some with zeros of both signs."""
    n = F.col("id")
    hot = n % 3 == 0
    return spark.range(6000, numPartitions=5).select(
        "id",
        F.when(hot, 7.0).otherwise((n % 2500).cast("double")).alias("a"),
        F.when(hot, 0.0).when(n % 5 == 0, -0.0).otherwise(0.0).alias("b"),
        F.when(n % 7 < 2, "test").otherwise("train").alias("split"),
    )


def test_stored_overlap_equals_the_overlap_of_rows(spark, framed, tmp_path):
    D.store_by_features(framed, "digests_overlap", ["a", "b"], 4, f"{tmp_path}/t")
    assert {r.a for r in spark.read.table("digests_overlap_hot").collect()} == {7.0}
    found = D.stored_identical_rows(spark, "digests_overlap")
    assert rows_of(found) == rows_of(leakage.feature_identical_rows(framed, ["a", "b"]))
    summary = D.stored_identical_summary(spark, "digests_overlap")
    assert summary.first().asDict() == leakage.feature_identical_summary(framed, ["a", "b"]).first().asDict()


def test_rows_meet_without_exchange(spark, framed, tmp_path):
    D.store_by_features(framed, "digests_plan", ["a", "b"], 4, f"{tmp_path}/t")
    cold = plan_of(D.stored_feature_groups(spark, "digests_plan")[0])
    assert "Exchange" not in cold
    plan = plan_of(D.stored_identical_rows(spark, "digests_plan"))
    # one exchange and one broadcast, both of the groups of hot vectors
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("BroadcastExchange") == 1
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_overlap_of_nothing(spark, framed, tmp_path):
    D.store_by_features(framed.limit(0), "digests_none", ["a", "b"], 4, f"{tmp_path}/t")
    assert D.stored_identical_rows(spark, "digests_none").count() == 0
    row = D.stored_identical_summary(spark, "digests_none").first()
    assert row.train_size == 0 and row.pct_of_test is None or row.pct_of_test == 0


def test_digests_tell_nulls_apart(spark):
    rows = [(None, 1), (1, None), (None, None), (1, 1)]
    df = spark.createDataFrame(rows, "x int, y int").withColumns(D.digest_columns(["x", "y"]))
    assert df.select(*D.DIGEST).distinct().count() == 4
    zeros = spark.sql("SELECT explode(array(0d, -0d)) AS x").withColumns(D.digest_columns(["x"]))
    assert zeros.select(*D.DIGEST).distinct().count() == 1


def test_state_equals_the_full_run(spark, tmp_path):
    first = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, None)], "x int, y string")
    second = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "x int, y string")
    D.add_load_state(first, "digests_state", 1, 4, f"{tmp_path}/t")
    for rows in (second.limit(1), second, second):  # the last two repeat the load
        D.add_load_state(rows, "digests_state", 2)
    both = first.unionByName(second)
    limits = {"max_null_ratio": 0.3, "min_rows_bronze": 7}
    assert rows_of(D.state_quality_gate(spark, "digests_state", limits)) == rows_of(profiling.quality_gate(both, limits))
    assert rows_of(D.state_duplicate_count(spark, "digests_state")) == rows_of(profiling.duplicate_count(both))
    before = D.state_duplicate_count(spark, "digests_state", load_id=1)
    assert rows_of(before) == rows_of(profiling.duplicate_count(first))
    plan = plan_of(D.state_duplicate_count(spark, "digests_state"))
    assert "hashpartitioning" not in plan and plan.count("Exchange SinglePartition") == 1
    with pytest.raises(ValueError, match="state of"):
        D.add_load_state(second.drop("y"), "digests_state", 3)


def test_state_of_empty_loads(spark, tmp_path):
    rows = spark.createDataFrame([(1,), (1,)], "x int")
    D.add_load_state(rows.limit(0), "digests_empty", 1, 4, f"{tmp_path}/t")
    assert D.state_duplicate_count(spark, "digests_empty").first() == (0, 0, 0)
    D.add_load_state(rows, "digests_empty", 2)
    assert D.state_duplicate_count(spark, "digests_empty").first() == (2, 1, 1)
    D.add_load_state(rows.limit(0), "digests_empty", 2)
    assert D.state_duplicate_count(spark, "digests_empty").first() == (0, 0, 0)


def test_stored_split_equals_the_lazy_one(spark):
    df = spark.range(5000, numPartitions=3).select("id", F.when(F.col("id") % 11 > 0, F.col("id") % 3).alias("is_attack"))
    stored = sampling.stratified_split_stored(df, key_cols=["id"])
    assert rows_of(stored) == rows_of(sampling.stratified_split_exact(df, key_cols=["id"]))
    assert "Range (" not in plan_of(stored) and "md5" not in plan_of(stored)
    assert sampling.stratified_split_stored(df.limit(0), key_cols=["id"]).count() == 0
    with pytest.raises(ValueError, match="_class"):
        sampling.stratified_split_stored(df.withColumnRenamed("id", "_class"))


def test_buckets_follow_the_rows(spark, framed, tmp_path, monkeypatch):
    def buckets(name):
        return next(int(r.data_type) for r in spark.sql(f"DESCRIBE FORMATTED {name}").collect() if r.col_name == "Num Buckets")

    monkeypatch.setattr(D, "ROWS_PER_BUCKET", 500)
    D.store_by_features(framed, "digests_grown", ["a", "b"], path=f"{tmp_path}/rows")
    D.add_load_state(framed, "digests_grown_state", 1, path=f"{tmp_path}/state")
    D.add_load_state(framed.limit(10), "digests_grown_state", 2)
    assert buckets("digests_grown") == buckets("digests_grown_state") == 12
    assert rows_of(D.stored_identical_rows(spark, "digests_grown")) == rows_of(leakage.feature_identical_rows(framed, ["a", "b"]))
    D.store_by_features(framed.limit(0), "digests_small", ["a", "b"], path=f"{tmp_path}/small")
    assert buckets("digests_small") == D.LEAST_BUCKETS
