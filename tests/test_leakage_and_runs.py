import random

import pytest
from pyspark.sql import functions as F

from flowmedallion.operators import leakage as L
from flowmedallion.operators import runs as R
from flowmedallion.sources.ledger import append_run, read_runs


@pytest.fixture(scope="module")
def split_rows(spark):
    """A feature vector that holds a third of all rows, some shared ones, many rare ones."""
    chance = random.Random(5)
    rows = []
    for i in range(1500):
        a, b = (0.0, 0.0) if chance.random() < 0.33 else (float(chance.randint(0, 30)), float(chance.randint(0, 30)))
        rows.append((i, a, b, "test" if chance.random() < 0.2 else "train", chance.choice(["x", "y"])))
    return rows, spark.createDataFrame(rows, "id int, a double, b double, split string, label string")


def test_identical_rows_against_brute_force(split_rows, monkeypatch):
    rows, df = split_rows
    sides = {}
    for _, a, b, side, _ in rows:
        sides.setdefault((a, b), set()).add(side)
    expected = {r[0] for r in rows if len(sides[r[1], r[2]]) == 2}
    for parts in (1000, 3, 1):  # all, one or no vector counts as hot
        monkeypatch.setattr(L, "HOT_PARTS", parts)
        found = [r["id"] for r in L.feature_identical_rows(df, ["a", "b"]).collect()]
        assert len(found) == len(expected) and set(found) == expected
    summary = L.feature_identical_summary(df, ["a", "b"]).first()
    assert summary["test_with_counterpart"] == sum(1 for r in rows if r[3] == "test" and r[0] in expected)
    assert summary["train_with_counterpart"] == sum(1 for r in rows if r[3] == "train" and r[0] in expected)
    assert summary["shared_vectors"] == sum(1 for s in sides.values() if len(s) == 2)
    assert summary["train_size"] + summary["test_size"] == 1500
    train, test = (df.filter(F.col("split") == s).select("a", "b") for s in ("train", "test"))
    assert L.common_rows(train, test).count() == summary["shared_vectors"]


def test_negative_zero_counts_as_zero(spark):
    df = spark.createDataFrame([(0.0, "train"), (-0.0, "test")], "a double, split string")
    assert L.feature_identical_summary(df, ["a"]).first()["shared_vectors"] == 1
    assert L.feature_identical_rows(df, ["a"]).count() == 2


def test_overlap_of_nothing(spark):
    df = spark.createDataFrame([], "a double, split string")
    summary = L.feature_identical_summary(df, ["a"]).first()
    assert (summary["train_size"], summary["shared_vectors"], summary["pct_of_test"]) == (0, 0, None)
    assert L.feature_identical_rows(df, ["a"]).count() == 0


def test_label_comparison(spark):
    df = spark.createDataFrame(
        [("a", "train"), ("a", "test"), ("b", "train"), ("b", "train"), ("c", "test"), (None, "test")], "label string, split string"
    )
    compared = L.label_split_comparison(df)
    assert [tuple(r) for r in compared.collect()] == [
        ("b", 2, 0, "Train only"), ("a", 1, 1, "Both"), ("c", 0, 1, "TEST ONLY (unseen in training)")
    ]
    only_both = compared.filter("status = 'Both'")
    assert {r["status"]: r["labels"] for r in L.split_status_counts(only_both).collect()} == {
        "Both": 1, "Train only": 0, "TEST ONLY (unseen in training)": 0
    }


def test_frames_equal(spark):
    one = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "n int, s string")
    assert L.frames_equal(one, one.repartition(3)).first()["equal"]
    fewer = L.frames_equal(one, one.distinct()).first()
    assert (fewer["only_left"], fewer["only_right"], fewer["equal"]) == (1, 0, False)
    assert not L.frames_equal(one, one.withColumn("n", F.col("n").cast("bigint"))).first()["equal"]


def ledger(spark, tmp_path, *entries):
    path = str(tmp_path / "ledger")
    for entry in entries:
        append_run(spark, path, entry)
    return read_runs(spark, path)


def run(run_id, name, temporal, strat=0.9, tag="both"):
    return {
        "run_id": run_id, "run_name": name, "model_type": "random_forest", "training_split": tag,
        "temporal_f1_score": temporal, "stratified_f1_score": strat,
    }


def test_ranking_runs(spark, tmp_path):
    runs = ledger(
        spark, tmp_path, run("1", "a", 0.5), run("2", "a", 0.6), run("3", "b", None), run("4", "c", 0.99, tag=None), run("5", "d", 0.1, strat=None)
    )
    assert [r["run_id"] for r in R.rank_runs(runs).collect()] == ["2", "1", "5", "3"]
    assert len(R.rank_runs(runs).columns) == 16
    assert [r["run_id"] for r in R.rank_runs(runs, best_per_name=True).collect()] == ["2"]
    assert R.require_best_run(runs)["run_id"] == "2"


def test_no_best_run(spark, tmp_path):
    runs = ledger(spark, tmp_path, run("1", "a", None), run("2", "b", 0.7, tag=None))
    assert R.best_run(runs).count() == 0
    with pytest.raises(ValueError, match="temporal"):
        R.require_best_run(runs)


def test_best_of_two(spark):
    def best(forest, boosted):
        df = spark.createDataFrame([("forest", forest), ("boosted", boosted)], "model string, f1_score double")
        return R.best_of_two(df, on_tie="forest").first()["model"]

    assert best(0.5, 0.6) == "boosted" and best(0.6, 0.5) == "forest" and best(0.5, 0.5) == "forest"


@pytest.mark.parametrize("temporal, verdict", [(0.895, "small"), (0.85, "moderate"), (0.5, "significant"), (0.95, "small")])
def test_gap(spark, temporal, verdict):
    df = spark.createDataFrame(
        [("stratified", 0.9, 0.99), ("temporal", temporal, 0.9)], "protocol string, f1_score double, roc_auc double"
    )
    gap = R.generalisation_gap(df).first()
    assert gap["f1_difference"] == pytest.approx(0.9 - temporal) and gap["verdict"] == verdict
    assert gap["auc_difference"] == pytest.approx(0.09)


def test_model_comparison_and_arms(spark):
    rows = [(i, i % 2, i % 2, int(i % 4 == 1)) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, is_attack int, champion_pred int, candidate_pred int")
    compared = {r["version"]: r for r in R.model_comparison(df).collect()}
    assert compared["champion"]["f1"] == 1.0 and compared["candidate"]["recall"] == 0.5
    assert compared["champion"]["agreement"] == 0.75 and compared["candidate"]["verdict"] == "champion performs better"
    swapped = R.model_comparison(df, "candidate_pred", "champion_pred").first()["verdict"]
    assert swapped == "candidate performs better"
    assert R.model_comparison(df, "champion_pred", "champion_pred").first()["verdict"] == "both perform the same"
    arms = {r["arm"]: r for r in R.arm_metrics(df, ["id"]).collect()}
    assert arms["champion"]["row_count"] + arms["candidate"]["row_count"] == arms["overall"]["row_count"] == 400
    assert 0.6 < arms["champion"]["row_count"] / 400 < 0.8 and arms["champion"]["accuracy"] == 1.0
    assert arms["candidate"]["accuracy"] < arms["overall"]["accuracy"] < 1.0
