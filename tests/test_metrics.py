import math
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from flowmedallion.operators import curves, metrics


def frame(spark, rows):
    return spark.createDataFrame(rows, "is_attack int, pred int, score double, day_of_week string, label string")


def brute_auc(pairs):
    pos, neg = [s for y, s in pairs if y == 1], [s for y, s in pairs if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def brute_points(pairs):
    """(threshold, tp, fp) for each distinct score from high to low."""
    return [
        (t, sum(1 for y, s in pairs if y == 1 and s >= t), sum(1 for y, s in pairs if y == 0 and s >= t))
        for t in sorted({s for _, s in pairs}, reverse=True)
    ]


@pytest.fixture(scope="module")
def scored(spark):
    chance = random.Random(3)
    rows = []
    for _ in range(600):
        y = int(chance.random() < 0.4)
        # one score is shared by about a third of all rows
        s = 0.5 if chance.random() < 0.33 else round(chance.random() * 0.7 + 0.3 * y, 3)
        rows.append((y, int(s >= 0.5), s, chance.choice(["Monday", "Friday"]), chance.choice("ab")))
    return rows, frame(spark, rows)


def test_counts_and_metrics(scored):
    rows, df = scored
    tp = sum(1 for r in rows if r[:2] == (1, 1))
    fp = sum(1 for r in rows if r[:2] == (0, 1))
    fn = sum(1 for r in rows if r[:2] == (1, 0))
    tn = sum(1 for r in rows if r[:2] == (0, 0))
    counted = metrics.confusion_counts(df).first()
    assert (counted["tn"], counted["fp"], counted["fn"], counted["tp"]) == (tn, fp, fn, tp)
    measured = metrics.binary_metrics(df).first()
    precision, recall = tp / (tp + fp), tp / (tp + fn)
    assert measured["accuracy"] == pytest.approx((tp + tn) / 600)
    assert measured["precision"] == pytest.approx(precision) and measured["recall"] == pytest.approx(recall)
    assert measured["f1_score"] == pytest.approx(2 * precision * recall / (precision + recall))
    outcomes = {r["o"]: r["count"] for r in df.select(metrics.outcome().alias("o")).groupBy("o").count().collect()}
    assert outcomes == {"TP": tp, "FP": fp, "FN": fn, "TN": tn}
    report = {r["entry"]: r for r in metrics.classification_report(df).collect()}
    assert report["1"]["recall"] == pytest.approx(recall) and report["0"]["support"] == tn + fp
    assert report["accuracy"]["f1_score"] == pytest.approx((tp + tn) / 600)
    assert report["weighted avg"]["recall"] == pytest.approx((tp + tn) / 600)


def test_undefined_metrics_are_zero(spark):
    df = frame(spark, [(0, 0, 0.1, "Monday", "a")])
    measured = metrics.binary_metrics(df).first().asDict()
    assert measured == {"accuracy": 1.0, "precision": 0.0, "recall": 0.0, "f1_score": 0.0}
    assert set(metrics.binary_metrics(df.limit(0)).first().asDict().values()) == {0.0}
    assert curves.roc_auc(df).first()["roc_auc"] is None
    assert curves.roc_auc(df.limit(0)).first()["roc_auc"] is None
    assert curves.average_precision(df).first()["average_precision"] is None


def test_metrics_by_day(scored, spark):
    rows, df = scored
    per_day = metrics.metrics_by(df)
    days = [r["day_of_week"] for r in per_day.collect()]
    assert days == ["Friday", "Monday"]
    assert sum(r["total_rows"] for r in per_day.collect()) == 600
    f1 = [r["f1_score"] for r in per_day.collect()]
    assert metrics.f1_spread(per_day).first()["f1_spread"] == pytest.approx(max(f1) - min(f1))
    assert metrics.f1_spread(per_day.limit(1)).first()["f1_spread"] is None
    assert metrics.metrics_by(df.drop("day_of_week")) is None
    missed = {r["label"]: r["missed"] for r in metrics.missed_by(df, "label").collect()}
    assert missed == {x: sum(1 for r in rows if r[0] == 1 and r[1] == 0 and r[4] == x) for x in "ab"}
    assert metrics.prediction_agreement(df, "is_attack", "pred").first()["agreement"] == pytest.approx(
        sum(r[0] == r[1] for r in rows) / 600
    )


@pytest.mark.parametrize("ranges", [1, 2, 7, 256])
def test_curves_against_brute_force(scored, ranges):
    rows, df = scored
    pairs = [(r[0], r[2]) for r in rows]
    positives = sum(y for y, _ in pairs)
    negatives = len(pairs) - positives
    points = brute_points(pairs)
    roc = [tuple(r) for r in curves.roc_curve(df, ranges=ranges).collect()]
    assert sorted(roc, key=lambda r: -math.inf if r[0] is None else -r[0])[0] == (None, 0.0, 0.0)
    assert {r for r in roc if r[0] is not None} == {(t, fp / negatives, tp / positives) for t, tp, fp in points}
    pr = {tuple(r) for r in curves.pr_curve(df, ranges=ranges).collect()}
    assert pr == {(t, tp / (tp + fp), tp / positives) for t, tp, fp in points} | {(None, 1.0, 0.0)}
    assert curves.roc_auc(df, ranges=ranges).first()["roc_auc"] == pytest.approx(brute_auc(pairs), abs=1e-12)
    steps = [(points[i][1] - (points[i - 1][1] if i else 0), points[i]) for i in range(len(points))]
    area = sum(step / positives * tp / (tp + fp) for step, (_, tp, fp) in steps)
    found = curves.average_precision(df, ranges=ranges).first()
    assert found["average_precision"] == pytest.approx(area) and found["baseline"] == pytest.approx(positives / 600)


def test_rows_without_a_score_are_on_no_curve(scored):
    rows, df = scored
    holes = df.select("is_attack", "score").limit(40).withColumn("score", F.when(F.rand(1) < 0.5, F.lit(float("nan"))))
    more = df.select("is_attack", "score").unionByName(holes).unionByName(
        df.select(F.lit(None).cast("int").alias("is_attack"), "score").limit(5)
    )
    for curve in (curves.roc_curve, curves.pr_curve, curves.roc_auc, curves.average_precision):
        assert sorted(map(tuple, curve(more).collect()), key=repr) == sorted(map(tuple, curve(df).collect()), key=repr)
    counts = curves.running_counts(df)
    assert curves.roc_auc(df.limit(0), counts=counts).collect() == curves.roc_auc(df).collect()


@pytest.mark.parametrize("ranges", [1, 5])
def test_dropping_collinear_points(spark, ranges):
    ys = [1, 1, 1, 0, 0, 1, 0, 0, 0, 1, 1]
    df = spark.createDataFrame([(y, 1 - i / 20) for i, y in enumerate(ys)], "is_attack int, score double")
    kept = {r["threshold"] for r in curves.roc_curve(df, drop_collinear=True, ranges=ranges).collect()}
    points = brute_points([(y, 1 - i / 20) for i, y in enumerate(ys)])
    expected = {None}
    for i, (t, tp, fp) in enumerate(points):
        before = points[i - 1][1:] if i else (0, 0)
        last = i == len(points) - 1
        if last or (points[i + 1][1] - tp, points[i + 1][2] - fp) != (tp - before[0], fp - before[1]):
            expected.add(t)
    assert kept == expected and len(kept) < len(points)


def test_area_agrees_with_the_evaluator_and_mirrors(scored):
    _, df = scored
    area = curves.roc_auc(df).first()["roc_auc"]
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="is_attack", numBins=0)
    assert area == pytest.approx(evaluator.evaluate(df.withColumn("is_attack", F.col("is_attack").cast("double"))), abs=1e-9)
    mirrored = curves.roc_auc(df.withColumn("score", -F.col("score"))).first()["roc_auc"]
    assert area + mirrored == pytest.approx(1.0)


def test_no_task_gets_all_scores(spark):
    """With many distinct scores the ranges are of about equal size."""
    df = spark.range(20_000).select((F.col("id") % 2).alias("is_attack"), F.pow(F.rand(1), F.lit(8.0)).alias("score"))
    ranged = curves._in_ranges(curves.score_counts(df), 50)
    sizes = [r["count"] for r in ranged.groupBy("_range").count().collect()]
    assert len(sizes) == 50 and max(sizes) < 3 * 20_000 / 50


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.0, 0.1, 0.25, 0.5, 1.0])), min_size=1, max_size=30))
def test_area_on_random_ties(spark, pairs):
    df = spark.createDataFrame(pairs, "is_attack int, score double")
    area = curves.roc_auc(df, ranges=3).first()["roc_auc"]
    expected = brute_auc(pairs)
    assert area is None if expected is None else area == pytest.approx(expected)
