"""Exact classification metrics from one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flowmedallion.functions.expressions import count_where, percentage, ratio_or_zero

LABEL = "is_attack"
PREDICTION = "pred"


def outcome(label: str = LABEL, prediction: str = PREDICTION) -> Column:
    """TP, FP, FN or TN of a row."""
    actual, predicted = F.col(label), F.col(prediction)
    return (
        F.when((actual == 1) & (predicted == 1), "TP")
        .when((actual == 0) & (predicted == 1), "FP")
        .when((actual == 1) & (predicted == 0), "FN")
        .when((actual == 0) & (predicted == 0), "TN")
    )


def outcome_counts(label: str = LABEL, prediction: str = PREDICTION) -> list[Column]:
    actual, predicted = F.col(label), F.col(prediction)
    return [
        count_where((actual == 0) & (predicted == 0)).alias("tn"),
        count_where((actual == 0) & (predicted == 1)).alias("fp"),
        count_where((actual == 1) & (predicted == 0)).alias("fn"),
        count_where((actual == 1) & (predicted == 1)).alias("tp"),
    ]


def quality(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    """accuracy, precision, recall and F1 of the positive class; 0 where undefined."""
    return {
        "accuracy": ratio_or_zero(tp + tn, tp + tn + fp + fn),
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        # the harmonic mean of precision and recall, written with counts
        "f1_score": ratio_or_zero(F.lit(2) * tp, F.lit(2) * tp + fp + fn),
    }


def with_quality(counts: DataFrame) -> DataFrame:
    return counts.withColumns(quality(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")))


def confusion_counts(df: DataFrame, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    """One row: tn, fp, fn, tp and the share of each in percent."""
    counts = df.agg(*outcome_counts(label, prediction))
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return counts.withColumns({f"{c}_percentage": percentage(F.col(c), total) for c in counts.columns})


def binary_metrics(df: DataFrame, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    """One row: accuracy, precision, recall, f1_score."""
    counts = df.agg(*outcome_counts(label, prediction))
    return with_quality(counts).select("accuracy", "precision", "recall", "f1_score")


def classification_report(df: DataFrame, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    """Per class, accuracy, macro and weighted averages: precision, recall, F1, support."""
    counts = df.agg(*outcome_counts(label, prediction))
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    positive = quality(tn, fp, fn, tp)
    # the other class: swap the roles of the two classes
    negative = quality(tp, fn, fp, tn)
    negatives, positives = tn + fp, fn + tp
    total = negatives + positives
    measures = ("precision", "recall", "f1_score")

    def row(name: str, values: dict[str, Column], support: Column) -> Column:
        cells = [values[m].cast("double").alias(m) for m in measures]
        return F.struct(F.lit(name).alias("entry"), *cells, support.alias("support"))

    macro = {m: (negative[m] + positive[m]) / 2 for m in measures}
    weighted = {m: ratio_or_zero(negative[m] * negatives + positive[m] * positives, total) for m in measures}
    accuracy = {"precision": F.lit(None), "recall": F.lit(None), "f1_score": positive["accuracy"]}
    return counts.select(
        F.inline(
            F.array(
                row("0", negative, negatives),
                row("1", positive, positives),
                row("accuracy", accuracy, total),
                row("macro avg", macro, total),
                row("weighted avg", weighted, total),
            )
        )
    )


def metrics_by(
    df: DataFrame, column: str = "day_of_week", label: str = LABEL, prediction: str = PREDICTION
) -> DataFrame | None:
    """Counts and metrics per value, in text order; ``None`` when the column is not there."""
    if column not in df.columns:
        return None
    counts = df.groupBy(column).agg(
        F.count("*").alias("total_rows"),
        count_where(F.col(label) == 1).alias("attacks"),
        count_where(F.col(label) == 0).alias("benign"),
        *outcome_counts(label, prediction),
    )
    return with_quality(counts).orderBy(column)


def f1_spread(per_day: DataFrame) -> DataFrame:
    """Difference between best and worst F1; null for a single group."""
    spread = F.max("f1_score") - F.min("f1_score")
    return per_day.agg(F.count("*").alias("groups"), F.when(F.count("*") > 1, spread).alias("f1_spread"))


def missed_by(
    df: DataFrame, column: str, label: str = LABEL, prediction: str = PREDICTION
) -> DataFrame:
    """Missed attacks (false negatives) per value, most first."""
    missed = df.filter((F.col(label) == 1) & (F.col(prediction) == 0))
    counts = missed.groupBy(column).agg(F.count("*").alias("missed"))
    return counts.orderBy(F.col("missed").desc(), column)


def prediction_agreement(df: DataFrame, first: str, second: str) -> DataFrame:
    """Share of rows on which two prediction columns agree."""
    same = F.avg(F.when(F.col(first) == F.col(second), 1.0).otherwise(0.0))
    return df.agg(F.count("*").alias("row_count"), same.alias("agreement"))
