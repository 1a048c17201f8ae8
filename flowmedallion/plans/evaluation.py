"""Full evaluation of a saved model under both protocols."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from flowmedallion import vocabulary as V
from flowmedallion.operators import curves, leakage, learning, metrics, runs
from flowmedallion.operators.encoding import feature_names
from flowmedallion.operators.sampling import TEST, TRAIN, part, temporal_split
from flowmedallion.plans.training import prepare_temporal_split, prepare_training_data
from flowmedallion.sources.models import load_model
from flowmedallion.sources.session import materialize


@dataclass(frozen=True)
class Evaluation:
    """Reports of one evaluation; every field is a small frame."""

    protocol_metrics: DataFrame
    confusion: DataFrame
    roc: DataFrame
    precision_recall: DataFrame
    average_precision: DataFrame
    missed_by_label: DataFrame
    missed_by_day: DataFrame
    identical: DataFrame
    label_comparison: DataFrame
    per_day: DataFrame
    confusion_temporal: DataFrame
    gap: DataFrame


def run_full_evaluation(
    gold: DataFrame,
    model_path: str,
    sample_size: int | None = V.SAMPLE_SIZE,
    seed: int = V.SEED,
    boosted: dict = V.BOOSTED_DEFAULTS,
    key_cols: Sequence[str] | None = None,
) -> Evaluation:
    """Score the saved model on all test rows, then fit and score a temporal model.

    The split is the one that training makes with the same seed and keys; overlap is looked
    for among all rows of both sides.  ``sample_size`` bounds the rows that the temporal
    model is fitted on, nothing else.  Scored rows are written once each, and so are the
    running counts that all curves come from.
    """
    spark = gold.sparkSession
    model, _, features = load_model(spark, model_path)
    if list(features) != feature_names(gold):
        raise ValueError(f"the model was fitted on other features: {', '.join(features)}")
    prepared = materialize(prepare_training_data(gold, None, seed, key_cols=key_cols), "evaluation")
    scored = materialize(learning.score(model, part(prepared, TEST)), "scored")
    counts = materialize(curves.running_counts(scored), "running-counts")

    by_day = materialize(prepare_temporal_split(gold, sample_size, key_cols, seed), "temporal")
    temporal_model = learning.fit_boosted(part(by_day, TRAIN), feature_names(gold), **boosted)
    scored_by_day = materialize(learning.score(temporal_model, part(by_day, TEST)), "scored-temporal")

    protocol_metrics = runs.evaluate(scored).select(
        F.lit("stratified").alias("protocol"), *runs.MEASURES
    ).unionByName(
        runs.evaluate(scored_by_day).select(F.lit("temporal").alias("protocol"), *runs.MEASURES)
    )
    return Evaluation(
        protocol_metrics=protocol_metrics,
        confusion=metrics.confusion_counts(scored),
        roc=curves.roc_curve(scored, counts=counts),
        precision_recall=curves.pr_curve(scored, counts=counts),
        average_precision=curves.average_precision(scored, counts=counts),
        missed_by_label=metrics.missed_by(scored, "label"),
        missed_by_day=metrics.missed_by(scored, "day_of_week"),
        identical=leakage.feature_identical_summary(prepared, features),
        label_comparison=leakage.label_split_comparison(temporal_split(gold)),
        per_day=metrics.metrics_by(scored_by_day),
        confusion_temporal=metrics.confusion_counts(scored_by_day),
        gap=runs.generalisation_gap(protocol_metrics),
    )
