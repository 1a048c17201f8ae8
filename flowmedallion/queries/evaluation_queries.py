"""Metrics, curves, overlap and comparisons on predictions derived from the flow view."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowmedallion.operators import curves, leakage, metrics, runs
from flowmedallion.operators.encoding import feature_frame, feature_names
from flowmedallion.operators.sampling import SPLIT, TEST, stratified_split
from flowmedallion.queries import adapter as A
from flowmedallion.queries.registry import query

DIGITS = 10


def rounded(df, *columns):
    return df.withColumns({c: F.round(F.col(c), DIGITS) for c in columns})


def counts_sql(pred: str = "pred", source: str = "predictions", by: str = "") -> str:
    """Confusion counts per value of ``by`` as a SQL query."""
    key, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return f"""SELECT {key}count(*) AS total_rows,
        count(*) FILTER (is_attack = 1) AS attacks, count(*) FILTER (is_attack = 0) AS benign,
        count(*) FILTER (is_attack = 0 AND {pred} = 0) AS tn, count(*) FILTER (is_attack = 0 AND {pred} = 1) AS fp,
        count(*) FILTER (is_attack = 1 AND {pred} = 0) AS fn, count(*) FILTER (is_attack = 1 AND {pred} = 1) AS tp
        FROM {source}{group}"""


def quality_sql() -> str:
    return f"""round(CASE WHEN total_rows = 0 THEN 0 ELSE (tp + tn) / CAST(total_rows AS DOUBLE) END, {DIGITS}) AS accuracy,
        round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / CAST(tp + fp AS DOUBLE) END, {DIGITS}) AS precision,
        round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / CAST(tp + fn AS DOUBLE) END, {DIGITS}) AS recall,
        round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END, {DIGITS}) AS f1_score"""


QUALITY = ("accuracy", "precision", "recall", "f1_score")


@query(
    "confusion_counts",
    A.on_predictions(
        f"""SELECT tn, fp, fn, tp, round(100.0 * tn / CAST(total_rows AS DOUBLE), 2) AS tn_percentage,
               round(100.0 * fp / CAST(total_rows AS DOUBLE), 2) AS fp_percentage,
               round(100.0 * fn / CAST(total_rows AS DOUBLE), 2) AS fn_percentage,
               round(100.0 * tp / CAST(total_rows AS DOUBLE), 2) AS tp_percentage
            FROM ({counts_sql()})"""
    ),
)
def _confusion_counts(spark, sf):
    return metrics.confusion_counts(A.predictions(spark, sf))


@query(
    "outcome_by_label",
    A.on_predictions(
        """SELECT label, CASE WHEN is_attack = 1 AND pred = 1 THEN 'TP' WHEN is_attack = 0 AND pred = 1 THEN 'FP'
                              WHEN is_attack = 1 THEN 'FN' ELSE 'TN' END AS outcome, count(*) AS row_count
           FROM predictions GROUP BY 1, 2"""
    ),
)
def _outcome_by_label(spark, sf):
    tagged = A.predictions(spark, sf).withColumn("outcome", metrics.outcome())
    return tagged.groupBy("label", "outcome").agg(F.count("*").alias("row_count"))


@query("binary_metrics", A.on_predictions(f"SELECT {quality_sql()} FROM ({counts_sql()})"))
def _binary_metrics(spark, sf):
    return rounded(metrics.binary_metrics(A.predictions(spark, sf)), *QUALITY)


@query(
    "classification_report",
    A.on_predictions(
        """, c AS (%s),
        per_class AS (
          SELECT '0' AS entry, tn / CAST(tn + fn AS DOUBLE) AS p, tn / CAST(tn + fp AS DOUBLE) AS r, tn + fp AS support FROM c
          UNION ALL
          SELECT '1', tp / CAST(tp + fp AS DOUBLE), tp / CAST(tp + fn AS DOUBLE), tp + fn FROM c),
        scored AS (SELECT entry, p, r, 2 * p * r / (p + r) AS f, support FROM per_class)
        SELECT entry, round(p, 10) AS precision, round(r, 10) AS recall, round(f, 10) AS f1_score, support FROM scored
        UNION ALL SELECT 'accuracy', NULL, NULL, round((tp + tn) / CAST(total_rows AS DOUBLE), 10), total_rows FROM c
        UNION ALL SELECT 'macro avg', round(avg(p), 10), round(avg(r), 10), round(avg(f), 10), CAST(sum(support) AS BIGINT) FROM scored
        UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 10), round(sum(r * support) / sum(support), 10),
                         round(sum(f * support) / sum(support), 10), CAST(sum(support) AS BIGINT) FROM scored"""
        % counts_sql()
    ),
)
def _classification_report(spark, sf):
    report = metrics.classification_report(A.predictions(spark, sf))
    return rounded(report, "precision", "recall", "f1_score")


@query(
    "metrics_by_day",
    A.on_predictions(
        f"""SELECT day_of_week, total_rows, attacks, benign, tn, fp, fn, tp, {quality_sql()}
            FROM ({counts_sql(source="by_day", by="day_of_week")})"""
    ),
)
def _metrics_by_day(spark, sf):
    return rounded(metrics.metrics_by(A.temporal_predictions(spark, sf)), *QUALITY)


@query(
    "f1_spread",
    A.on_predictions(
        f"""SELECT count(*) AS groups, round(max(f) - min(f), {DIGITS}) AS f1_spread
            FROM (SELECT 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) AS f
                  FROM ({counts_sql(source="by_day", by="day_of_week")}))"""
    ),
)
def _f1_spread(spark, sf):
    per_day = metrics.metrics_by(A.temporal_predictions(spark, sf))
    return rounded(metrics.f1_spread(per_day), "f1_spread")


def _missed_sql(column: str) -> str:
    return A.on_predictions(
        f"SELECT {column}, count(*) AS missed FROM predictions WHERE is_attack = 1 AND pred = 0 GROUP BY {column}"
    )


@query("missed_by_label", _missed_sql("label"))
def _missed_by_label(spark, sf):
    return metrics.missed_by(A.predictions(spark, sf), "label")


@query("missed_by_day", _missed_sql("day_of_week"))
def _missed_by_day(spark, sf):
    return metrics.missed_by(A.predictions(spark, sf), "day_of_week")


@query(
    "prediction_agreement",
    A.on_predictions(
        """SELECT count(*) AS row_count,
                  round(avg(CASE WHEN champion_pred = candidate_pred THEN 1.0 ELSE 0.0 END), 10) AS agreement
           FROM predictions"""
    ),
)
def _prediction_agreement(spark, sf):
    agreement = metrics.prediction_agreement(A.predictions(spark, sf), "champion_pred", "candidate_pred")
    return rounded(agreement, "agreement")


# --- curves ---

_RUNNING = """grouped AS (
  SELECT score, count(*) FILTER (is_attack = 1) AS p, count(*) FILTER (is_attack = 0) AS n
  FROM predictions GROUP BY score),
running AS (
  SELECT score, p, n, sum(p) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS fp,
         sum(p) OVER () AS total_p, sum(n) OVER () AS total_n
  FROM grouped)"""


@query(
    "roc_curve",
    A.on_predictions(
        """SELECT CAST(NULL AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr
           UNION ALL SELECT score, round(fp / CAST(total_n AS DOUBLE), 10), round(tp / CAST(total_p AS DOUBLE), 10)
           FROM running""",
        _RUNNING,
    ),
)
def _roc_curve(spark, sf):
    return rounded(curves.roc_curve(A.predictions(spark, sf)), "fpr", "tpr")


@query(
    "roc_auc",
    A.on_predictions(
        "SELECT round(sum(n * (tp - p + p / 2.0)) / CAST(max(total_p) * max(total_n) AS DOUBLE), 10) AS roc_auc FROM running",
        _RUNNING,
    ),
)
def _roc_auc(spark, sf):
    return rounded(curves.roc_auc(A.predictions(spark, sf)), "roc_auc")


@query(
    "pr_curve",
    A.on_predictions(
        """SELECT CAST(NULL AS DOUBLE) AS threshold, CAST(1 AS DOUBLE) AS precision, CAST(0 AS DOUBLE) AS recall
           UNION ALL SELECT score, round(tp / CAST(tp + fp AS DOUBLE), 10), round(tp / CAST(total_p AS DOUBLE), 10)
           FROM running""",
        _RUNNING,
    ),
)
def _pr_curve(spark, sf):
    return rounded(curves.pr_curve(A.predictions(spark, sf)), "precision", "recall")


@query(
    "average_precision",
    A.on_predictions(
        """SELECT round(sum(CAST(p AS DOUBLE) * tp / (tp + fp)) / max(total_p), 10) AS average_precision,
                  round(max(total_p) / CAST(max(total_p) + max(total_n) AS DOUBLE), 10) AS baseline
           FROM running""",
        _RUNNING,
    ),
)
def _average_precision(spark, sf):
    return rounded(curves.average_precision(A.predictions(spark, sf)), "average_precision", "baseline")


@query(
    "roc_auc_fine",
    A.on_predictions(
        """SELECT round(sum(n * (tp - p + p / 2.0)) / CAST(max(total_p) AS DOUBLE) / max(total_n), 10) AS roc_auc FROM running""",
        _RUNNING.replace("score", "bytes_per_packet"),
    ),
)
def _roc_auc_fine(spark, sf):
    """A score with about as many distinct values as rows, so the two-level sums are at work."""
    return rounded(curves.roc_auc(A.predictions(spark, sf), score="bytes_per_packet"), "roc_auc")


# --- overlap of train and test ---

# Few and coarse features, so that many vectors are shared and some are very frequent.
_COARSE = ["protocol", "syn_flag_count", "rst_flag_count", "ack_flag_count", "total_backward_packets", "idle_mean"]


def _coarse(spark, sf):
    # the split hash needs columns that are no features, so it comes first
    split = stratified_split(A.gold(spark, sf), A.KEYS)
    framed = feature_frame(split.select("label", "day_of_week", "is_attack", SPLIT, *_COARSE, "flow_iat_max"))
    return framed.withColumns({c: F.col(c).cast("double") for c in (*_COARSE, "flow_iat_max")})


_COARSE_SQL = """framed AS (
  SELECT label, day_of_week, is_attack, split, {},
         CAST(CAST(flow_iat_max AS FLOAT) AS DOUBLE) AS flow_iat_max
  FROM predictions)""".format(", ".join(f"CAST(coalesce(CAST({c} AS FLOAT), 0) AS DOUBLE) AS {c}" for c in _COARSE))
_GROUPS_SQL = f"""vectors AS (
  SELECT {", ".join(_COARSE)}, count(*) FILTER (split = 'train') AS train_rows, count(*) FILTER (split = 'test') AS test_rows
  FROM framed GROUP BY ALL)"""


@query(
    "feature_identical_rows",
    A.on_predictions(
        f"""SELECT f.* FROM framed f JOIN vectors v
            ON {" AND ".join(f"f.{c} = v.{c}" for c in _COARSE)} WHERE v.train_rows > 0 AND v.test_rows > 0""",
        _COARSE_SQL,
        _GROUPS_SQL,
    ),
)
def _feature_identical_rows(spark, sf):
    return leakage.feature_identical_rows(_coarse(spark, sf), _COARSE)


@query(
    "shared_feature_groups",
    A.on_predictions("SELECT * FROM vectors WHERE train_rows > 0 AND test_rows > 0", _COARSE_SQL, _GROUPS_SQL),
)
def _shared_feature_groups(spark, sf):
    return leakage.shared_feature_groups(_coarse(spark, sf), _COARSE)


@query(
    "feature_identical_summary",
    A.on_predictions(
        """SELECT CAST(sum(train_rows) AS BIGINT) AS train_size, CAST(sum(test_rows) AS BIGINT) AS test_size,
             CAST(sum(CASE WHEN train_rows > 0 AND test_rows > 0 THEN test_rows ELSE 0 END) AS BIGINT) AS test_with_counterpart,
             CAST(sum(CASE WHEN train_rows > 0 AND test_rows > 0 THEN train_rows ELSE 0 END) AS BIGINT) AS train_with_counterpart,
             count(*) FILTER (train_rows > 0 AND test_rows > 0) AS shared_vectors,
             round(100.0 * sum(CASE WHEN train_rows > 0 AND test_rows > 0 THEN test_rows ELSE 0 END)
                   / CAST(sum(test_rows) AS DOUBLE), 2) AS pct_of_test,
             round(100.0 * sum(CASE WHEN train_rows > 0 AND test_rows > 0 THEN train_rows ELSE 0 END)
                   / CAST(sum(train_rows) AS DOUBLE), 2) AS pct_of_train
           FROM vectors""",
        _COARSE_SQL,
        _GROUPS_SQL,
    ),
)
def _feature_identical_summary(spark, sf):
    return leakage.feature_identical_summary(_coarse(spark, sf), _COARSE)


@query(
    "feature_identical_full",
    A.on_predictions(
        f"""SELECT count(*) AS vectors, count(*) FILTER (train_rows > 0 AND test_rows > 0) AS shared_vectors
            FROM (SELECT count(*) FILTER (split = 'train') AS train_rows, count(*) FILTER (split = 'test') AS test_rows
                  FROM predictions GROUP BY protocol, port, bytes, fwd_packets_length_total, bwd_packets_length_total,
                       total_fwd_packets, total_backward_packets, active_mean, idle_mean, ack_flag_count,
                       syn_flag_count, rst_flag_count, flow_duration)"""
    ),
)
def _feature_identical_full(spark, sf):
    """The overlap check over every feature of Gold."""
    split = stratified_split(A.gold(spark, sf), A.KEYS)
    features = feature_names(split)
    groups = leakage.feature_groups(feature_frame(split), features, values=False)
    both = (F.col("train_rows") > 0) & (F.col("test_rows") > 0)
    return groups.agg(F.count("*").alias("vectors"), F.count(F.when(both, 1)).alias("shared_vectors"))


_COMPARISON_SQL = """comparison AS (
  SELECT label AS attack_type, count(*) FILTER (split = 'train') AS train_count, count(*) FILTER (split = 'test') AS test_count
  FROM by_day GROUP BY label),
status AS (
  SELECT *, CASE WHEN train_count > 0 AND test_count > 0 THEN 'Both' WHEN train_count > 0 THEN 'Train only'
                 ELSE 'TEST ONLY (unseen in training)' END AS status FROM comparison)"""


@query("label_split_comparison", A.on_predictions("SELECT * FROM status", _COMPARISON_SQL))
def _label_split_comparison(spark, sf):
    return leakage.label_split_comparison(A.temporal_predictions(spark, sf))


@query(
    "split_status_counts",
    A.on_predictions(
        """SELECT s.status, count(t.attack_type) AS labels
           FROM (VALUES ('Both'), ('Train only'), ('TEST ONLY (unseen in training)')) AS s(status)
           LEFT JOIN status t ON t.status = s.status GROUP BY s.status""",
        _COMPARISON_SQL,
    ),
)
def _split_status_counts(spark, sf):
    return leakage.split_status_counts(leakage.label_split_comparison(A.temporal_predictions(spark, sf)))


@query(
    "common_rows",
    A.on_predictions(
        f"""SELECT {", ".join(_COARSE)} FROM framed WHERE split = 'train'
            INTERSECT SELECT {", ".join(_COARSE)} FROM framed WHERE split = 'test'""",
        _COARSE_SQL,
    ),
)
def _common_rows(spark, sf):
    frame = _coarse(spark, sf)
    train, test = (frame.filter(F.col(SPLIT) == s).select(*_COARSE) for s in ("train", "test"))
    return leakage.common_rows(train, test)


@query(
    "frames_equal",
    A.on_predictions(
        """SELECT CAST((SELECT count(*) FROM (SELECT bytes, label, pred FROM predictions
                        EXCEPT ALL SELECT bytes, label, candidate_pred FROM predictions)) AS BIGINT) AS only_left,
                  CAST((SELECT count(*) FROM (SELECT bytes, label, candidate_pred FROM predictions
                        EXCEPT ALL SELECT bytes, label, pred FROM predictions)) AS BIGINT) AS only_right,
                  true AS same_schema, false AS equal"""
    ),
)
def _frames_equal(spark, sf):
    frame = A.predictions(spark, sf)
    left = frame.select("bytes", "label", "pred")
    right = frame.select("bytes", "label", F.col("candidate_pred").alias("pred"))
    return leakage.frames_equal(left, right)


# --- models and runs, each run being one threshold on the score ---


@query(
    "model_comparison",
    A.on_predictions(
        f"""SELECT version, accuracy, precision, recall, f1_score AS f1,
                   (SELECT round(avg(CASE WHEN champion_pred = candidate_pred THEN 1.0 ELSE 0.0 END), 10)
                    FROM by_day WHERE split = 'test') AS agreement,
                   CASE WHEN champion_f1 > candidate_f1 THEN 'champion performs better'
                        WHEN champion_f1 < candidate_f1 THEN 'candidate performs better'
                        ELSE 'both perform the same' END AS verdict
            FROM (SELECT *, max(f1_score) FILTER (version = 'champion') OVER () AS champion_f1,
                         max(f1_score) FILTER (version = 'candidate') OVER () AS candidate_f1
                  FROM (SELECT version, {quality_sql()} FROM (
                    SELECT 'champion' AS version, * FROM ({counts_sql("champion_pred", "(SELECT * FROM by_day WHERE split = 'test')")})
                    UNION ALL
                    SELECT 'candidate', * FROM ({counts_sql("candidate_pred", "(SELECT * FROM by_day WHERE split = 'test')")}))))"""
    ),
)
def _model_comparison(spark, sf):
    test = A.temporal_predictions(spark, sf).filter(F.col(SPLIT) == TEST)
    return rounded(runs.model_comparison(test), "accuracy", "precision", "recall", "f1", "agreement")


@query(
    "arm_metrics",
    A.on_predictions(
        f"""SELECT arm, total_rows AS row_count, {quality_sql()} FROM (
              {counts_sql("pred", "routed", "arm")}
              UNION ALL SELECT 'overall', * FROM ({counts_sql("pred", "routed")}))""",
        f"""routed AS (
          SELECT is_attack, arm, CASE WHEN arm = 'champion' THEN champion_pred ELSE candidate_pred END AS pred
          FROM (SELECT *, CASE WHEN substr({A.digest_sql(A.KEYS, 42)}, 1, 8) < 'b3333333' THEN 'champion'
                               ELSE 'candidate' END AS arm FROM predictions))""",
    ),
)
def _arm_metrics(spark, sf):
    return rounded(runs.arm_metrics(A.predictions(spark, sf), A.KEYS), *QUALITY)


@query(
    "best_of_two",
    A.on_predictions(
        f"""SELECT model, f1_score FROM (
              SELECT 'Random Forest' AS model, {quality_sql()} FROM ({counts_sql("champion_pred")})
              UNION ALL
              SELECT 'Gradient Boosted Trees', {quality_sql()} FROM ({counts_sql("candidate_pred")}))
            ORDER BY f1_score DESC, CASE WHEN model = 'Random Forest' THEN 0 ELSE 1 END LIMIT 1"""
    ),
)
def _best_of_two(spark, sf):
    frame = A.predictions(spark, sf)
    forest, boosted = (
        metrics.binary_metrics(frame, prediction=p).select(F.lit(name).alias("model"), "f1_score")
        for name, p in (("Random Forest", "champion_pred"), ("Gradient Boosted Trees", "candidate_pred"))
    )
    return rounded(runs.best_of_two(forest.unionByName(boosted), on_tie="Random Forest"), "f1_score")


def _threshold_runs(spark, sf):
    """A ledger with one run per distinct score used as threshold.

    Runs share names, one is untagged and one lacks a temporal F1, as in a real ledger.
    """
    measured = {}
    for protocol, frame in (("stratified", A.split_predictions(spark, sf)), ("temporal", A.temporal_predictions(spark, sf))):
        counts = curves.running_counts(frame.filter(F.col(SPLIT) == TEST)).select(
            "score",
            "tp",
            "fp",
            (F.col("total_p") - F.col("tp")).alias("fn"),
            (F.col("total_n") - F.col("fp")).alias("tn"),
        )
        measured[protocol] = metrics.with_quality(counts).select(
            "score", *[F.round(c, DIGITS).alias(f"{protocol}_{c}") for c in QUALITY]
        )
    percent = F.round(F.col("score") * 100).cast("int")
    return (
        measured["stratified"]
        .join(measured["temporal"], "score")
        .withColumns(
            {
                "run_id": F.format_string("run-%02d", percent),
                "run_name": F.concat(F.lit("threshold-"), percent % 4),
                "model_type": F.lit("threshold"),
                "training_split": F.when(percent > 0, "both"),
                "temporal_f1_score": F.when(percent != 3, F.col("temporal_f1_score")),
            }
        )
    )


def _threshold_sql(source: str) -> str:
    return f"""SELECT t.score, count(*) AS total_rows,
          count(*) FILTER (is_attack = 0 AND p.score < t.score) AS tn, count(*) FILTER (is_attack = 0 AND p.score >= t.score) AS fp,
          count(*) FILTER (is_attack = 1 AND p.score < t.score) AS fn, count(*) FILTER (is_attack = 1 AND p.score >= t.score) AS tp
        FROM {source} p, (SELECT DISTINCT score FROM {source} WHERE split = 'test') t
        WHERE split = 'test' GROUP BY t.score"""


_RUNS_SQL = f"""s AS (SELECT score, {quality_sql()} FROM ({_threshold_sql("predictions")})),
d AS (SELECT score, {quality_sql()} FROM ({_threshold_sql("by_day")})),
runs AS (
  SELECT printf('run-%02d', CAST(round(s.score * 100) AS INTEGER)) AS run_id,
         'threshold-' || CAST(CAST(round(s.score * 100) AS INTEGER) % 4 AS VARCHAR) AS run_name,
         'threshold' AS model,
         s.accuracy AS strat_accuracy, s.precision AS strat_precision, s.recall AS strat_recall, s.f1_score AS strat_f1,
         d.accuracy AS temp_accuracy, d.precision AS temp_precision, d.recall AS temp_recall,
         CASE WHEN CAST(round(s.score * 100) AS INTEGER) <> 3 THEN d.f1_score END AS temp_f1
  FROM s JOIN d ON s.score = d.score WHERE round(s.score * 100) > 0)"""


@query("rank_runs", A.on_predictions("SELECT * FROM runs", _RUNS_SQL))
def _rank_runs(spark, sf):
    return runs.rank_runs(_threshold_runs(spark, sf))


@query(
    "rank_runs_by_name",
    A.on_predictions(
        """SELECT * EXCLUDE (place) FROM (
             SELECT *, row_number() OVER (PARTITION BY run_name ORDER BY temp_f1 DESC, run_id) AS place
             FROM runs WHERE temp_f1 IS NOT NULL) WHERE place = 1""",
        _RUNS_SQL,
    ),
)
def _rank_runs_by_name(spark, sf):
    return runs.rank_runs(_threshold_runs(spark, sf), best_per_name=True)


@query(
    "best_run",
    A.on_predictions(
        "SELECT * FROM runs WHERE temp_f1 IS NOT NULL ORDER BY temp_f1 DESC, run_id LIMIT 1", _RUNS_SQL
    ),
)
def _best_run(spark, sf):
    return runs.best_run(_threshold_runs(spark, sf))


def _auc_sql(source: str) -> str:
    return f"""(SELECT sum(n * (tp - p + p / 2.0)) / CAST(max(total_p) * max(total_n) AS DOUBLE) FROM (
          SELECT score, p, n, sum(p) OVER (ORDER BY score DESC) AS tp, sum(p) OVER () AS total_p, sum(n) OVER () AS total_n
          FROM (SELECT score, count(*) FILTER (is_attack = 1) AS p, count(*) FILTER (is_attack = 0) AS n
                FROM {source} WHERE split = 'test' GROUP BY score)))"""


def _f1_sql(source: str) -> str:
    return f"""(SELECT 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE)
          FROM ({counts_sql(source=f"(SELECT * FROM {source} WHERE split = 'test')")}))"""


@query(
    "generalisation_gap",
    A.on_predictions(
        """SELECT round(sf, 10) AS stratified_f1_score, round(sa, 10) AS stratified_roc_auc,
                  round(tf, 10) AS temporal_f1_score, round(ta, 10) AS temporal_roc_auc,
                  round(sf - tf, 10) AS f1_difference, round(sa - ta, 10) AS auc_difference,
                  CASE WHEN sf - tf < 0.02 THEN 'small' WHEN sf - tf < 0.10 THEN 'moderate' ELSE 'significant' END AS verdict
           FROM measured""",
        f"""measured AS (SELECT {_f1_sql("predictions")} AS sf, {_auc_sql("predictions")} AS sa,
                                {_f1_sql("by_day")} AS tf, {_auc_sql("by_day")} AS ta)""",
    ),
)
def _generalisation_gap(spark, sf):
    frames = {"stratified": A.split_predictions(spark, sf), "temporal": A.temporal_predictions(spark, sf)}
    rows = [
        runs.evaluate(frame.filter(F.col(SPLIT) == TEST)).withColumn("protocol", F.lit(protocol))
        for protocol, frame in frames.items()
    ]
    gap = runs.generalisation_gap(rows[0].unionByName(rows[1]))
    return rounded(gap, *[c for c in gap.columns if c != "verdict"])
