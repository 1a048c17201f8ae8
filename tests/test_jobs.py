from pathlib import Path

import pytest
from pyspark.sql import functions as F

from flowmedallion import jobs
from flowmedallion import vocabulary as V
from flowmedallion.operators import learning
from flowmedallion.plans import training
from flowmedallion.sources.session import clear_scratch, materialize, scratch_root


def test_load_and_append(spark, bronze, tmp_path, capsys):
    raw = bronze.drop("_source_file", "_ingestion_ts", "timestamp")
    for folder, days in (("first", ("Monday", "Tuesday")), ("later", ("Friday",))):
        for day in days:
            raw.write.parquet(str(tmp_path / folder / f"net-{day}.parquet"))
    jobs.main(["load", str(tmp_path / "first"), "--layers", "job", "--location", str(tmp_path / "tables")])
    assert "attack_rate_by_day" in capsys.readouterr().out
    jobs.main(["append", str(tmp_path / "later"), "--layers", "job"])
    counts = {r["day_of_week"]: r["count"] for r in spark.read.table("job_gold").groupBy("day_of_week").count().collect()}
    assert counts == {"Monday": 5, "Tuesday": 5, "Friday": 5}
    with pytest.raises(ValueError, match="no day files"):
        jobs.main(["append", str(tmp_path / "none"), "--layers", "job"])


def test_learning_jobs(spark, tmp_path, capsys, monkeypatch):
    days = F.array(*[F.lit(d) for d in V.TRAIN_DAYS + V.TEST_DAYS])
    rows = spark.range(400).select(
        F.when(F.col("id") % 3 == 0, "DDoS").otherwise("BENIGN").alias("label"),
        F.element_at(days, (F.col("id") % F.size(days) + 1).cast("int")).alias("day_of_week"),
        (F.col("id") % 97 + 50 * (F.col("id") % 3 == 0).cast("int")).cast("int").alias("total_packets"),
        F.col("id").alias("bytes"),
        (F.col("id") % 3 == 0).cast("int").alias("is_attack"),
    )
    rows.write.mode("overwrite").saveAsTable("job_rows")
    small = {"n_estimators": 2, "max_depth": 2}
    monkeypatch.setattr(training.train_models, "__defaults__", (*training.train_models.__defaults__[:2], small, small | {"learning_rate": 0.1}, None))
    monkeypatch.setattr(
        training.train_multiple_configs, "__defaults__", ((("one", learning.FOREST, small),), *training.train_multiple_configs.__defaults__[1:])
    )
    evaluation = jobs.run_full_evaluation
    monkeypatch.setattr(jobs, "run_full_evaluation", lambda gold, model: evaluation(gold, model, boosted=small | {"learning_rate": 0.1}))
    jobs.main(["train", "job_rows", str(tmp_path / "model")])
    jobs.main(["evaluate", "job_rows", str(tmp_path / "model")])
    jobs.main(["grid", "job_rows", str(tmp_path / "ledger")])
    out = capsys.readouterr().out
    assert "kept: " in out and "confusion_temporal" in out and "one" in out


def test_scratch_is_cleared(spark):
    frame = materialize(spark.range(5), "gone")
    folder = Path(scratch_root(spark)) / "flowmedallion" / spark.sparkContext.applicationId
    assert frame.count() == 5 and folder.exists()
    clear_scratch(spark)
    assert not folder.exists()
    clear_scratch(spark)
