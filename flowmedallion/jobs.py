"""The pipelines as jobs.

    spark-submit -c spark.checkpoint.dir=SHARED flowmedallion/jobs.py load DAYS --layers net --location TABLES
    ... append DAYS --layers net
    ... train net_gold MODEL
    ... grid net_gold LEDGER
    ... evaluate net_gold MODEL

Tables are catalog tables.  Each job prints its reports, a few rows each, and removes what
it stored in the scratch folder when it ends, however it ends.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from pathlib import Path

if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession

from flowmedallion.operators import runs
from flowmedallion.plans.evaluation import run_full_evaluation
from flowmedallion.plans.multiday import Layers, append_increment, layer_reports, load_multi_day
from flowmedallion.plans.training import train_models, train_multiple_configs
from flowmedallion.sources.ledger import read_runs
from flowmedallion.sources.readers import ingest_multi_day
from flowmedallion.sources.session import clear_scratch, create_spark_session

CURVES = {"roc", "precision_recall"}
"""Reports with a row for every score; jobs do not print them."""


def _layers(name: str, location: str | None = None) -> Layers:
    return Layers(f"{name}_bronze", f"{name}_silver", f"{name}_gold", location)


def load(spark: SparkSession, days: str, layers: str, location: str | None) -> None:
    names = _layers(layers, location)
    load_multi_day(spark, days, names)
    for title, report in layer_reports(spark, names).items():
        print(title)
        report.show(truncate=False)


def append(spark: SparkSession, days: str, layers: str) -> None:
    rows = ingest_multi_day(spark, days)
    if rows is None:
        raise ValueError(f"no day files in {days}")
    append_increment(rows, _layers(layers).gold)


def train(spark: SparkSession, table: str, model: str) -> None:
    trained = train_models(spark.read.table(table), model)
    trained.metrics.show(truncate=False)
    print(f"kept: {trained.best_name}")


def grid(spark: SparkSession, table: str, ledger: str) -> None:
    train_multiple_configs(spark.read.table(table), ledger)
    runs.rank_runs(read_runs(spark, ledger)).show(truncate=False)


def evaluate(spark: SparkSession, table: str, model: str) -> None:
    found = run_full_evaluation(spark.read.table(table), model)
    for title, report in vars(found).items():
        if title not in CURVES:
            print(title)
            report.show(truncate=False)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, places in (("load", ["days"]), ("append", ["days"]), ("train", ["table", "model"]),
                         ("grid", ["table", "ledger"]), ("evaluate", ["table", "model"])):
        job = jobs.add_parser(name)
        for place in places:
            job.add_argument(place)
        if "days" in places:
            job.add_argument("--layers", default="flows", help="first part of the three tables' names")
        if name == "load":
            job.add_argument("--location", help="folder for external tables")
    given = vars(parser.parse_args(arguments))
    job = {"load": load, "append": append, "train": train, "grid": grid, "evaluate": evaluate}[given.pop("job")]
    spark = create_spark_session("flowmedallion-job")
    try:
        job(spark, **given)
    finally:
        clear_scratch(spark)


if __name__ == "__main__":
    main()
