"""Where csv_kinds does its work: entries once for each file, plain numbers without a cast."""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.classic.dataframe import DataFrame as Classic

from flowmedallion.sources import csv_types as K
from flowmedallion.sources import readers


def test_entries_are_read_off_the_path_after_the_first_aggregate(spark, tmp_path, monkeypatch):
    spark.createDataFrame([("1", "x"), ("2.5", "")], "a string, b string").write.option("header", True).csv(f"{tmp_path}/one.csv")
    plans, collect = [], Classic.collect

    def kept(df: DataFrame):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return collect(df)

    monkeypatch.setattr(Classic, "collect", kept)
    assert readers.csv_kinds(spark, str(tmp_path)) == {"one.csv": {"a": K.INT | K.REAL, "b": K.TEXT}}
    lowest = [line for line in plans[-1].splitlines() if "%2B" in line][-1]
    assert "Aggregate [file" in lowest  # the path is decoded in what the first aggregate returns


def test_kinds_of_odd_numbers(spark):
    kinds = {
        " +12\t": K.INT, "0000000005": K.INT, "0000000000000000000005": K.INT, "2147483648": K.LONG, "-9223372036854775809": K.BIG, "9" * 39: K.REAL,
        ".5e3": K.REAL, "1.": K.REAL, "1E-5": K.REAL, "-Infinity": K.REAL, "nan": K.REAL, "+nan": K.TEXT, "1e": K.TEXT, ".": K.TEXT, "5d": K.TEXT,
    }
    rows = spark.createDataFrame([(v,) for v in kinds], "v string").select("v", K.kind(F.col("v")).alias("k")).collect()
    assert {r.v: r.k for r in rows} == kinds
