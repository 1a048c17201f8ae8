import pytest
from pyspark.sql import functions as F

from flowmedallion.operators import cleaning as C
from flowmedallion.operators import features as X
from flowmedallion.operators import profiling as P
from flowmedallion.plans.layers import clean_bronze_to_silver, transform_silver_to_gold


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_remove_duplicates(spark):
    df = spark.createDataFrame([("ab", 7), ("cd", 7), ("ab", 8), ("cd", 7), (None, 7), (None, 7), ("cd", 7)], "a string, b int")
    once = C.remove_duplicates(df)
    assert once.count() == 4 and C.remove_duplicates(once).count() == 4
    assert C.remove_duplicates(df.withColumn("file", F.monotonically_increasing_id()), ["a", "b"]).count() == 4
    assert C.remove_duplicates(df, ["b"]).count() == 2


def test_handle_nulls(spark):
    df = spark.createDataFrame([("h9", "Bot", 4), ("h8", None, None), (None, None, 3), (None, "Bot", 5), ("h7", "Bot", 6)], "source_ip string, label string, n int")
    assert C.handle_nulls(df, ["source_ip", "label"]).count() == 2
    filled = values(C.handle_nulls(df, ["source_ip"]).orderBy("source_ip"), "label", "n")
    assert filled == [("Bot", 6), ("unknown", None), ("Bot", 4)]
    assert C.handle_nulls(df, None, fill_value="?").filter("source_ip = '?'").count() == 2


def test_filter_invalid_values(spark):
    df = spark.createDataFrame([(77, 5060), (-1, 5060), (12, 65536), (None, None), (0, 65535), (9, -3), (31, 0)], "bytes bigint, port int")
    assert sorted(values(C.filter_invalid_values(df), "bytes", "port"), key=repr) == sorted(
        [(77, 5060), (None, None), (0, 65535), (31, 0)], key=repr
    )
    text = spark.createDataFrame([("61", "5060"), ("-2", "1"), ("61", "none"), (None, None)], "bytes string, port string")
    assert C.filter_invalid_values(text).count() == 2
    other = spark.createDataFrame([(1,)], "foo int")
    assert C.filter_invalid_values(other).count() == 1


def test_standardize_labels(spark):
    raw = [
        "BENIGN    ", "   DDoS", "DoS Hulk  ", " DoS slowloris ", "DoS Slowhttptest", "  DoS GoldenEye",
        "Web Attack \\x96 XSS", "Web Attack \u0096 Brute Force", "Web Attack – Sql Injection", "\tBot", None, "Benign",
    ]
    df = spark.createDataFrame([(i, label) for i, label in enumerate(raw)], "i int, label string")
    assert [v[0] for v in values(C.standardize_labels(df).orderBy("i"), "label")] == [
        "BENIGN", "DDoS", "DoS-Hulk", "DoS-Slowloris", "DoS-SlowHTTPTest", "DoS-GoldenEye",
        "Web Attack - XSS", "Web Attack - Brute Force", "Web Attack - SQL Injection", "\tBot", None, "Benign",
    ]
    assert values(C.standardize_labels(df, unify_benign=True).filter("i = 11"), "label") == [("BENIGN",)]
    assert C.standardize_labels(spark.createDataFrame([("bar",)], "foo string")).columns == ["foo"]


def test_constant_columns_match_a_distinct_count(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [("x", 0, None, 1.0, nan, -0.0, "m", True), ("x", 0, None, None, nan, 0.0, "m", True), ("x", 0, None, 1.0, nan, 0.0, "m", False)],
        "label string, zero int, none int, one_and_null double, nans double, zeros double, _meta string, flag boolean",
    )
    expected = {
        c for c in df.columns if c != "label" and not c.startswith("_") and df.select(c).distinct().count() <= 1
    }
    assert expected == {"zero", "none", "nans", "zeros"}
    assert {r["column"] for r in P.constant_columns(df).collect()} == expected
    for probe in (0, 1, 1000):
        assert set(df.columns) - set(C.drop_constant_columns(df, probe_rows=probe).columns) == expected
    assert C.drop_constant_columns(df.limit(0)).columns == ["label", "_meta"]
    assert C.drop_constant_columns(df.select("label", "_meta")).columns == ["label", "_meta"]


def test_column_that_varies_only_late_is_kept(spark):
    df = spark.range(5000, numPartitions=4).select(F.when(F.col("id") == 4999, 1).otherwise(0).alias("rare"), F.lit(7).alias("c"))
    assert C.drop_constant_columns(df).columns == ["rare"]


def test_derived_columns(spark):
    labels = ["BENIGN", "DDoS", "DoS-Hulk", "PortScan", "FTP-Patator", "Web Attack - XSS", "Bot", "Benign", "other", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "i int, label string")
    derived = values(C.add_derived_columns(df).orderBy("i"), "is_attack", "attack_category")
    assert derived == [
        (0, "Benign"), (1, "DoS"), (1, "DoS"), (1, "Probe"), (1, "Brute Force"), (1, "Web Attack"),
        (1, "Other Attack"), (1, "Unknown"), (1, "Unknown"), (1, "Unknown"),
    ]
    assert C.add_derived_columns(df.select("i")).columns == ["i"]


def test_packet_features(spark):
    df = spark.createDataFrame(
        [(7, 2, 630.0, 90.0), (4, 0, 6.0, 0.0), (0, 0, 0.0, 0.0), (2147483647, 1, 1.0, 1.0), (None, 1, None, 1.0)],
        "total_fwd_packets int, total_backward_packets int, fwd_packets_length_total float, bwd_packets_length_total float",
    )
    rows = values(
        X.add_packet_aggregate_features(df), "total_packets", "total_bytes", "fwd_bwd_packet_ratio", "fwd_bwd_bytes_ratio", "bytes_per_packet"
    )
    assert rows[0] == (9, 720.0, 3.5, 7.0, 80.0)
    assert rows[1] == (4, 6.0, 0.0, 0.0, 1.5)
    assert rows[2] == (0, 0.0, 0.0, 0.0, 0.0)
    assert rows[3][0] == 2147483648
    assert rows[4] == (None, None, None, None, None)
    assert X.add_packet_aggregate_features(df.select("total_fwd_packets")).columns == ["total_fwd_packets"]


def test_flag_timing_and_efficiency_features(spark):
    df = spark.createDataFrame(
        [(2, None, 10.0, 4.0, 0.0, 6.0, 30, 10, 0, 15, 80.0), (0, 1, 9.0, 9.0, 3.0, 6.0, 1, 1, 5, 15, 0.0)],
        "syn_flag_count int, rst_flag_count int, flow_iat_max double, flow_iat_min double, active_mean double, "
        "idle_mean double, fwd_header_length int, bwd_header_length int, flow_duration bigint, total_packets int, total_bytes double",
    )
    out = X.add_flow_efficiency_features(X.add_iat_features(X.add_flag_aggregate_features(df)))
    assert values(out, "total_flag_count", "has_syn_flag", "has_rst_flag") == [(None, 1, 0), (1, 0, 1)]
    assert values(out, "flow_iat_range", "idle_active_ratio") == [(6.0, 0.0), (0.0, 2.0)]
    assert values(out, "packet_rate", "byte_rate", "total_header_length", "header_payload_ratio") == [
        (0.0, 0.0, 40, 0.5), (3.0, 0.0, 2, 0.0)
    ]
    assert "active_range" not in out.columns


@pytest.mark.parametrize("kind", ["int", "string", "double"])
def test_protocol_name(spark, kind):
    df = spark.createDataFrame([(6,), (17,), (1,), (0,), (99,), (None,)], "protocol int").select(F.col("protocol").cast(kind))
    assert [v[0] for v in values(X.add_protocol_name(df), "protocol_name")] == ["TCP", "UDP", "ICMP", "Other", "Other", "Other"]


def test_protocol_given_as_text(spark):
    df = spark.createDataFrame([("TCP",), ("udp",), ("x",)], "protocol string")
    assert {v[0] for v in values(X.add_protocol_name(df), "protocol_name")} == {"Other"}
    assert [v[0] for v in values(X.add_protocol_name(df, accept_names=True), "protocol_name")] == ["TCP", "UDP", "Other"]
    assert X.add_protocol_name(df.select(F.lit(1).alias("foo"))).columns == ["foo"]


def test_binary_target(spark):
    df = spark.createDataFrame([("BENIGN",), ("Benign",), ("benign",), ("DDoS",), (None,)], "label string")
    assert [v[0] for v in values(X.add_binary_target(df), "is_attack")] == [0, 0, 0, 1, 1]
    assert "is_attack" not in X.add_binary_target(df.select(F.lit(1).alias("foo"))).columns


GOLD = {
    5353: dict(attack_category="Unknown", is_attack=0, protocol_name="UDP", total_packets=8, total_bytes=640.0,
               fwd_bwd_packet_ratio=1.0, fwd_bwd_bytes_ratio=2 / 3, bytes_per_packet=80.0, total_flag_count=0, has_syn_flag=0,
               has_rst_flag=0, flow_iat_range=24.0, active_range=0.0, idle_active_ratio=0.5, packet_rate=0.02, byte_rate=1.6,
               total_header_length=64, header_payload_ratio=0.1),
    8443: dict(attack_category="Unknown", is_attack=0, protocol_name="TCP", total_packets=15, total_bytes=4096.0,
               fwd_bwd_packet_ratio=4.0, fwd_bwd_bytes_ratio=3.0, bytes_per_packet=4096 / 15, total_flag_count=12, has_syn_flag=0,
               has_rst_flag=0, flow_iat_range=200.0, active_range=60.0, idle_active_ratio=0.25, packet_rate=0.001875,
               byte_rate=0.512, total_header_length=300, header_payload_ratio=300 / 4096),
    21: dict(attack_category="Brute Force", is_attack=1, protocol_name="TCP", total_packets=9, total_bytes=900.0,
             fwd_bwd_packet_ratio=0.0, fwd_bwd_bytes_ratio=0.0, bytes_per_packet=100.0, total_flag_count=9, has_syn_flag=1,
             has_rst_flag=0, flow_iat_range=20.0, active_range=0.0, idle_active_ratio=0.0, packet_rate=0.003, byte_rate=0.3,
             total_header_length=180, header_payload_ratio=0.2),
    6667: dict(attack_category="Other Attack", is_attack=1, protocol_name="Other", total_packets=3, total_bytes=75.0,
               fwd_bwd_packet_ratio=2.0, fwd_bwd_bytes_ratio=2.0, bytes_per_packet=25.0, total_flag_count=5, has_syn_flag=1,
               has_rst_flag=1, flow_iat_range=4.0, active_range=6.0, idle_active_ratio=4.0, packet_rate=0.05, byte_rate=1.25,
               total_header_length=64, header_payload_ratio=64 / 75),
    0: dict(attack_category="DoS", is_attack=1, protocol_name="ICMP", total_packets=40, total_bytes=3000.0,
            fwd_bwd_packet_ratio=3.0, fwd_bwd_bytes_ratio=4.0, bytes_per_packet=75.0, total_flag_count=0, has_syn_flag=0,
            has_rst_flag=0, flow_iat_range=60.0, active_range=12.0, idle_active_ratio=0.25, packet_rate=0.0, byte_rate=0.0,
            total_header_length=800, header_payload_ratio=800 / 3000),
}


def test_golden_gold_frame(spark, bronze):
    silver = clean_bronze_to_silver(bronze)
    assert silver.count() == 5 and len(silver.columns) == 28
    assert set(bronze.columns) - set(silver.columns) == {
        "timestamp", "cwr_flag_count", "ece_flag_count", "idle_max", "idle_min"
    }
    assert all(r["is_attack"] == 1 for r in silver.collect())
    gold = transform_silver_to_gold(silver)
    assert gold.count() == 5 and len(gold.columns) == 44 and "idle_range" not in gold.columns
    for row in gold.collect():
        for name, expected in GOLD[row["port"]].items():
            if not isinstance(expected, str):
                expected = pytest.approx(expected, rel=1e-6)
            assert row[name] == expected, (row["port"], name)


def test_order_of_rules_does_not_change_silver(spark, bronze):
    """The written order of the steps, one after the other, gives the same rows."""
    messy = bronze.union(bronze.withColumn("bytes", F.lit(-1).cast("bigint"))).union(bronze.withColumn("label", F.lit(None).cast("string")))
    step = C.handle_nulls(C.remove_duplicates(messy), C.default_critical_columns(messy))
    step = C.standardize_labels(C.filter_invalid_values(step))
    from flowmedallion.operators.schema import cast_types

    step = C.add_derived_columns(C.drop_constant_columns(cast_types(step), probe_rows=0))
    silver = clean_bronze_to_silver(messy)
    assert silver.columns == step.columns
    assert silver.exceptAll(step).count() == step.exceptAll(silver).count() == 0
    counts = {r["step"]: r["row_count"] for r in C.cleaning_step_counts(messy).collect()}
    assert counts == {"input": 18, "remove_duplicates": 15, "handle_nulls": 10, "filter_invalid_values": 5}


def test_subset_deduplication(spark, bronze):
    other_file = bronze.withColumn("_source_file", F.lit("again.csv"))
    both = bronze.union(other_file)
    business = [c for c in both.columns if not c.startswith("_")]
    assert clean_bronze_to_silver(both).count() == 10
    assert clean_bronze_to_silver(both, subset=business).count() == 5


def test_repartitioning_changes_nothing(spark, bronze):
    one, many = clean_bronze_to_silver(bronze.repartition(1)), clean_bronze_to_silver(bronze.repartition(6))
    assert one.columns == many.columns and one.exceptAll(many).count() == 0


def test_few_jobs_and_filters_at_the_scan(spark, bronze, tmp_path, jobs):
    path = str(tmp_path / "bronze")
    bronze.coalesce(1).write.parquet(path)
    table = spark.read.parquet(path)
    with jobs:
        silver = clean_bronze_to_silver(table)
    assert jobs.count <= 3  # a look at the first rows, and one aggregate with its map and reduce side
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")  # print all pushed filters
    plan = silver._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for pushed in ("IsNotNull(label)", "GreaterThanOrEqual(bytes,0)", "LessThanOrEqual(port,65535)"):
        assert pushed in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_lazy_without_constant_dropping(spark, bronze, jobs):
    with jobs:
        transform_silver_to_gold(clean_bronze_to_silver(bronze, drop_constants=False))
    assert jobs.count == 0


def test_row_steps_work_on_a_stream(spark, bronze, tmp_path):
    path = str(tmp_path / "in")
    bronze.write.parquet(path)
    stream = spark.readStream.schema(bronze.schema).parquet(path)
    stepped = transform_silver_to_gold(C.add_derived_columns(C.standardize_labels(C.filter_invalid_values(stream))))
    query = stepped.writeStream.format("memory").queryName("stream_gold").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert spark.table("stream_gold").count() == 6


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, "b")], "n int, s string")
    profiled = {r["column"]: (r["row_count"], r["nulls"], r["constant"]) for r in P.profile(df).collect()}
    assert profiled == {"n": (4, 0, True), "s": (4, 1, False)}
    assert tuple(P.duplicate_count(df).first()) == (4, 3, 1)
    gate = {r["rule"]: (r["measured"], r["passed"]) for r in P.quality_gate(df, {"min_rows_bronze": 4}).collect()}
    assert gate == {"max_null_ratio": (0.125, False), "max_duplicate_ratio": (0.25, False), "min_rows_bronze": (4.0, True)}
    empty = {r["rule"]: r["passed"] for r in P.quality_gate(df.limit(0)).collect()}
    assert empty == {"max_null_ratio": True, "max_duplicate_ratio": True, "min_rows_bronze": False}
