import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from flowmedallion.sources.session import create_spark_session

    scratch = tmp_path_factory.mktemp("spark")
    local = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": "4",
        "spark.default.parallelism": "4",
        "spark.checkpoint.dir": str(scratch / "checkpoints"),
        "spark.sql.warehouse.dir": str(scratch / "warehouse"),
    }
    session = create_spark_session("flowmedallion-tests", "local[8]", local)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


@pytest.fixture
def bronze(spark):
    """Six raw flows, the last one a copy of the third."""
    names = (
        "source_ip string, destination_ip string, protocol int, port int, bytes bigint, label string, "
        "timestamp timestamp, total_fwd_packets int, total_backward_packets int, "
        "fwd_packets_length_total float, bwd_packets_length_total float, "
        "fin_flag_count int, syn_flag_count int, rst_flag_count int, psh_flag_count int, "
        "ack_flag_count int, cwr_flag_count int, ece_flag_count int, "
        "flow_iat_max float, flow_iat_min float, active_max float, active_min float, "
        "idle_max float, idle_min float, idle_mean float, active_mean float, "
        "fwd_header_length int, bwd_header_length int, flow_duration bigint, "
        "_source_file string, _ingestion_ts timestamp"
    )

    zero = {name.split()[0]: 0 for name in names.split(", ") if name.split()[1] in ("int", "bigint")} | {
        name.split()[0]: 0.0 for name in names.split(", ") if name.split()[1] == "float"
    }
    flows = [
        dict(source_ip="203.0.113.7", destination_ip="198.51.100.20", protocol=17, port=5353, bytes=640, label="Benign",
             total_fwd_packets=4, total_backward_packets=4, fwd_packets_length_total=256.0, bwd_packets_length_total=384.0,
             flow_iat_max=32.0, flow_iat_min=8.0, active_max=12.0, active_min=12.0, idle_mean=6.0, active_mean=12.0,
             fwd_header_length=32, bwd_header_length=32, flow_duration=400),
        dict(source_ip="203.0.113.9", destination_ip="198.51.100.21", protocol=6, port=8443, bytes=4096, label="Benign",
             total_fwd_packets=12, total_backward_packets=3, fwd_packets_length_total=3072.0, bwd_packets_length_total=1024.0,
             fin_flag_count=1, psh_flag_count=2, ack_flag_count=9, flow_iat_max=250.0, flow_iat_min=50.0, active_max=90.0,
             active_min=30.0, idle_mean=15.0, active_mean=60.0, fwd_header_length=240, bwd_header_length=60, flow_duration=8000),
        dict(source_ip="192.0.2.33", destination_ip="198.51.100.22", protocol=6, port=21, bytes=900, label="FTP-Patator",
             total_fwd_packets=9, fwd_packets_length_total=900.0, syn_flag_count=9, flow_iat_max=20.0,
             fwd_header_length=180, flow_duration=3000),
        dict(source_ip="192.0.2.34", destination_ip="198.51.100.22", protocol=0, port=6667, bytes=75, label="Bot",
             total_fwd_packets=2, total_backward_packets=1, fwd_packets_length_total=50.0, bwd_packets_length_total=25.0,
             syn_flag_count=1, rst_flag_count=3, psh_flag_count=1, flow_iat_max=5.0, flow_iat_min=1.0, active_max=8.0,
             active_min=2.0, idle_mean=20.0, active_mean=5.0, fwd_header_length=44, bwd_header_length=20, flow_duration=60),
        dict(source_ip="192.0.2.35", destination_ip="198.51.100.23", protocol=1, port=0, bytes=3000, label=" DoS Hulk",
             total_fwd_packets=30, total_backward_packets=10, fwd_packets_length_total=2400.0, bwd_packets_length_total=600.0,
             flow_iat_max=70.0, flow_iat_min=10.0, active_max=16.0, active_min=4.0, idle_mean=10.0, active_mean=40.0,
             fwd_header_length=600, bwd_header_length=200, flow_duration=0),
    ]
    rows = [zero | {"_source_file": "probe-7.csv", "timestamp": None, "_ingestion_ts": None} | f for f in [*flows, flows[2]]]
    order = [name.split()[0] for name in names.split(", ")]
    return spark.createDataFrame([tuple(row[name] for name in order) for row in rows], names)


class JobCounter:
    """Counts the Spark jobs that run inside a block."""

    def __init__(self, spark, group):
        self.context, self.group = spark.sparkContext, group

    def __enter__(self):
        self.context.setJobGroup(self.group, self.group)
        return self

    def __exit__(self, *_):
        self.count = len(self.context.statusTracker().getJobIdsForGroup(self.group))
        self.context.setLocalProperty("spark.jobGroup.id", None)


@pytest.fixture
def jobs(spark, request):
    return JobCounter(spark, request.node.name)
