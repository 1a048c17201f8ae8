"""Readers, writers and tables.  Each query writes whole tables to scratch space and reads them back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from flowmedallion.operators import reports
from flowmedallion.plans.layers import clean_bronze_to_silver, transform_silver_to_gold
from flowmedallion.plans.multiday import Layers, append_increment, layer_reports, load_layers, load_multi_day
from flowmedallion.queries import adapter as A
from flowmedallion.queries.cleaning_queries import _messy
from flowmedallion.queries.registry import query
from flowmedallion.sources import readers, tables
from flowmedallion.sources.session import scratch_path, unsorted_writes
from flowmedallion.sources.synth import synthesize_flows

_CSV = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
_PLAIN = [c for c in A.FLOW_COLUMNS if c != '"timestamp"']
_TS_SQL = A.text_sql('"timestamp"')


def _text_time(df):
    return df.withColumn("ts", A.as_text("timestamp")).drop("timestamp")


@query("scan_csv_roundtrip", A.on_flows(f"SELECT {', '.join(_PLAIN)}, {_TS_SQL} AS ts FROM flows"))
def _scan_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    A.flows(spark, sf).write.options(**_CSV).csv(path)
    return _text_time(readers.read_csv(spark, path))


_RAW = ["source_ip", "destination_ip", "protocol", "port", "bytes", "label", "flow_duration"]


@query(
    "bronze_ingest",
    A.on_flows(
        f"""SELECT {', '.join(_RAW)},
              CASE WHEN flow_duration > 0 THEN CAST(total_fwd_packets AS DOUBLE) / flow_duration END AS packet_rate,
              CASE WHEN day_of_week IN ('Thursday', 'Friday') THEN 'flows-late.csv' ELSE 'flows-early.csv' END AS _source_file
            FROM flows"""
    ),
)
def _bronze_ingest(spark, sf):
    """Two CSV entries with raw column names, different column orders and infinite rates."""
    path = scratch_path(spark, "raw-csv")
    flows = A.flows(spark, sf)
    rate = F.when(F.col("flow_duration") == 0, float("inf")).otherwise(
        F.col("total_fwd_packets").cast("double") / F.col("flow_duration")
    )
    raw = flows.select(*[F.col(c).alias(_messy(c)) for c in _RAW], rate.alias("Packet/Rate"), "day_of_week")
    late = F.col("day_of_week").isin("Thursday", "Friday")
    columns = [c for c in raw.columns if c != "day_of_week"]
    raw.filter(~late).select(*columns).write.options(**_CSV).csv(f"{path}/flows-early.csv")
    raw.filter(late).select(*reversed(columns)).write.options(**_CSV).csv(f"{path}/flows-late.csv")
    return readers.ingest_csv_to_bronze_memory(spark, path).drop(readers.INGESTION_TS)


def _kind_sql(column: str) -> str:
    """Entry, column and state of its values: 1 int, 2 long, 8 other numbers, 128 text."""
    return f"""SELECT CASE WHEN day_of_week IN ('Thursday', 'Friday') THEN 'late.csv' ELSE 'early.csv' END AS entry, '{column}' AS name,
        bit_or(CASE WHEN {column} IS NULL THEN 0 WHEN typeof({column}) = 'VARCHAR' THEN 128
                    WHEN typeof({column}) = 'DOUBLE' OR typeof({column}) LIKE 'DECIMAL%' THEN 8
                    WHEN TRY_CAST({column} AS INTEGER) IS NOT NULL THEN 1 ELSE 2 END) AS state
        FROM flows GROUP BY 1"""


@query("csv_kinds", A.on_flows(" UNION ALL ".join(_kind_sql(c) for c in _PLAIN)))
def _csv_kinds(spark, sf):
    """States of every column of two entries with different column orders, found in one aggregate."""
    path = scratch_path(spark, "raw-csv")
    flows = A.flows(spark, sf).select(*_PLAIN)
    late = F.col("day_of_week").isin("Thursday", "Friday")
    flows.filter(~late).write.options(**_CSV).csv(f"{path}/early.csv")
    flows.filter(late).select(*reversed(_PLAIN)).write.options(**_CSV).csv(f"{path}/late.csv")
    found = readers.csv_kinds(spark, path)
    return spark.createDataFrame([(e, c, s) for e, kinds in found.items() for c, s in kinds.items()], "entry string, name string, state int")


@query(
    "bronze_files",
    A.on_flows(
        """SELECT source_ip, bytes, label,
              CASE WHEN day_of_week IN ('Thursday', 'Friday') THEN 'late.csv' ELSE 'early.csv' END AS _source_file
           FROM flows"""
    ),
)
def _bronze_files(spark, sf):
    """CSV folder to one Parquet folder per file."""
    path = scratch_path(spark, "raw-csv")
    raw = A.flows(spark, sf).select(
        F.col("source_ip").alias(" Source IP"), F.col("bytes").alias("Bytes"), F.col("label").alias(" Label"), "day_of_week"
    )
    late = F.col("day_of_week").isin("Thursday", "Friday")
    for name, rows in (("early", raw.filter(~late)), ("late", raw.filter(late))):
        rows.drop("day_of_week").write.options(**_CSV).csv(f"{path}/{name}.csv")
    readers.ingest_csv_to_bronze(spark, path, f"{path}/bronze")
    early, late = (spark.read.parquet(f"{path}/bronze/{n}") for n in ("early", "late"))
    return early.unionByName(late).drop(readers.INGESTION_TS)


@query(
    "bronze_parquet",
    A.on_flows(
        f"""SELECT {', '.join(c for c in _PLAIN if c != '_source_file')}, {_TS_SQL} AS ts,
                   'flows-Week.parquet' AS _source_file FROM flows"""
    ),
)
def _bronze_parquet(spark, sf):
    path = f"{scratch_path(spark, 'raw')}/flows-Week.parquet"
    flows = A.flows(spark, sf).drop("_source_file")
    flows.toDF(*[_messy(c) for c in flows.columns]).write.parquet(path)
    return _text_time(readers.ingest_parquet_to_bronze_memory(spark, path).drop(readers.INGESTION_TS))


def _write_day_files(spark, sf) -> str:
    """One Parquet entry per day, as a capture would arrive."""
    path = scratch_path(spark, "days")
    flows = A.flows(spark, sf)
    raw = flows.drop("_source_file").withColumn("_day", F.col("day_of_week")).drop("day_of_week")
    with unsorted_writes(spark):
        raw.write.partitionBy("_day").parquet(f"{path}/all")
    for day in _DAYS:  # names only: the rows were written once
        tables.rename_path(spark, f"{path}/all/_day={day}", f"{path}/flows-{day}.parquet")
    return path


@query("bronze_multi_day", A.on_flows(f"SELECT {', '.join(_PLAIN)}, {_TS_SQL} AS ts FROM flows"))
def _bronze_multi_day(spark, sf):
    bronze = readers.ingest_multi_day(spark, _write_day_files(spark, sf))
    return _text_time(bronze.drop(readers.INGESTION_TS))


_DRAWS = "CAST('0x' || substr(md5(concat_ws('|', '42', '{}', CAST(event_id AS VARCHAR))), 1, 8) AS BIGINT) / 4294967296.0"


def _draw_sql(name: str) -> str:
    return f"({_DRAWS.format(name)})"


@query(
    "synth_flows",
    f"""SELECT event_id,
          '198.51.100.' || CAST(20 + CAST(floor({_draw_sql("source_ip")} * 24) AS INTEGER) AS VARCHAR) AS source_ip,
          '203.0.113.' || CAST(1 + CAST(floor({_draw_sql("destination_ip")} * 7) AS INTEGER) AS VARCHAR) AS destination_ip,
          (['UDP', 'TCP', 'ICMP'])[1 + CAST(floor({_draw_sql("protocol")} * 3) AS INTEGER)] AS protocol,
          ([123, 389, 993, 1883, 5060, 5432, 8883, 27017])[1 + CAST(floor({_draw_sql("port")} * 8) AS INTEGER)] AS port,
          CAST(floor({_draw_sql("bytes")} * 64961) + 40 AS BIGINT) AS bytes,
          CASE WHEN l < 0.65 THEN 'BENIGN' WHEN l < 0.80 THEN 'PortScan' WHEN l < 0.90 THEN 'DDoS'
               WHEN l < 0.95 THEN 'Bot' ELSE 'DoS-Slowloris' END AS label,
          strftime(TIMESTAMP '2031-05-04 06:00:00' + to_seconds(CAST(floor({_draw_sql("timestamp")} * 259201) AS BIGINT)),
                   '%Y-%m-%dT%H:%M:%S') AS "timestamp"
        FROM (SELECT event_id, {_draw_sql("label")} AS l FROM events)""",
)
def _synth_flows(spark, sf):
    """One synthetic flow per event."""
    return synthesize_flows(A.table(spark, sf, "events"), id_col="event_id")


@query("table_roundtrip", A.on_flows(f"SELECT {', '.join(_PLAIN)}, {_TS_SQL} AS ts FROM flows"))
def _table_roundtrip(spark, sf):
    """The second overwrite has another schema than the first."""
    name, path = "flowmedallion_roundtrip", scratch_path(spark, "table")
    flows = A.flows(spark, sf)
    tables.write_table(flows.select("source_ip"), name, path=f"{path}/first")
    tables.write_table(flows, name, path=f"{path}/second", partition_by=("day_of_week",))
    return _text_time(spark.read.table(name))


@query(
    "table_append",
    A.on_flows(
        """SELECT source_ip, bytes, CASE WHEN day_of_week IN ('Thursday', 'Friday') THEN NULL ELSE label END AS label
           FROM flows"""
    ),
)
def _table_append(spark, sf):
    """Later days are appended; they arrive in another order, as int text and without a label."""
    name, path = "flowmedallion_append", scratch_path(spark, "table")
    flows = A.flows(spark, sf)
    late = F.col("day_of_week").isin("Thursday", "Friday")
    tables.write_table(flows.filter(~late).select("source_ip", "bytes", "label"), name, path=path)
    tables.append_table(flows.filter(late).select(F.col("bytes").cast("string").alias("bytes"), "source_ip"), name)
    return spark.read.table(name)


_UPSERTED = f"""SELECT event_id, user_id, event_type, props, {A.text_sql('ts')} AS ts,
                   CASE WHEN event_type IN ('click', 'error') THEN value + 1000 ELSE value END AS value FROM events"""


def _upsert_sides(spark, sf):
    events = A.table(spark, sf, "events")
    target = events.filter(F.col("event_type") != "error")
    return target, events.filter(F.col("event_type").isin("click", "error")).withColumn("value", F.col("value") + 1000)


@query(
    "upsert_by_key",
    _UPSERTED,
)
def _upsert_by_key(spark, sf):
    """Clicks are updated and errors are new; the rest stays."""
    return tables.upsert(*_upsert_sides(spark, sf), ["event_id"]).withColumn("ts", A.as_text("ts"))


@query("upsert_table", _UPSERTED)
def _upsert_table(spark, sf):
    """The same as a load: the stored table is replaced by its merged state and read back."""
    name = "flowmedallion_upsert"
    target, source = _upsert_sides(spark, sf)
    tables.write_table(target, name, path=scratch_path(spark, "upsert"))
    tables.upsert_table(source, name, ["event_id"], path=scratch_path(spark, "upsert"))
    return spark.read.table(name).withColumn("ts", A.as_text("ts"))


_ORDERS = f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, {A.text_sql('o_orderdate')} AS o_orderdate FROM orders"


def _text_date(df):
    return df.withColumn("o_orderdate", A.as_text("o_orderdate"))


@query("compact_table", _ORDERS)
def _compact_table(spark, sf):
    path = scratch_path(spark, "compact")
    A.table(spark, sf, "orders").repartition(32).write.parquet(f"{path}/small")
    return _text_date(tables.compact(spark.read.parquet(f"{path}/small"), f"{path}/packed"))


def _loads(spark, sf) -> str:
    """Orders in three loads by status."""
    path = scratch_path(spark, "loads")
    orders = A.table(spark, sf, "orders")
    for load_id, status in enumerate(("F", "O", "P"), start=1):
        tables.append_load(orders.filter(F.col("o_orderstatus") == status), path, load_id)
    return path


def _priced(sf_orders, statuses, more):
    return sf_orders.filter(F.col("o_orderstatus").isin(*statuses)).withColumn("o_totalprice", F.col("o_totalprice") + more)


@query(
    "as_of_update",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, {A.text_sql('o_orderdate')} AS o_orderdate, load, price FROM orders,
        LATERAL (SELECT unnest([1, 2, 3]) AS load,
                 unnest([o_totalprice, CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END,
                         CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice + 2 END]) AS price)
        WHERE load = 3 OR o_orderstatus <> 'P'""",
)
def _as_of_update(spark, sf):
    """Orders after each of three loads; the second updates, the third updates and adds and is run twice."""
    path, orders = scratch_path(spark, "validity"), A.table(spark, sf, "orders")
    tables.upsert_load(_priced(orders, ("F", "O"), 0), path, 1, ["o_orderkey"])
    tables.upsert_load(_priced(orders, ("O",), 1), path, 2, ["o_orderkey"])
    for _ in range(2):
        tables.upsert_load(_priced(orders, ("O", "P"), 2), path, 3, ["o_orderkey"])
    table = spark.read.parquet(path)
    states = [tables.as_of_upsert(table, load).withColumn("load", F.lit(load)) for load in (1, 2, 3)]
    return _text_date(reduce(lambda a, b: a.unionByName(b), states)).withColumnRenamed("o_totalprice", "price")


@query("upsert_by_partition", _UPSERTED)
def _upsert_by_partition(spark, sf):
    """The merge into a table with partitions, of which only some are touched."""
    name = "flowmedallion_upsert_partitions"
    target, source = _upsert_sides(spark, sf)
    tables.write_table(target, name, path=scratch_path(spark, "upsert"), partition_by=("event_type",))
    tables.upsert_table(source, name, ["event_id"])
    return spark.read.table(name).withColumn("ts", A.as_text("ts"))


@query(
    "as_of_load",
    f"{_ORDERS} WHERE o_orderstatus IN ('F', 'O')",
)
def _as_of_load(spark, sf):
    return _text_date(tables.as_of_load(spark.read.parquet(_loads(spark, sf)), 2))


@query(
    "load_log",
    f"""SELECT CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS _load_id, count(*) AS row_count,
               {A.text_sql('min(o_orderdate)')} AS first_ts, {A.text_sql('max(o_orderdate)')} AS last_ts
        FROM orders WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY 1""",
)
def _load_log(spark, sf):
    log = tables.load_log(spark.read.parquet(_loads(spark, sf)), ts_col="o_orderdate")
    return log.withColumns({"first_ts": A.as_text("first_ts"), "last_ts": A.as_text("last_ts")})


def _report(df, name: str, key: str, rows: str, attacks: str | None = None):
    return df.select(
        F.lit(name).alias("report"),
        F.col(key).cast("string").alias("key"),
        F.col(rows).alias("row_count"),
        (F.col(attacks) if attacks else F.lit(None)).cast("bigint").alias("attacks"),
    )


@query(
    "medallion_report",
    A.on_gold(
        """SELECT 'layer' AS report, 'bronze' AS key, count(*) AS row_count, CAST(NULL AS BIGINT) AS attacks FROM flows
           UNION ALL SELECT 'layer', 'silver', count(*), NULL FROM silver
           UNION ALL SELECT 'layer', 'gold', count(*), NULL FROM gold
           UNION ALL SELECT 'day', day_of_week, count(*), CAST(sum(is_attack) AS BIGINT) FROM gold GROUP BY day_of_week
           UNION ALL SELECT 'label', label, count(*), NULL FROM gold GROUP BY label
           UNION ALL SELECT 'target', CAST(is_attack AS VARCHAR), count(*), NULL FROM gold GROUP BY is_attack"""
    ),
)
def _medallion_report(spark, sf):
    """Day files through three stored layers, then the reports."""
    layers = Layers("flowmedallion_bronze", "flowmedallion_silver", "flowmedallion_gold", scratch_path(spark, "layers"))
    gold = load_multi_day(spark, _write_day_files(spark, sf), layers)
    found = layer_reports(spark, layers)
    parts = [
        _report(found["layer_counts"], "layer", "layer", "row_count"),
        _report(found["attack_rate_by_day"], "day", "day_of_week", "total_flows", "attacks"),
        _report(found["count_by_label"], "label", "label", "row_count"),
        _report(reports.count_by(gold, "is_attack"), "target", "is_attack", "row_count"),
    ]
    united = parts[0]
    for one in parts[1:]:
        united = united.unionByName(one)
    return united


@query(
    "incremental_append",
    A.on_gold(
        """SELECT day_of_week, label, is_attack, count(*) AS row_count, CAST(sum(total_packets) AS BIGINT) AS packets
           FROM gold GROUP BY ALL"""
    ),
)
def _incremental_append(spark, sf):
    """Gold of the first days is stored; the other days then go through all steps and are appended."""
    name, path = "flowmedallion_gold_increment", scratch_path(spark, "increment")
    flows = A.flows(spark, sf)
    late = F.col("day_of_week").isin("Thursday", "Friday")
    first = transform_silver_to_gold(clean_bronze_to_silver(flows.filter(~late), together=("day_of_week",)))
    tables.write_table(first, name, path=path, partition_by=("day_of_week",), gather=False)
    append_increment(flows.filter(late), name)
    return (
        spark.read.table(name)
        .groupBy("day_of_week", "label", "is_attack")
        .agg(F.count("*").alias("row_count"), F.sum("total_packets").alias("packets"))
    )


@query(
    "incremental_repeat",
    A.on_gold(
        """SELECT day_of_week, label, is_attack, count(*) AS row_count, CAST(sum(total_packets) AS BIGINT) AS packets,
             CAST(sum(CASE WHEN day_of_week IN ('Thursday', 'Friday') THEN 7 ELSE 0 END) AS BIGINT) AS newcomer
           FROM gold GROUP BY ALL"""
    ),
)
def _incremental_repeat(spark, sf):
    """Like incremental_append, but a column that was constant begins to vary, and the increment is run twice."""
    layers = Layers("flowmedallion_repeat_bronze", "flowmedallion_repeat_silver", "flowmedallion_repeat_gold", scratch_path(spark, "repeat"))
    flows = A.flows(spark, sf)
    late = F.col("day_of_week").isin("Thursday", "Friday")
    load_layers(spark, flows.filter(~late).withColumn("newcomer", F.lit(0)), layers, load_id="first", gather=False)
    for _ in range(2):
        append_increment(flows.filter(late).withColumn("newcomer", F.lit(7)), layers.gold, evolve=True, load_id="late", gather=False)
    return (
        spark.read.table(layers.gold)
        .groupBy("day_of_week", "label", "is_attack")
        .agg(F.count("*").alias("row_count"), F.sum("total_packets").alias("packets"), F.sum("newcomer").alias("newcomer"))
    )
