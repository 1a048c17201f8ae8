"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

    python tools/check_queries.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def table_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(canonical(r[i]) for i in order) for r in rows), key=repr)


def compare(df, connection, sql: str) -> str | None:
    """``None`` when columns, values and kinds of values are equal, else what differs."""
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(columns)}"
    expected = table_of(columns, result.fetchall())
    actual = table_of(df.columns, df.collect())
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e or [type(x) for x in a] != [type(x) for x in e]:
            return f"columns {sorted(columns)}\n  spark {a}\n  duck  {e}"
    return None


def session(cpus: str = "8"):
    from flowmedallion.sources.session import create_spark_session

    local = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": cpus,
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="flowmedallion-"),
    }
    spark = create_spark_session("flowmedallion-check", f"local[{cpus}]", local)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()

    from flowmedallion.queries import REGISTRY

    spark, connection, failed = session(), duck(args.sf), 0
    for name in args.names or REGISTRY:
        query, start = REGISTRY[name], time.time()
        try:
            df = query.run(spark, args.sf)
            if query.sql is None:
                difference, note = None, f"{len(df.collect())} rows, no SQL"
            else:
                difference, note = compare(df, connection, query.sql), ""
        except Exception as error:  # report and go on with the other queries
            difference, note = f"{type(error).__name__}: {str(error)[:600]}", ""
        failed += difference is not None
        print(f"{'ok  ' if difference is None else 'FAIL'} {name} {time.time() - start:.1f}s {note}{difference or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
