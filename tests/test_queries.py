"""Every registered query against its SQL."""

import inspect

import pytest
from check_queries import compare, duck

import __spark_entry__ as entry
from flowmedallion.queries import REGISTRY

WITH_SQL = [name for name, query in REGISTRY.items() if query.sql is not None]
# fitted at full size; the same job runs small in test_learning
FULL_SIZE = {"rf_train_score", "gbt_train_score", "top_features", "config_grid"}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", [name for name in WITH_SQL if name not in FULL_SIZE])
def test_query_equals_sql(spark, sf_dir, connection, name):
    assert compare(REGISTRY[name].run(spark, sf_dir), connection, REGISTRY[name].sql) is None


def test_contract(spark):
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(entry.LLM_QUERIES) <= set(queries) and set(entry.LLM_SQL) <= set(sql)
    queries = {name: run for name, run in queries.items() if name not in entry.LLM_QUERIES}
    sql = {name: text for name, text in sql.items() if name not in entry.LLM_SQL}
    assert set(queries) == set(sql)
    assert all(len(inspect.signature(run).parameters) == 2 for run in queries.values())
    rows = entry.entry(spark).collect()
    assert len(rows) == 7 and set(rows[0].asDict()) == {"day_of_week", "total_flows", "attacks", "attack_rate"}
