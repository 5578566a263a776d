"""Every registered query against its SQL counterpart, and the driver contract."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from tallybank.plans.registry import QUERIES, SQL
from tools.check_sql import TABLES, rows_of


@pytest.fixture(scope="module")
def database(small):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, small, database, name):
    frame = QUERIES[name](spark, small)
    result = database.execute(SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(frame.columns)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert rows_of(frame.columns, frame.collect()) == rows_of(names, result.fetchall())


def test_entry(spark):
    assert {r["FLAG"] for r in entry.entry(spark).collect()} == {"MANTER", "RETIRAR"}


def test_every_query_is_registered_once():
    assert entry.queries().keys() >= QUERIES.keys() and entry.queries().keys() >= entry.oracle_sql().keys()


def test_workers_find_the_package_from_any_folder(small, tmp_path):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    code = f"""import sys; sys.path.insert(0, {root!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert e.queries()["answer_key_extract"](spark, {small!r}).count() > 0
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
