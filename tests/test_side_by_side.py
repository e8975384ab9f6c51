"""Every exact query against the same question in SQL on the raw tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from oracle.queries import ORACLE  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "orders", "lineitem"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)):
        return float(value)
    return value


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    found = as_rows(df.columns, [tuple(r) for r in df.collect()])
    answer = duck.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in answer.description]
    assert sorted(df.columns) == sorted(columns)
    assert found == as_rows(columns, answer.fetchall())


def test_every_exact_query_has_sql():
    from riskloom.plans.model_queries import MODELS
    from riskloom.plans.queries import EXACT

    assert set(ORACLE) == {*EXACT, *MODELS} and set(ORACLE) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.fixture()
def large_paths(spark, monkeypatch):
    """Nothing counts as small, nothing is broadcast, no partitions are merged."""
    monkeypatch.setattr("riskloom.sources.scratch.SMALL_ROWS", 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize(
    "name",
    ["employee_risk", "bucket_thresholds", "capture_report", "eval_metrics", "roc_curve", "key_quarantine", "ews_feed_flat", "code_families"],
)
def test_same_rows_beyond_every_bound(spark, duck, large_paths, name):
    test_same_rows(spark, duck, name)
