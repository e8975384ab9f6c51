"""The feature store's build: its shuffles, and a very frequent customer."""

from datetime import datetime

import pytest

from riskloom.sources import scratch, snapshots


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Two customers, one of them with most of the orders; an order key that comes twice, empty keys and values."""
    place = str(tmp_path_factory.mktemp("tables"))

    def save(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{place}/{name}.parquet")

    day = lambda k: datetime(1998, 1 + k % 12, 1 + k % 28)
    orders = [(k, 1 if k % 5 else 2, "FOP"[k % 3], 100.25 * k, day(k), snapshots.PRIORITIES[k % 5]) for k in range(40)]
    orders += [(7, 1, None, 3.5, day(7), None), (50, None, "F", 1.0, day(1), "5-LOW"), (51, 2, "P", None, None, "5-LOW"), (None, 1, "O", 2.0, day(3), "2-HIGH")]
    lines = [(k % 45, 2.0 + k % 3, 10.5 * k, 0.05, "RNA"[k % 3], day(k + 2)) for k in range(120)] + [(None, 1.0, 1.0, 0.1, "R", day(1))]
    save("orders", orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")
    save("lineitem", lines, "l_orderkey bigint, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp")
    save("customer", [(1, "Customer#1", 0, 10.5, "A"), (2, "Customer#2", 1, None, None), (2, "Customer#2 again", 1, 1.0, "B")], "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    save("nation", [(0, "N0", 0), (1, "N1", 1)], "n_nationkey int, n_name string, n_regionkey int")
    save("region", [(0, "AFRICA"), (1, "MIDDLE EAST")], "r_regionkey int, r_name string")
    return place


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_months_and_windows_share_one_shuffle(spark, folder):
    plan = snapshots.month_numbers(spark, folder)._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in plan.splitlines() if "Exchange hashpartitioning(o_custkey" in line]
    assert len(keys) == 1 and "YEAR_MONTH" not in keys[0]


def test_frequent_customer_is_combined_first(spark, folder, monkeypatch):
    found = rows_of(snapshots.customer_months(spark, folder))
    monkeypatch.setattr(snapshots, "MANY_ORDERS", 5)
    frequent = snapshots.customer_months(spark, folder)
    plan = frequent._jdf.queryExecution().executedPlan().toString()
    assert any("partial_bit_or" in line for line in plan.split("Exchange hashpartitioning(o_custkey")[2].splitlines())
    assert rows_of(frequent) == found and len(found) > 12


def test_stored_snapshots_are_the_built_ones(spark, folder):
    store = snapshots.feature_store(spark, folder)
    assert store.columns == snapshots.COLUMNS
    assert rows_of(store) == rows_of(snapshots.customer_months(spark, folder))


def test_small_shares_grow_with_the_input_and_end(spark, folder, monkeypatch):
    monkeypatch.setattr(scratch, "SHARE_BYTES", 64)
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    with scratch.small_shares(spark, [f"{folder}/orders.parquet"]):
        assert int(spark.conf.get(name)) > int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") in ("64", "64b")
    assert spark.conf.get(name, None) is None
