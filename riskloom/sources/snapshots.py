"""Customer-month snapshots: the feature store derived from orders, line items and customers.

One row per customer and month with at least one order. Every step that meets raw rows is an
aggregation with map-side combining, so a customer, order or region holding a large share of the
rows never lands in one task; the windows run over at most one row per customer and month.
"""

from __future__ import annotations

import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.functions.dates import month_index
from riskloom.sources.scratch import local_table, scratch_dir, small_shares
from riskloom.sources.tables import read_feature_store, write_feature_store

GEOS = ["AFR", "AME", "ASI", "EUR", "MEA"]
DATE_COLUMNS = ["RECENT_ORDER_DATE", "FIRST_ORDER_DATE", "LAST_SHIP_DATE"]
CATEGORICAL = ["MKT_SEGMENT", "NATION_NAME", "TOP_PRIORITY"]
TRAIN_END = 199912
EVAL_END = 200006
SCORING_MONTH = 200104
HORIZON_MONTHS = 3
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUSES = ["F", "O", "P"]
MANY_ORDERS = 250_000  # of one customer; beyond it, its orders are combined before they meet

COLUMNS = [
    "target",
    "YEAR_MONTH",
    "EMP_ID",
    "GEO",
    "MKT_SEGMENT",
    "NATION_NAME",
    "TOP_PRIORITY",
    "ACCT_BAL",
    "DAYS_AFTER_JOIN",
    "ORDERS_CNT",
    "ORDERS_CNT_INLAST_MONTH",
    "ORDERS_CNT_INLAST_2_MONTHS",
    "ORDERS_CNT_INLAST_3_MONTHS",
    "ORDERS_CNT_INLAST_4_MONTHS",
    "ORDERS_VALUE",
    "ORDERS_VALUE_INLAST_MONTH",
    "ORDERS_VALUE_INLAST_2_MONTHS",
    "ORDERS_VALUE_INLAST_3_MONTHS",
    "AVG_ORDER_VALUE",
    "TOTAL_LINES",
    "TOTAL_QTY",
    "TOTAL_DISCOUNT",
    "TOTAL_RETURNED",
    "TOTAL_QTY_INLAST_3_MONTHS",
    "RECENT_ORDER_DATE",
    "FIRST_ORDER_DATE",
    "LAST_SHIP_DATE",
    "CUST_NAME",
    "REGULAR_TEMP",
    "STATUS_LEAK",
]

# Flags of profile A (AFR, AME, ASI) and profile B (EUR, MEA) that differ from 1 / 1.
PROFILE_FLAGS = {
    "NATION_NAME": (0, 1),
    "AVG_ORDER_VALUE": (1, 0),
    "TOTAL_LINES": (0, 1),
    "TOTAL_QTY": (0, 1),
    "TOTAL_DISCOUNT": (0, 1),
    "TOTAL_RETURNED": (0, 1),
    "TOTAL_QTY_INLAST_3_MONTHS": (0, 1),
    "STATUS_LEAK": (0, 0),
}

EXCLUSIONS = [
    ("target", "Label"),
    ("YEAR_MONTH", "Snapshot key"),
    ("EMP_ID", "Identifier"),
    ("GEO", "Geo selector"),
    ("CUST_NAME", "Near-unique code"),
    ("REGULAR_TEMP", "Constant"),
]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def geo_code(region_name: Column) -> Column:
    return F.when(region_name == "MIDDLE EAST", "MEA").otherwise(F.left(region_name, F.lit(3)))


def geo_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per region of the data."""
    return read(spark, sf_dir, "region").select(geo_code(F.col("r_name")).alias("GEO"))


def feature_config(spark: SparkSession) -> DataFrame:
    """Wide 0/1 flags, one column per geo."""
    flags = {"MODEL_FEATURES": pa.array(COLUMNS, pa.string())}
    for geo in GEOS:
        side = 0 if geo in ("AFR", "AME", "ASI") else 1
        flags[geo] = pa.array([PROFILE_FLAGS.get(c, (1, 1))[side] for c in COLUMNS], pa.int64())
    return local_table(spark, flags)


def order_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows with their month: one row per order, so (EMP_ID, YEAR_MONTH) repeats."""
    return read(spark, sf_dir, "orders").select(
        F.concat(F.lit("E"), F.col("o_custkey").cast("string")).alias("EMP_ID"),
        F.date_format("o_orderdate", "yyyyMM").cast("long").alias("YEAR_MONTH"),
        F.col("o_orderkey"),
        F.col("o_totalprice"),
    )


def customer_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build the snapshot table. Money sums are rounded to their exact decimals, which makes the
    result independent of the order in which partial sums meet."""
    return spelt_out(month_numbers(spark, sf_dir))


def month_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots as narrow as they are shuffled: dates, levels and flags are numbers here."""
    lines = (
        read(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("lines"),
            F.sum("l_quantity").alias("qty"),
            F.round(F.sum(F.col("l_extendedprice") * F.col("l_discount")), 4).alias("discount"),
            F.count_if(F.col("l_returnflag") == "R").cast("double").alias("returned"),
            F.max("l_shipdate").alias("last_ship"),
        )
    )
    # Numbers instead of texts keep what follows a hash aggregation.
    level = F.array_position(F.array(*[F.lit(p) for p in PRIORITIES]), F.col("o_orderpriority"))
    bits = [F.when(F.col("o_orderstatus") == s, 1 << k).otherwise(0) for k, s in enumerate(STATUSES)]
    orders = (
        read(spark, sf_dir, "orders")
        .filter(F.col("o_custkey").isNotNull())
        .select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", level.alias("level"), reduce(Column.bitwiseOR, bits).alias("status"))
    )
    joined = orders.join(lines, "o_orderkey", "left")
    # Most customers have about an order a month, so combining before the shuffle gains nothing: one shuffle by
    # customer serves months and windows. With a very frequent customer, orders meet by customer and month first.
    if not _frequent_customer(orders):
        joined = joined.repartition("o_custkey")
    monthly = (
        joined.groupBy("o_custkey", F.date_format("o_orderdate", "yyyyMM").cast("long").alias("YEAR_MONTH"))
        .agg(
            F.min("level").alias("level"),
            F.min("o_orderdate").alias("first_in_month"),
            F.max("o_orderdate").alias("last_in_month"),
            F.count(F.lit(1)).cast("double").alias("ORDERS_CNT"),
            F.round(F.sum("o_totalprice"), 2).alias("ORDERS_VALUE"),
            F.sum("lines").alias("TOTAL_LINES"),
            F.sum("qty").alias("TOTAL_QTY"),
            F.round(F.sum("discount"), 4).alias("TOTAL_DISCOUNT"),
            F.sum("returned").alias("TOTAL_RETURNED"),
            F.max("last_ship").alias("last_ship"),
            F.bit_or("status").alias("status"),
        )
        .withColumn("month_no", month_index(F.col("YEAR_MONTH")))
    )

    by_month = Window.partitionBy("o_custkey").orderBy("month_no")

    def last(measure: str, months: int, digits: int) -> Column:
        total = F.sum(measure).over(by_month.rangeBetween(-months, -1))
        return F.round(F.coalesce(total, F.lit(0.0)), digits)

    later = F.count(F.lit(1)).over(by_month.rangeBetween(1, HORIZON_MONTHS))
    windowed = monthly.select(
        "*",
        F.min("first_in_month")
        .over(by_month.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        .alias("first_order"),
        F.when(F.col("YEAR_MONTH") <= SCORING_MONTH, F.when(later > 0, 0).otherwise(1)).cast("long").alias("target"),
        *[last("ORDERS_CNT", n, 0).alias(f"ORDERS_CNT_{_in_last(n)}") for n in (1, 2, 3, 4)],
        *[last("ORDERS_VALUE", n, 2).alias(f"ORDERS_VALUE_{_in_last(n)}") for n in (1, 2, 3)],
        last("TOTAL_QTY", 3, 0).alias("TOTAL_QTY_INLAST_3_MONTHS"),
    )
    customers = (
        read(spark, sf_dir, "customer")
        .join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("o_custkey"),
            F.col("c_name").alias("CUST_NAME"),
            F.col("c_mktsegment").alias("MKT_SEGMENT"),
            F.col("n_name").alias("NATION_NAME"),
            F.col("c_acctbal").alias("ACCT_BAL"),
            geo_code(F.col("r_name")).alias("GEO"),
        )
    )
    named = windowed.join(customers, "o_custkey")
    return named.withColumn("EMP_ID", F.concat(F.lit("E"), F.col("o_custkey").cast("string"))).drop("o_custkey", "month_no", "first_in_month")


def spelt_out(numbers: DataFrame) -> DataFrame:
    """Snapshots with all their columns, from ``month_numbers``; row by row."""
    month_last = F.last_day(F.to_date(F.col("YEAR_MONTH").cast("string"), "yyyyMM"))
    had = [F.when(F.col("status").bitwiseAND(1 << k) != 0, s).otherwise("") for k, s in enumerate(STATUSES)]
    return numbers.withColumns(
        {
            "TOP_PRIORITY": F.get(F.array(*[F.lit(p) for p in PRIORITIES]), F.col("level").cast("int") - 1),
            "STATUS_LEAK": F.concat(*had),
            "DAYS_AFTER_JOIN": F.datediff(month_last, F.to_date("first_order")).cast("long"),
            "AVG_ORDER_VALUE": F.round(F.col("ORDERS_VALUE") / F.col("ORDERS_CNT"), 4),
            "RECENT_ORDER_DATE": F.date_format("last_in_month", "M/d/yyyy H:mm"),
            "FIRST_ORDER_DATE": F.date_format("first_order", "yyyy-MM-dd'T'HH:mm:ss"),
            "LAST_SHIP_DATE": F.date_format("last_ship", "M/d/yyyy H:mm"),
            "REGULAR_TEMP": F.lit("R"),
        }
    ).select(*COLUMNS)


def _frequent_customer(orders: DataFrame) -> bool:
    """Whether some customer has more orders than belong in one task."""
    counts = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return bool(counts.filter(F.col("n") > MANY_ORDERS).head(1))


def _in_last(months: int) -> str:
    return "INLAST_MONTH" if months == 1 else f"INLAST_{months}_MONTHS"


_stores: dict[tuple[str, str], DataFrame] = {}


def feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored snapshots of ``sf_dir``, built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stores:
        numbers = month_numbers(spark, sf_dir)
        path = f"{scratch_dir(spark)}/feature_store-{uuid.uuid4().hex}"
        with small_shares(spark, [f"{sf_dir}/{t}.parquet" for t in ("orders", "lineitem", "customer")]):
            write_feature_store(numbers, path, spelt_out)
        _stores[key] = read_feature_store(spark, path, spelt_out(numbers).schema)
    return _stores[key]
