"""Output tables: declared schemas, month replacement, appends."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from riskloom.sources.scratch import fix_small, local_table

EMPLOYEE_RISK = (
    "geo string, EMP_ID string, YEAR_MONTH bigint, risk_score double, risk_bucket string, "
    "risk_rank_in_geo bigint, top_risk_drivers string, model_name string, scored_at timestamp"
)
VARIABLE_RISK = (
    "geo string, EMP_ID string, YEAR_MONTH bigint, feature string, feature_value string, "
    "risk_contribution double, driver_rank bigint, scored_at timestamp"
)
GEO_DRIVERS = "geo string, YEAR_MONTH bigint, feature string, attribution double, scored_at timestamp"
THRESHOLDS = (
    "geo string, YEAR_MONTH bigint, method string, red_top_pct bigint, amber_next_pct bigint, "
    "red_threshold double, amber_threshold double, updated_at timestamp"
)
RUN_LOG = (
    "run_id string, geo string, YEAR_MONTH bigint, status string, n_scored bigint, seconds double, "
    "message string, logged_at timestamp"
)
APPROVED = "geo string, family string, model_path string, roc_auc double, approved_at timestamp"
PUBLISHED = "geo string, YEAR_MONTH bigint, run_id string, published boolean, published_at timestamp"

RUN_CHECKS = (
    "run_id string, geo string, YEAR_MONTH bigint, test_id string, expected string, observed string, "
    "status string, checked_at timestamp"
)
QUARANTINED = "EMP_ID string, YEAR_MONTH bigint, n_copies bigint, run_id string, quarantined_at timestamp"

SCHEMAS = {
    "ews_employee_risk": EMPLOYEE_RISK,
    "ews_variable_risk": VARIABLE_RISK,
    "ews_geo_drivers": GEO_DRIVERS,
    "risk_thresholds": THRESHOLDS,
    "run_log": RUN_LOG,
    "run_checks": RUN_CHECKS,
    "published": PUBLISHED,
    "approved_models": APPROVED,
    "quarantined_keys": QUARANTINED,
}

#: Tables with a folder per month, geo and run; the release table says which run of a geo-month is read.
VERSIONED = ("ews_employee_risk", "ews_variable_risk", "ews_geo_drivers", "risk_thresholds")


def _fs_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def table_exists(spark: SparkSession, warehouse: str, table: str) -> bool:
    fs, target = _fs_path(spark, f"{warehouse}/{table}")
    return fs.exists(target)


def create_outputs(spark: SparkSession, warehouse: str) -> None:
    """Create the output folders that are missing."""
    for table in SCHEMAS:
        fs, target = _fs_path(spark, f"{warehouse}/{table}")
        if not fs.exists(target):
            fs.mkdirs(target)


def table_list(spark: SparkSession, warehouse: str, names: list[str]) -> DataFrame:
    """Which of the named tables exist, as rows."""
    found = [n for n in names if table_exists(spark, warehouse, n)]
    return local_table(spark, {"table_name": pa.array(found, pa.string())})


def read_table(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """An output table with its declared column order. Month and geo predicates prune folders.

    Of a versioned table the released version of each geo and month is read, and nothing else.
    """
    schema = _parse_datatype_string(SCHEMAS[table])
    if table not in VERSIONED:
        return spark.read.schema(schema).parquet(f"{warehouse}/{table}").select(*schema.fieldNames())
    rows = spark.read.schema(schema.add("run_id", "string")).parquet(f"{warehouse}/{table}")
    released = fix_small(releases(spark, warehouse))
    return rows.join(released, ["geo", "YEAR_MONTH", "run_id"], "left_semi").select(*_parse_datatype_string(SCHEMAS[table]).fieldNames())


def read_version(spark: SparkSession, warehouse: str, table: str, month: int, run_id: str) -> DataFrame:
    """What one run wrote for a month, released or not."""
    schema = _parse_datatype_string(SCHEMAS[table])
    rows = spark.read.schema(schema.add("run_id", "string")).parquet(f"{warehouse}/{table}")
    return rows.filter((F.col("YEAR_MONTH") == month) & (F.col("run_id") == run_id)).select(*_parse_datatype_string(SCHEMAS[table]).fieldNames())


def releases(spark: SparkSession, warehouse: str) -> DataFrame:
    """(geo, YEAR_MONTH, run_id) of every released geo-month: its newest entry, unless that withdraws it."""
    newest = latest_by(read_table(spark, warehouse, "published"), ["geo", "YEAR_MONTH"], "published_at")
    return newest.filter("published").select("geo", "YEAR_MONTH", "run_id")


def write_feature_store(df: DataFrame, path: str, finish: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Store snapshots by month, sorted by GEO so that a geo predicate skips row groups.

    Rebalancing by month sizes the files: a month larger than the target is split, small months
    are merged into one task. ``finish`` adds columns that needn't be shuffled or sorted, row by row.
    """
    order = [c for c in ("YEAR_MONTH", "GEO", "EMP_ID") if c in df.columns]
    laid_out = df.hint("rebalance", "YEAR_MONTH").sortWithinPartitions(*order)
    if finish:
        laid_out = finish(laid_out)
    laid_out.write.mode("overwrite").partitionBy("YEAR_MONTH").parquet(path)


def read_feature_store(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Snapshots in their declared column order. Month predicates prune folders."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def write_version(df: DataFrame, warehouse: str, table: str, run_id: str, sort: list[str]) -> None:
    """First phase of a replacement: a run's rows in folders of their own, which nobody reads yet.

    Rebalancing splits the files of a geo much larger than the rest.
    """
    rows = df.withColumn("run_id", F.lit(run_id)).hint("rebalance", "geo").sortWithinPartitions("geo", *sort)
    rows.write.mode("append").partitionBy("YEAR_MONTH", "geo", "run_id").parquet(f"{warehouse}/{table}")


def switch_month(spark: SparkSession, warehouse: str, run_id: str, month: int, states: dict[str, bool], now: datetime) -> None:
    """Second phase: geos whose version of the month is read from now on (True), or that are withdrawn (False).

    One file is added, by one rename: readers see all of it or nothing, and a run that dies before leaves
    the month as it was. Other geos keep their release.
    """
    if not states:
        return
    n = len(states)
    table = local_table(
        spark,
        {
            "geo": pa.array(list(states), pa.string()),
            "YEAR_MONTH": pa.array([month] * n, pa.int64()),
            "run_id": pa.array([run_id] * n, pa.string()),
            "published": pa.array(list(states.values()), pa.bool_()),
        },
    )
    append_rows(table.withColumn("published_at", F.lit(now).cast("timestamp")), warehouse, "published")


def versions(spark: SparkSession, warehouse: str, month: int) -> list[tuple[str, str, str]]:
    """(geo, run_id, folder) of every version of a month; a few per geo."""
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    out = []
    for table in VERSIONED:
        fs, pattern = _fs_path(spark, f"{warehouse}/{table}/YEAR_MONTH={month}/geo=*/run_id=*")
        for status in fs.globStatus(pattern) or []:
            path = status.getPath()
            out.append((unescape(path.getParent().getName()[4:]), path.getName()[7:], path.toString()))
    return out


def drop_versions(spark: SparkSession, warehouse: str, month: int, keep: set[tuple[str, str]]) -> None:
    """Remove versions of a month that are not in ``keep``, pairs (geo, run_id). One run per month at a time."""
    for geo, run_id, folder in versions(spark, warehouse, month):
        if (geo, run_id) not in keep:
            fs, path = _fs_path(spark, folder)
            fs.delete(path, True)


def append_rows(df: DataFrame, warehouse: str, table: str) -> None:
    """Append rows to an unpartitioned log table."""
    df.coalesce(1).write.mode("append").parquet(f"{warehouse}/{table}")


def latest_by(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The newest row per key of an append-only table, by map-side aggregation."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.col(order)).alias("last"))
        .select(*keys, *[F.col(f"last.{c}").alias(c) for c in rest])
    )
