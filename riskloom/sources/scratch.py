"""Small driver-side tables, intermediate tables in the cluster's shared folder, and jobs side by side."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema

from riskloom.errors import ConfigError

SMALL_ROWS = 20_000  # derived tables up to this size are held by the driver and broadcast
CONFIG_ROWS = 20_000  # configuration beyond this size is refused
SHARE_BYTES = 16 * 1024 * 1024  # shuffled (compressed) bytes that one task reads
LOCAL_DIR = "/tmp/riskloom-checkpoints"  # only for local masters without a setting


def local_table(spark: SparkSession, columns: dict[str, pa.Array]) -> DataFrame:
    """Rows already held by the driver (config, column lists) as a DataFrame.

    The result is a local relation, so Catalyst knows its exact size and decides about
    broadcasting by itself.
    """
    return spark.createDataFrame(pa.table(columns))


def collect_config(df: DataFrame) -> list:
    """All rows of a configuration-sized table; a table that is not is an error, never cut."""
    rows = df.limit(CONFIG_ROWS + 1).collect()
    if len(rows) > CONFIG_ROWS:
        raise ConfigError(f"A configuration table holds more than {CONFIG_ROWS} rows")
    return rows


def fix_small(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Turn a derived table of at most ``max_rows`` (SMALL_ROWS) rows into a local relation.

    At most ``max_rows + 1`` rows reach the driver. A larger table is returned unchanged, and
    joins with it then shuffle as usual. For flat columns without timestamps.
    """
    max_rows = SMALL_ROWS if max_rows is None else max_rows
    rows = df.limit(max_rows + 1).collect()  # reads partitions step by step and stops when full
    if len(rows) > max_rows:
        return df
    table = pa.Table.from_pylist([r.asDict() for r in rows], schema=to_arrow_schema(df.schema))
    return df.sparkSession.createDataFrame(table, schema=df.schema)


def scratch_dir(spark: SparkSession) -> str:
    """Folder of this application below the shared folder named by ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = LOCAL_DIR
    return f"{base.rstrip('/')}/riskloom/{spark.sparkContext.applicationId}"


def save_scratch(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table once and read it back.

    Cuts the lineage, survives the loss of executors and keeps column pruning for the readers.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_shares(spark: SparkSession, paths: list[str]) -> Iterator[None]:
    """Shuffles run inside deal rows to tasks in shares of about SHARE_BYTES, so that sorts and hash tables of a task
    fit its memory and don't spill; the number of shares grows with the files in ``paths``."""
    size = 0
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        size += place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
    shares = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * size // SHARE_BYTES)
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHARE_BYTES),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shares),
    }
    with session_settings(spark, settings):
        yield


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """The settings hold for jobs that are run inside, and go back to what they were."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def clear_scratch(spark: SparkSession) -> None:
    """Remove this application's intermediate tables once nothing reads them any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def side_by_side(spark: SparkSession, work: Callable, items: list, threads: int) -> list:
    """``work`` of every item, from a pool of threads, results in order.

    Each item gets a copy of its own of the caller's local properties. Spark keeps the number of the running
    query and its root among them, so threads that share one copy take each other's away, and a job fails.
    """
    with ThreadPoolExecutor(threads) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(work), item) for item in items]
        return [w.result() for w in waiting]
