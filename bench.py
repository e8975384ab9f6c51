"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from riskloom.models.families import LinearFamily, TreeFamily  # noqa: E402
from riskloom.plans import queries as Q  # noqa: E402
from riskloom.plans.backtest import backtest  # noqa: E402
from riskloom.plans.monthly import monthly_run  # noqa: E402
from riskloom.sources import snapshots as snap  # noqa: E402
from riskloom.sources.scratch import clear_scratch, scratch_dir  # noqa: E402

HEADLINES = [
    "geo_feature_list",
    "split_sizes",
    "class_weights",
    "scorecard_scores",
    "bucket_thresholds",
    "employee_risk",
    "variable_risk_history",
    "geo_drivers",
    "ews_feed_flat",
    "ews_summary",
    "action_list",
    "capture_report",
    "eval_metrics",
    "roc_curve",
    "key_quarantine",
    "leakage_scan",
    "column_profile",
    "drift_psi",
    "fairness_rates",
    "checks_load",
    "checks_shared",
    "checks_run",
    "checks_feed",
    "monthly_feed",
]


def full_backtest(spark, sf):
    """Two families for every geo with the full settings: trees of depth 6, up to 100 rounds."""
    path = f"{scratch_dir(spark)}/bench-{uuid.uuid4().hex}"
    return backtest(Q.inputs(spark, sf), [TreeFamily(path), LinearFamily(path)], snap.TRAIN_END, snap.EVAL_END).report()


def full_monthly_run(spark, sf):
    """Fit, calibrate, explain and publish one month with the full settings."""
    path = f"{scratch_dir(spark)}/bench-{uuid.uuid4().hex}"
    place = Q.warehouse(spark, "bench")
    return monthly_run(Q.inputs(spark, sf), snap.SCORING_MONTH, TreeFamily(path), place, plain_geo="AFR").checks


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("riskloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.scheduler.mode", "FAIR")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str, run) -> None:
        started = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - started, 3)

    timed("feature_store_build", lambda: snap.feature_store(spark, sf))
    for name in HEADLINES:
        timed(name, lambda: Q.EXACT[name](spark, sf).write.format("noop").mode("overwrite").save())
    for name, run in {"full_backtest": full_backtest, "full_monthly_run": full_monthly_run}.items():
        timed(name, lambda: run(spark, sf).collect())
    clear_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "seconds, feature store build and all headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf).name,
            }
        )
    )


if __name__ == "__main__":
    main()
