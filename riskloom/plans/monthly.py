"""The monthly run: guard, fit, calibrate, score, check, publish."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from riskloom.functions.dates import month_plus
from riskloom.operators.buckets import calibrate
from riskloom.operators.checks import literal_rows
from riskloom.operators.features import geo_feature_list
from riskloom.operators.feed import ews_feed, ews_summary
from riskloom.operators.quality import KEY, duplicate_keys, gate_required
from riskloom.operators.risk import employee_risk, variable_risk
from riskloom.operators.routing import calibration_rows, history_rows
from riskloom.operators.verdicts import Verdict, by_geo, employee_metrics, held_back, input_metrics, judge, metrics_of, totals, variable_metrics
from riskloom.plans.inputs import Inputs
from riskloom.sources.scratch import collect_config, fix_small, local_table, save_scratch, side_by_side
from riskloom.sources.tables import append_rows, drop_versions, latest_by, read_table, releases, switch_month, versions, write_version


@dataclass(frozen=True)
class MonthlyRun:
    """``checks``: over all geos; ``verdicts``: per geo, what released it or held it back."""

    run_id: str
    month: int
    started_at: datetime
    checks: DataFrame
    verdicts: DataFrame
    published: list[str]
    failed: dict[str, str]
    unrouted: int


def monthly_run(
    inputs: Inputs,
    month: int,
    family,
    warehouse: str,
    on_error: str = "stop",
    fit: bool = True,
    telemetry_prefix: str = "TOTAL_",
    plain_geo: str = "",
    required: tuple[str, ...] = ("EMP_ID",),
    horizon_months: int = 0,
) -> MonthlyRun:
    """Score one month for every geo and release it geo by geo.

    All geos and the month's required columns are checked before anything is fitted. Keys that occur
    more than once are neither learnt from nor scored; the month's go to ``quarantined_keys``, which a re-run
    replaces. Labels are learnt from once they are final, ``horizon_months`` after their month.

    Outputs are written as a version of their own, which nobody reads. Checks are judged per geo, from
    metrics that were observed while writing. Then one entry releases the geos that passed: they are read
    in their new version, the others in their earlier one, which also holds if the run dies before.
    With ``on_error='skip'`` a geo that cannot be fitted is logged as FAILED while the others are released.
    A geo that lost rows, its cut-offs or its drivers on the way is INCOMPLETE, one whose checks fail
    CHECKS_FAILED. ``fit=False`` scores with models that ``family.load`` took over.
    """
    clock = time.monotonic()
    started = datetime.now(timezone.utc)
    run_id = uuid.uuid4().hex[:12]
    selected = inputs.selected()
    lists = inputs.checked_lists(selected)
    spark = inputs.store.sparkSession
    features = inputs.features().filter(F.col("YEAR_MONTH") <= month)
    gate_required(inputs.store.filter(F.col("YEAR_MONTH") == month), required)

    repeated = save_scratch(duplicate_keys(features.select(*KEY)), "repeated")
    features = features.join(repeated, KEY, "left_anti")
    if fit:
        history = history_rows(features, month)
        family.fit(history.filter(F.col("YEAR_MONTH") <= month_plus(month, -horizon_months)) if horizon_months else history, lists)
    failed = dict(family.errors)
    if on_error != "skip" or len(failed) == len(lists):
        family.raise_errors()
    fitted = [g for g in sorted(lists) if g not in failed]

    window = calibration_rows(features, month)
    thresholds = fix_small(calibrate(family.score(window).select("geo", "risk_score"), inputs.active_rules()).filter(F.col("geo").isin(fitted)))
    cutoffs = {r.geo: (r.red_threshold, r.amber_threshold) for r in thresholds.collect()}
    fresh = [r.geo for r in thresholds.filter((F.col("method") != "PERCENTILE") | (F.col("n_scores") > 0)).collect() if _in_order(cutoffs[r.geo])]
    seen = {name: Observation(f"{name}-{run_id}") for name in ("input", "employee", "variable")}
    own_lists = {g: lists[g] for g in fitted}
    scored = features.filter(F.col("YEAR_MONTH") == month).observe(seen["input"], *input_metrics(fitted, own_lists))
    stage = save_scratch(family.explain(scored), "stage")

    stamp = F.lit(started).cast("timestamp")
    employee = employee_risk(stage, thresholds, ("target",)).observe(seen["employee"], *employee_metrics(fitted, cutoffs))
    variable = variable_risk(stage).observe(seen["variable"], *variable_metrics(fitted, own_lists, plain_geo, telemetry_prefix))
    drivers = fix_small(family.drivers(window)).select("geo", F.lit(month).cast("long").alias("YEAR_MONTH"), "feature", "attribution", stamp.alias("scored_at"))
    history = thresholds.select(
        "geo",
        F.lit(month).cast("long").alias("YEAR_MONTH"),
        "method",
        "red_top_pct",
        "amber_next_pct",
        "red_threshold",
        "amber_threshold",
        stamp.alias("updated_at"),
    )
    outputs = [
        (employee.drop("target").withColumn("scored_at", stamp), "ews_employee_risk", ["risk_bucket", "EMP_ID"]),
        (variable.withColumn("scored_at", stamp), "ews_variable_risk", ["EMP_ID", "driver_rank"]),
        (drivers, "ews_geo_drivers", ["feature"]),
        (history, "risk_thresholds", []),
    ]

    def write(output: tuple) -> None:
        df, table, sort = output
        write_version(df, warehouse, table, run_id, sort)

    side_by_side(spark, write, outputs, len(outputs))
    quarantined = repeated.filter(F.col("YEAR_MONTH") == month).drop("YEAR_MONTH")
    quarantined = quarantined.withColumn("run_id", F.lit(run_id)).withColumn("quarantined_at", stamp)
    quarantined.write.mode("overwrite").parquet(f"{warehouse}/quarantined_keys/YEAR_MONTH={month}")

    observed = {key: value for observation in seen.values() for key, value in metrics_of(observation).items()}
    metrics = by_geo(fitted, observed)
    per_geo = {g: m["n"] for g, m in metrics.items() if m["n"]}
    parts = {"cut-offs": dict.fromkeys(cutoffs, 1), "drivers": _rows_by_geo(drivers)}
    lost = _lost(fitted, {g: m["want"] for g, m in metrics.items()}, per_geo, parts)
    inputs_of = {model: len(set(found)) for model, found in family.inputs().items()}
    models = {g: (family.n_inputs(lists[g]), inputs_of.get(f"{family.prefix}_{g.lower()}", 0)) for g in fitted}
    verdicts = [v for g in fitted for v in judge(g, metrics[g], models[g], parts["drivers"].get(g, 0), len(lists[g]), g in fresh)]

    before = {(r.geo, r.run_id) for r in collect_config(releases(spark, warehouse).filter(F.col("YEAR_MONTH") == month))}
    keep = before | {(g, run_id) for g in fitted}
    drop_versions(spark, warehouse, month, keep)
    leftovers = sum((geo, run) not in keep for geo, run, _ in versions(spark, warehouse, month))
    named = {f"{family.prefix}_{g.lower()}": pair for g, pair in models.items()}
    checks = literal_rows(spark, totals(metrics, named, list(parts["drivers"]), fresh, plain_geo, leftovers))
    held = held_back(verdicts, {r.test_id: r.status for r in checks.collect()})

    complete = [g for g in fitted if g not in lost]
    released = [g for g in complete if g in per_geo and g not in held]
    empty = [g for g in complete if g not in per_geo]
    gone = sorted(geo for geo, _ in before if geo not in lists)
    table = _verdict_table(spark, run_id, month, verdicts, started)
    append_rows(table, warehouse, "run_checks")
    switch_month(spark, warehouse, run_id, month, {**dict.fromkeys(released, True), **dict.fromkeys([*empty, *gone], False)}, datetime.now(timezone.utc))
    unrouted = observed.get("unrouted", 0)
    _log(spark, warehouse, run_id, month, sorted(lists), per_geo, failed, lost, held, unrouted, time.monotonic() - clock, started)
    return MonthlyRun(run_id, month, started, checks, table.drop("run_id", "YEAR_MONTH", "checked_at"), released, {**failed, **lost}, unrouted)


def _in_order(cutoffs: tuple) -> bool:
    red, amber = cutoffs
    return red is not None and amber is not None and 0 < amber < red < 1


def _rows_by_geo(df: DataFrame) -> dict[str, int]:
    return {r.geo: r.n for r in df.groupBy("geo").agg(F.count(F.lit(1)).alias("n")).collect()}


def _lost(geos: list[str], expected: dict[str, int], found: dict[str, int], parts: dict[str, dict[str, int]]) -> dict[str, str]:
    """Geos whose output isn't complete, and why: counted from the inputs, not from the output."""
    out = {}
    for geo in geos:
        want, got = expected.get(geo, 0), found.get(geo, 0)
        missing = [name for name, rows in parts.items() if want and not rows.get(geo)]
        if want != got:
            out[geo] = f"{got} of {want} rows scored"
        elif missing:
            out[geo] = f"no {' and no '.join(missing)}"
    return out


def _verdict_table(spark, run_id: str, month: int, verdicts: list[Verdict], now: datetime) -> DataFrame:
    n = len(verdicts)
    text = lambda name: pa.array([getattr(v, name) for v in verdicts], pa.string())
    table = local_table(
        spark,
        {
            "run_id": pa.array([run_id] * n, pa.string()),
            "geo": text("geo"),
            "YEAR_MONTH": pa.array([month] * n, pa.int64()),
            **{name: text(name) for name in ("test_id", "expected", "observed", "status")},
        },
    )
    return table.withColumn("checked_at", F.lit(now).cast("timestamp"))


def _log(spark, warehouse, run_id, month, geos, per_geo, failed, lost, held, unrouted, seconds, now) -> None:
    status = ["FAILED" if g in failed else "INCOMPLETE" if g in lost else "CHECKS_FAILED" if g in held else "DONE" for g in geos]
    note = [failed.get(g) or lost.get(g) or ", ".join(held.get(g, [])) for g in geos]
    if unrouted:
        note = [f"{m + '; ' if m else ''}{unrouted} rows of geos that are not configured" for m in note]
    n = len(geos)
    table = local_table(
        spark,
        {
            "run_id": pa.array([run_id] * n, pa.string()),
            "geo": pa.array(geos, pa.string()),
            "YEAR_MONTH": pa.array([month] * n, pa.int64()),
            "status": pa.array(status, pa.string()),
            "n_scored": pa.array([per_geo.get(g, 0) for g in geos], pa.int64()),
            "seconds": pa.array([seconds] * n, pa.float64()),
            "message": pa.array(note, pa.string()),
        },
    )
    append_rows(table.withColumn("logged_at", F.lit(now).cast("timestamp")), warehouse, "run_log")


def approve(spark, warehouse: str, champions: DataFrame, model_path: str, now: datetime) -> None:
    """Record the approved version per geo: rows (geo, approved_family, roc_auc) fitted under ``model_path``.

    Going back to an earlier version is one more row.
    """
    rows = champions.select(
        "geo",
        F.col("approved_family").alias("family"),
        F.lit(model_path).alias("model_path"),
        "roc_auc",
        F.lit(now).cast("timestamp").alias("approved_at"),
    )
    append_rows(rows, warehouse, "approved_models")


def approved_versions(spark, warehouse: str, family: str) -> dict[str, str]:
    """geo -> path of the newest approved version, for the geos where ``family`` is approved."""
    newest = latest_by(read_table(spark, warehouse, "approved_models"), ["geo"], "approved_at")
    return {r.geo: r.model_path for r in collect_config(newest.filter(F.col("family") == family))}


def register_views(spark, warehouse: str, inputs: Inputs) -> None:
    """Temporary views for SQL users: features, feature lists, feed and summary of released geo-months."""
    inputs.features().createOrReplaceTempView("v_model_features")
    geo_feature_list(inputs.selected()).createOrReplaceTempView("v_geo_feature_list")
    employee = read_table(spark, warehouse, "ews_employee_risk")
    ews_feed(employee, read_table(spark, warehouse, "ews_variable_risk")).createOrReplaceTempView("v_ews_feed")
    ews_summary(employee).createOrReplaceTempView("v_ews_summary")


def read_feed(spark, warehouse: str, month: int) -> DataFrame:
    """The alert feed of a month, for the geos that were released."""
    in_month = F.col("YEAR_MONTH") == month
    return ews_feed(
        read_table(spark, warehouse, "ews_employee_risk").filter(in_month),
        read_table(spark, warehouse, "ews_variable_risk").filter(in_month),
    )


def read_summary(spark, warehouse: str, month: int) -> DataFrame:
    """The summary of a month, for the geos that were released."""
    return ews_summary(read_table(spark, warehouse, "ews_employee_risk").filter(F.col("YEAR_MONTH") == month))
