from dataclasses import replace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskloom.errors import ConfigError, TrainingError
from riskloom.models.families import ScorecardFamily, TreeFamily
from riskloom.operators.features import add_geo_column, bucket_config, insert_rows, set_flag
from riskloom.plans.inputs import Inputs
from riskloom.plans.monthly import monthly_run, read_feed, read_summary
from riskloom.plans.queries import CARD, inputs as fixture_inputs
from riskloom.sources.tables import create_outputs, read_table, table_exists

SF = "/root/testdata/sf0.01"  # large enough for the share checks to be meaningful
MONTH = 200104


@pytest.fixture()
def given(spark) -> Inputs:
    return fixture_inputs(spark, SF)


@pytest.fixture()
def place(spark, tmp_path):
    path = str(tmp_path / "warehouse")
    create_outputs(spark, path)
    return path


def geos_in(spark, place, table, month=MONTH):
    return {r.geo for r in read_table(spark, place, table).filter(F.col("YEAR_MONTH") == month).select("geo").distinct().collect()}


def test_run_rerun_and_other_months(spark, given, place):
    first = monthly_run(given, 200103, ScorecardFamily(CARD), place)
    monthly_run(given, MONTH, ScorecardFamily(CARD), place)
    before = read_table(spark, place, "ews_employee_risk").count()
    again = monthly_run(given, MONTH, ScorecardFamily(CARD), place)
    employee = read_table(spark, place, "ews_employee_risk")
    assert employee.count() == before
    stamps = {r.YEAR_MONTH: r.s for r in employee.groupBy("YEAR_MONTH").agg(F.min("scored_at").alias("s")).collect()}
    assert stamps[200103] < stamps[MONTH]
    assert read_table(spark, place, "risk_thresholds").count() == 10  # the earlier month keeps its cut-offs
    assert read_table(spark, place, "run_log").count() == 15
    assert first.published == again.published == ["AFR", "AME", "ASI", "EUR", "MEA"]
    summary = read_summary(spark, place, MONTH).agg(F.sum(F.col("red") + F.col("amber"))).first()[0]
    assert read_feed(spark, place, MONTH).count() == summary > 0


def test_geo_that_left_is_removed_from_the_month(spark, given, place):
    monthly_run(given, MONTH, ScorecardFamily(CARD), place)
    smaller = replace(given, geo_config=given.geo_config.filter("GEO <> 'MEA'"))
    monthly_run(smaller, MONTH, ScorecardFamily(CARD), place)
    for table in ("ews_employee_risk", "ews_variable_risk", "ews_geo_drivers", "risk_thresholds"):
        assert geos_in(spark, place, table) == {"AFR", "AME", "ASI", "EUR"}


@pytest.mark.parametrize("bad", ["AAA", "ZZZ"])
def test_bad_geo_stops_before_any_write(spark, given, place, bad):
    monthly_run(given, MONTH, ScorecardFamily(CARD), place)
    before = read_table(spark, place, "ews_employee_risk").agg(F.count(F.lit(1)), F.max("scored_at")).first()
    broken = replace(
        given,
        feature_config=add_geo_column(given.feature_config, bad),
        geo_config=insert_rows(given.geo_config, {"GEO": pa.array([bad])}),
    )
    with pytest.raises(ConfigError, match=f"No features resolved for geo {bad}"):
        monthly_run(broken, MONTH, ScorecardFamily(CARD), place)
    assert read_table(spark, place, "ews_employee_risk").agg(F.count(F.lit(1)), F.max("scored_at")).first() == before


def test_missing_bucket_rule_stops(spark, given, place):
    with pytest.raises(ConfigError, match="No bucket rule for geo EUR"):
        monthly_run(replace(given, rules=given.rules.filter("geo <> 'EUR'")), MONTH, ScorecardFamily(CARD), place)
    assert read_table(spark, place, "ews_employee_risk").count() == 0


def test_switched_off_feature_leaves_the_model(spark, given, place, tmp_path):
    one = replace(
        given,
        geo_config=given.geo_config.filter("GEO = 'ASI'"),
        feature_config=set_flag(given.feature_config, "ACCT_BAL", "ASI", 0),
        rules=bucket_config(given.geo_config.filter("GEO = 'ASI'")),
    )
    family = TreeFamily(str(tmp_path / "models"), rounds=3, depth=2, early_stop=False)
    run = monthly_run(one, MONTH, family, place)
    assert "ACCT_BAL" not in family.inputs()["btree_asi"] and len(family.inputs()["btree_asi"]) == 16
    assert table_exists(spark, place, "run_log") and run.month == MONTH
    assert geos_in(spark, place, "ews_geo_drivers") == {"ASI"}


class OneBadGeo(ScorecardFamily):
    def fit(self, history, lists):
        self.errors = {"EUR": "no luck"}
        self.lists = {g: fs for g, fs in lists.items() if g != "EUR"}

    def raise_errors(self):
        raise TrainingError("EUR: no luck")


def test_failing_geo_blocks_or_is_skipped(spark, given, place):
    monthly_run(given, MONTH, ScorecardFamily(CARD), place)
    with pytest.raises(TrainingError):
        monthly_run(given, MONTH, OneBadGeo(CARD), place)
    run = monthly_run(given, MONTH, OneBadGeo(CARD), place, on_error="skip")
    assert run.failed == {"EUR": "no luck"} and run.published == ["AFR", "AME", "ASI", "MEA"]
    employee = read_table(spark, place, "ews_employee_risk").filter(F.col("YEAR_MONTH") == MONTH)
    ages = {r.geo: r.s for r in employee.groupBy("geo").agg(F.max("scored_at").alias("s")).collect()}
    assert set(ages) == {"AFR", "AME", "ASI", "EUR", "MEA"} and ages["EUR"] < ages["AFR"]  # EUR keeps its earlier output
    statuses = {(r.geo, r.status) for r in read_table(spark, place, "run_log").filter(F.col("run_id") == run.run_id).collect()}
    assert ("EUR", "FAILED") in statuses and ("AFR", "DONE") in statuses
    assert "EUR" in {r.geo for r in read_feed(spark, place, MONTH).collect()}  # and its earlier release


class LosesRows(ScorecardFamily):
    """Scores only some rows of one geo and no driver of another."""

    def explain(self, *args, **kwargs):
        return super().explain(*args, **kwargs).filter("geo <> 'ASI' OR length(EMP_ID) % 2 = 0 AND EMP_ID NOT LIKE '%1'")

    def drivers(self, *args, **kwargs):
        return super().drivers(*args, **kwargs).filter("geo <> 'AME'")


def test_lost_rows_are_not_released(spark, given, place):
    first = monthly_run(given, MONTH, ScorecardFamily(CARD), place)
    run = monthly_run(given, MONTH, LosesRows(CARD), place)
    assert set(run.failed) == {"AME", "ASI"} and "of" in run.failed["ASI"] and run.failed["AME"] == "no drivers"
    employee = read_table(spark, place, "ews_employee_risk").filter(F.col("YEAR_MONTH") == MONTH)
    ages = {r.geo: r.s for r in employee.groupBy("geo").agg(F.max("scored_at").alias("s")).collect()}
    assert first.published == ["AFR", "AME", "ASI", "EUR", "MEA"] and ages["ASI"] < ages["AFR"]
    assert not {"AME", "ASI"} & set(run.published)
    newest = read_table(spark, place, "published").filter(F.col("run_id") == run.run_id)
    assert {r.geo for r in newest.collect()} == {"AFR", "EUR", "MEA"}


def test_rows_without_geo_are_scored_by_every_geo(spark, given, place):
    homeless = replace(given, store=given.store.withColumn("GEO", F.lit(None).cast("string")))
    monthly_run(homeless, MONTH, ScorecardFamily(CARD), place)
    counts = {r.geo: r["count"] for r in read_table(spark, place, "ews_employee_risk").groupBy("geo").count().collect()}
    n = given.store.filter(F.col("YEAR_MONTH") == MONTH).count()
    assert counts == dict.fromkeys(["AFR", "AME", "ASI", "EUR", "MEA"], n)


def test_scoring_with_the_approved_version(spark, given, place, tmp_path):
    from datetime import datetime, timezone

    from riskloom.operators.evaluate import choose_champion
    from riskloom.plans.backtest import backtest
    from riskloom.plans.monthly import approve, approved_versions, register_views

    one = replace(given, geo_config=given.geo_config.filter("GEO = 'ASI'"))
    path = str(tmp_path / "200006")
    trees = TreeFamily(path, rounds=8, depth=3, early_stop=False)
    result = backtest(one, [trees], 199912, 200006)
    approve(spark, place, choose_champion(result.metrics, "btree"), path, datetime.now(timezone.utc))
    versions = approved_versions(spark, place, "btree")
    assert versions == {"ASI": path} and approved_versions(spark, place, "logreg") == {}
    family = TreeFamily("unused")
    family.load(spark, versions)
    monthly_run(one, MONTH, family, place, fit=False)
    assert geos_in(spark, place, "ews_employee_risk") == {"ASI"}
    register_views(spark, place, one)
    released = spark.sql("SELECT geo FROM v_ews_summary").collect()  # the views follow the release flag
    assert {r.geo for r in released} == {r.geo for r in read_table(spark, place, "published").filter("published").collect()}
    assert spark.sql("SELECT n_features FROM v_geo_feature_list WHERE geo = 'ASI'").first()[0] == 17
    assert result.capture().count() > 0 and result.trade_off().count() > 0 and result.report().count() == 1


def test_month_that_became_empty_is_cleared(spark, given, place):
    monthly_run(given, MONTH, ScorecardFamily(CARD), place)
    run = monthly_run(replace(given, store=given.store.filter(F.col("YEAR_MONTH") != MONTH)), MONTH, ScorecardFamily(CARD), place)
    assert read_table(spark, place, "ews_employee_risk").count() == 0
    assert run.published == [] and read_feed(spark, place, MONTH).count() == 0


def test_repeated_employees_are_quarantined(spark, given, place):
    month = given.store.filter(F.col("YEAR_MONTH") == MONTH)
    one = month.orderBy("EMP_ID").first().EMP_ID
    twice = replace(given, store=given.store.unionByName(month.filter(F.col("EMP_ID") == one)))
    monthly_run(twice, MONTH, ScorecardFamily(CARD), place)
    assert read_table(spark, place, "ews_employee_risk").count() == month.count() - 1
    for _ in range(2):  # a re-run replaces the keys of its month
        assert [(r.EMP_ID, r.YEAR_MONTH, r.n_copies) for r in read_table(spark, place, "quarantined_keys").collect()] == [(one, MONTH, 2)]
        monthly_run(twice, MONTH, ScorecardFamily(CARD), place)
    monthly_run(given, MONTH, ScorecardFamily(CARD), place)
    assert read_table(spark, place, "quarantined_keys").count() == 0


def test_geo_whose_checks_fail_keeps_its_earlier_release(spark, given, place):
    from riskloom.plans.queries import Spoilt

    first = monthly_run(given, MONTH, ScorecardFamily(CARD), place)
    run = monthly_run(given, MONTH, Spoilt(CARD, "EUR"), place)
    assert run.published == ["AFR", "AME", "ASI", "MEA"] and run.failed == {}
    ages = {r.geo: r.s for r in read_table(spark, place, "ews_employee_risk").groupBy("geo").agg(F.max("scored_at").alias("s")).collect()}
    assert ages["EUR"] < ages["AFR"] and first.published == ["AFR", "AME", "ASI", "EUR", "MEA"]
    bad = {(r.geo, r.test_id) for r in run.verdicts.filter("status = 'FAIL'").collect()}
    assert ("EUR", "T403") in bad and {g for g, t in bad if t not in ("T405", "T406")} == {"EUR"}
    log = {r.geo: r.status for r in read_table(spark, place, "run_log").filter(F.col("run_id") == run.run_id).collect()}
    assert log == {**dict.fromkeys(["AFR", "AME", "ASI", "MEA"], "DONE"), "EUR": "CHECKS_FAILED"}


def test_run_that_dies_before_the_switch_leaves_the_month(spark, given, place, monkeypatch):
    from riskloom.plans import monthly
    from riskloom.sources.tables import read_version, versions

    monthly_run(given, MONTH, ScorecardFamily(CARD), place)
    tables = ("ews_employee_risk", "ews_variable_risk", "ews_geo_drivers", "risk_thresholds")
    before = {t: sorted(map(repr, read_table(spark, place, t).collect())) for t in tables}

    def dies(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(monthly, "switch_month", dies)
        with pytest.raises(RuntimeError):
            monthly_run(given, MONTH, ScorecardFamily(CARD), place)
    assert {t: sorted(map(repr, read_table(spark, place, t).collect())) for t in tables} == before
    written = {run for _, run, _ in versions(spark, place, MONTH)}
    assert len(written) == 2  # the new version is there, and nobody reads it
    assert all(read_version(spark, place, "ews_employee_risk", MONTH, run).count() == len(before["ews_employee_risk"]) for run in written)
    run = monthly_run(given, MONTH, ScorecardFamily(CARD), place)
    assert run.checks.filter("test_id = 'T417' and status = 'PASS'").count() == 1  # what the dead run left is gone
    assert len({r for _, r, _ in versions(spark, place, MONTH)}) == 2 and run.published == ["AFR", "AME", "ASI", "EUR", "MEA"]


def test_checks_cost_no_scan(spark, given, place):
    """Every check of a run has a verdict, though nothing was pinned and no output was read again."""
    run = monthly_run(given, MONTH, ScorecardFamily(CARD), place, plain_geo="AFR")
    status = {r.test_id: r.status for r in run.checks.collect()}
    assert all(status[t] == "PASS" for t in ("T401", "T402", "T403", "T404", "T408", "T412", "T413", "T414", "T415", "T417"))
    assert list(status) == [f"T4{k:02d}" for k in range(1, 18)]
    assert "Scan parquet" not in run.checks._jdf.queryExecution().toString() and "FileScan" not in run.checks._jdf.queryExecution().toString()
    assert read_table(spark, place, "run_checks").groupBy("geo").count().count() == 5


def test_rows_of_unknown_geos_and_empty_keys(spark, given, place):
    from riskloom.errors import QualityError

    strange = replace(given, store=given.store.withColumn("GEO", F.when(F.col("GEO") == "ASI", "XXX").otherwise(F.col("GEO"))))
    run = monthly_run(strange, MONTH, ScorecardFamily(CARD), place)
    n = given.store.filter((F.col("YEAR_MONTH") == MONTH) & (F.col("GEO") == "ASI")).count()
    assert run.unrouted == n > 0
    note = read_table(spark, place, "run_log").filter(F.col("run_id") == run.run_id).first().message
    assert f"{n} rows of geos that are not configured" in note
    nameless = replace(given, store=given.store.withColumn("EMP_ID", F.lit(None).cast("string")))
    with pytest.raises(QualityError, match="rows without EMP_ID"):
        monthly_run(nameless, MONTH, ScorecardFamily(CARD), place)


def test_repeated_keys_and_young_labels_are_not_learnt_from(spark, given, place):
    class Learns(ScorecardFamily):
        def fit(self, history, lists):
            super().fit(history, lists)
            self.months = history.agg(F.max("YEAR_MONTH")).first()[0]
            self.keys = history.groupBy("EMP_ID", "YEAR_MONTH").count().filter("count > 1").count()

    old = given.store.filter(F.col("YEAR_MONTH") == 200009)
    family = Learns(CARD)
    monthly_run(replace(given, store=given.store.unionByName(old.limit(5))), MONTH, family, place, horizon_months=3)
    assert family.months == 200101 and family.keys == 0
