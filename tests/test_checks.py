"""The suites pass on the fixture, and each check turns to FAIL on an input broken for it."""

import pytest
from pyspark.sql import functions as F

from riskloom.models.families import ScorecardFamily, model_inputs
from riskloom.operators import checks as C
from riskloom.operators import feed as feeds
from riskloom.operators import risk, routing
from riskloom.operators.features import feature_flags
from riskloom.operators.scorecard import score_with
from riskloom.plans import queries as Q
from riskloom.sources.scratch import save_scratch
from riskloom.sources import snapshots as S

SF = "/root/testdata/sf0.01"


def statuses(df):
    return {r.test_id: r.status for r in df.collect()}


def test_suites_pass(spark):
    for query in (Q.checks_load, Q.checks_shared, Q.checks_backtest, Q.checks_run, Q.checks_feed):
        found = statuses(query(spark, SF))
        assert "FAIL" not in found.values(), (query.__name__, found)


@pytest.fixture(scope="module")
def world(spark):
    i = Q.inputs(spark, SF)
    family = ScorecardFamily(Q.CARD)
    family.fit(i.store, i.checked_lists())
    stage = save_scratch(Q.month_stage(spark, SF), "t_stage")
    cut = Q.month_thresholds(spark, SF)
    employee = save_scratch(risk.employee_risk(stage, cut), "t_employee")
    held = score_with(Q.routed(routing.calibration_rows(i.features(), Q.MONTH)), Q.CARD, None)
    return {
        "i": i,
        "cut": cut.withColumn("fresh", F.lit(True)),
        "employee": employee,
        "variable": save_scratch(risk.variable_risk(stage), "t_variable"),
        "drivers": risk.geo_drivers(held).withColumn("YEAR_MONTH", F.lit(Q.MONTH).cast("long")),
        "inputs": model_inputs(spark, family),
    }


def run_checks(w, **changes):
    i = w["i"]
    parts = {
        "employee": w["employee"], "variable": w["variable"], "drivers": w["drivers"], "thresholds": w["cut"],
        "selected": i.selected(), "labels": i.store, "model_inputs": w["inputs"], "leftovers": i.geo_config.limit(0),
    }
    parts.update(changes)
    pinned = {"T401": "167", "T402": "5 geos, min 24, max 38", "T412": "scorecard_afr:4, scorecard_ame:4, scorecard_asi:4, scorecard_eur:4, scorecard_mea:4", "T413": "5", "T414": "5"}
    return statuses(C.checks_run(Q.MONTH, plain_geo="AFR", telemetry_prefix="TOTAL_", pinned=pinned, **parts))


def test_run_suite_reacts(spark, world):
    assert "FAIL" not in run_checks(world).values()
    e, v, d, cut = world["employee"], world["variable"], world["drivers"], world["cut"]
    is_first = F.col("EMP_ID") == e.orderBy("EMP_ID").first().EMP_ID
    broken = {
        "T401": {"employee": e.filter(~is_first)},
        "T402": {"employee": e.filter("geo <> 'EUR'")},
        "T403": {"employee": e.withColumn("risk_score", F.when(is_first, 1.5).otherwise(F.col("risk_score")))},
        "T404": {"employee": e.withColumn("risk_bucket", F.when(F.col("risk_bucket") == "RED", "AMBER").otherwise(F.col("risk_bucket")))},
        "T405": {"employee": e.withColumn("risk_bucket", F.lit("GREEN"))},
        "T406": {"employee": e.withColumn("risk_bucket", F.lit("AMBER"))},
        "T407": {"variable": v.withColumn("risk_contribution", F.lit(0.0))},
        "T408": {"variable": v.withColumn("feature", F.lit("STATUS_LEAK"))},
        "T409": {"variable": v.withColumn("feature_value", F.lit(None).cast("string"))},
        "T410": {"variable": v.filter("driver_rank > 1")},
        "T411": {"variable": v.withColumn("feature", F.lit("TOTAL_QTY"))},
        "T412": {"model_inputs": world["inputs"].filter("feature <> 'ORDERS_VALUE'")},
        "T413": {"drivers": d.filter("geo <> 'EUR'")},
        "T414": {"thresholds": cut.withColumn("fresh", F.col("geo") != "EUR")},
        "T415": {"employee": e.withColumn("top_risk_drivers", F.lit(None).cast("string"))},
        "T417": {"leftovers": world["i"].geo_config},
    }
    for test_id, change in broken.items():
        assert run_checks(world, **change)[test_id] == "FAIL", test_id


def test_feed_suite_reacts(spark, world):
    e = world["employee"]
    alerts = save_scratch(feeds.ews_feed(e, world["variable"]), "t_feed")
    summary = feeds.ews_summary(e)

    def run(feed=alerts, employee=e, summary=summary):
        return statuses(C.checks_feed(Q.MONTH, feed, employee, summary, {"T505": "167"}))

    assert "FAIL" not in run().values()
    top = F.col("top_variable_risks")
    assert run(feed=alerts.filter("risk_bucket = 'RED'"))["T501"] == "FAIL"
    assert run(feed=alerts.withColumn("risk_bucket", F.lit("GREEN")))["T502"] == "FAIL"
    assert run(feed=alerts.withColumn("top_variable_risks", F.slice(top, 1, 0)))["T503"] == "FAIL"
    assert run(feed=alerts.withColumn("top_variable_risks", F.reverse(top)))["T504"] == "FAIL"
    assert run(summary=summary.filter("geo <> 'EUR'"))["T505"] == "FAIL"
    assert run(summary=summary.withColumn("red", F.col("red") + 1))["T506"] == "FAIL"
    assert run(summary=summary.withColumn("green", F.col("green") + 1))["T507"] == "FAIL"


def test_load_suite_reacts(spark, world):
    i = world["i"]
    pinned = {**Q.load_facts(spark, SF), "T103": "4247 / 9275"}

    def run(store=i.store, config=i.feature_config, geos=i.geo_config):
        return statuses(C.checks_load(store, config, geos, Q.MONTH, pinned))

    assert set(run().values()) == {"PASS"}
    doubled = run(store=i.store.unionByName(i.store))
    assert [doubled[k] for k in ("T101", "T103", "T104", "T107", "T108")] == ["FAIL"] * 5
    shorter = run(store=i.store.filter(F.col("YEAR_MONTH") < 200001).drop("CUST_NAME").withColumn("target", F.col("target").cast("string")))
    assert [shorter[k] for k in ("T102", "T105", "T106", "T112")] == ["FAIL"] * 4
    assert run(config=i.feature_config.drop("EUR"))["T111"] == "FAIL"
    assert run(config=i.feature_config.limit(3))["T109"] == "FAIL"
    assert run(geos=i.geo_config.filter("GEO <> 'EUR'"))["T110"] == "FAIL"


def test_shared_suite_reacts(spark, world):
    i = world["i"]
    flags = feature_flags(i.feature_config, S.GEOS)
    base = dict(
        store=i.store, features=i.features(), date_columns=i.date_columns, flags=flags, selected=i.selected(),
        exclusions=i.exclusions, rules=i.rules, tables=i.geo_config.limit(3), train_end=S.TRAIN_END, eval_end=S.EVAL_END,
        telemetry_prefix="TOTAL_",
        pinned={
            "T201": "150", "T202": "125", "T203": "AFR:17, AME:17, ASI:17, EUR:22, MEA:22", "T205": "AFR:0, AME:0, ASI:0, EUR:5, MEA:5",
            "T206": "14060", "T209": "10987", "T210": "TRAIN 10641 / EVAL 1109 / TEST 2310",
            "T211": "TRAIN 7338 / EVAL 751 / TEST 1186", "T212": "5 rows, PERCENTILE, RED top 10%, AMBER next 20%",
        },
    )
    assert set(statuses(C.checks_shared(**base)).values()) == {"PASS"}
    late = i.features().filter(F.col("YEAR_MONTH") < 200001)
    broken = {
        "T201": {"flags": flags.limit(10)},
        "T202": {"flags": flags.withColumn("flag", F.lit(0).cast("long"))},
        "T203": {"selected": i.selected().filter("feature <> 'ACCT_BAL'")},
        "T204": {"exclusions": i.exclusions.withColumn("feature", F.lit("ACCT_BAL"))},
        "T205": {"selected": i.selected().filter("feature <> 'TOTAL_QTY'")},
        "T206": {"features": late},
        "T207": {"store": i.store.withColumn("LAST_SHIP_DATE", F.lit("junk"))},
        "T208": {"features": i.features().withColumn("RECENT_ORDER_DATE", F.lit("x"))},
        "T209": {"features": late},
        "T210": {"features": late},
        "T211": {"features": late},
        "T212": {"rules": i.rules.withColumn("red_top_pct", F.lit(5).cast("long"))},
        "T213": {"tables": i.geo_config.limit(2)},
    }
    for test_id, change in broken.items():
        assert statuses(C.checks_shared(**{**base, **change}))[test_id] == "FAIL", test_id


def test_backtest_suite_reacts(spark, world):
    i = world["i"]
    metrics = save_scratch(Q.metrics(spark, SF), "t_metrics")
    scores = save_scratch(Q.test_scores(spark, SF), "t_scores")
    cut = Q.eval_thresholds(spark, SF)
    rounds = spark.createDataFrame([(1,), (2,)], "iteration long")
    inputs = "scorecard_afr:4, scorecard_ame:4, scorecard_asi:4, scorecard_eur:4, scorecard_mea:4"
    base = dict(
        metrics=metrics, predictions=scores, thresholds=cut, model_inputs=world["inputs"], exclusions=i.exclusions, rounds=rounds,
        families=("scorecard", "baseline"), telemetry_prefix="TOTAL_",
        pinned={"T301": "10", "T302": "10", "T304": inputs, "T306": inputs.replace(":4", ":0"), "T307": "1772", "T310": "5"},
    )
    assert "FAIL" not in statuses(C.checks_backtest(**base)).values()
    broken = {
        "T301": {"metrics": metrics.limit(3)},
        "T302": {"metrics": metrics.withColumn("roc_auc", F.lit(1.0))},
        "T304": {"model_inputs": world["inputs"].filter("feature <> 'ORDERS_VALUE'")},
        "T305": {"exclusions": i.exclusions.withColumn("feature", F.lit("ORDERS_VALUE"))},
        "T306": {"model_inputs": world["inputs"].withColumn("feature", F.lit("TOTAL_QTY"))},
        "T307": {"predictions": scores.limit(5)},
        "T308": {"predictions": scores.withColumn("risk_score", F.lit(None).cast("double"))},
        "T309": {"predictions": scores.withColumn("risk_score", F.lit(0.5))},
        "T310": {"thresholds": cut.withColumn("red_threshold", F.lit(0.0))},
        "T311": {"thresholds": cut.withColumn("red_threshold", F.lit(0.0))},
        "T312": {"thresholds": cut.withColumn("amber_threshold", F.lit(0.0))},
        "T314": {"rounds": rounds.limit(0)},
    }
    for test_id, change in broken.items():
        assert statuses(C.checks_backtest(**{**base, **change}))[test_id] == "FAIL", test_id
