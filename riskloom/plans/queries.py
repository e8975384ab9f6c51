"""Every operator as a query over the test tables: name -> (spark, sf_dir) -> DataFrame.

Business operators run on a fixed scorecard, so that their results can be compared exactly; the
model queries run the same operators on fitted models.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.dates import shift_month
from riskloom.models.families import ScorecardFamily, model_inputs
from riskloom.operators import buckets, checks, drift, evaluate, features, feed, profiles, quality, risk, routing, sketches
from riskloom.operators.scorecard import Scorecard, Weight, score_with
from riskloom.plans import scenarios
from riskloom.plans.backtest import top_drivers, trade_off
from riskloom.plans.inputs import Inputs
from riskloom.plans.monthly import monthly_run, read_feed, read_summary
from riskloom.sources import snapshots as snap
from riskloom.sources.files import column_table
from riskloom.sources.scratch import fix_small, save_scratch, scratch_dir
from riskloom.sources.tables import create_outputs, read_feature_store, read_table, table_list, write_feature_store

MONTH = snap.SCORING_MONTH
CARD = Scorecard(
    "scorecard",
    0.2,
    (
        Weight("ORDERS_CNT_INLAST_3_MONTHS", -0.4, 0.37, 0.61),
        Weight("DAYS_AFTER_JOIN", -0.2, 1000.0, 695.0),
        Weight("ORDERS_VALUE", 0.3, 267000.0, 163000.0),
        Weight("LAST_SHIP_DATE", 0.1, -720.0, 866.0),
    ),
)
PLAIN = Scorecard(
    "baseline",
    0.5,
    (Weight("ORDERS_CNT_INLAST_3_MONTHS", -0.3, 0.37, 0.61), Weight("ORDERS_VALUE", 0.05, 267000.0, 163000.0)),
)
NUMERIC = snap.COLUMNS[7:24]


# ---- shared steps -------------------------------------------------------------------------------


def inputs(spark: SparkSession, sf: str) -> Inputs:
    geos = fix_small(snap.geo_config(spark, sf))
    return Inputs(
        snap.feature_store(spark, sf),
        snap.feature_config(spark),
        geos,
        features.feature_exclusions(spark, snap.EXCLUSIONS),
        features.bucket_config(geos),
        snap.DATE_COLUMNS,
    )


def prepared(spark: SparkSession, sf: str) -> DataFrame:
    return features.model_features(snap.feature_store(spark, sf), snap.DATE_COLUMNS)


def routed(df: DataFrame) -> DataFrame:
    return routing.route_to_geos(df, snap.GEOS)


def scored(df: DataFrame, card: Scorecard = CARD) -> DataFrame:
    return score_with(routed(df), card)


def month_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    i = inputs(spark, sf)
    return buckets.calibrate(scored(routing.calibration_rows(i.features(), MONTH)), i.rules)


def month_stage(spark: SparkSession, sf: str) -> DataFrame:
    return scored(prepared(spark, sf).filter(F.col("YEAR_MONTH") == MONTH))


def month_risk(spark: SparkSession, sf: str) -> DataFrame:
    return risk.employee_risk(month_stage(spark, sf), month_thresholds(spark, sf))


def eval_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    i = inputs(spark, sf)
    held = routing.backtest_rows(i.features(), snap.TRAIN_END, snap.EVAL_END).filter("is_eval")
    return buckets.calibrate(scored(held), i.rules)


def test_rows(spark: SparkSession, sf: str) -> DataFrame:
    return prepared(spark, sf).filter(F.col("target").isNotNull() & (F.col("YEAR_MONTH") > snap.EVAL_END))


def test_scores(spark: SparkSession, sf: str) -> DataFrame:
    return scored(test_rows(spark, sf))


def both_families(spark: SparkSession, sf: str) -> DataFrame:
    rows = test_rows(spark, sf)
    keep = ["geo", "EMP_ID", "YEAR_MONTH", "target", "risk_score"]
    first = scored(rows).select(*keep, F.lit("scorecard").alias("model_family"))
    return first.unionByName(scored(rows, PLAIN).select(*keep, F.lit("baseline").alias("model_family")))


def metrics(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.evaluate(both_families(spark, sf))


def rounded(df: DataFrame, *names: str, digits: int = 4) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def warehouse(spark: SparkSession, name: str) -> str:
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    create_outputs(spark, path)
    return path


# ---- features and configuration -----------------------------------------------------------------


def feature_store(spark, sf):
    return snap.customer_months(spark, sf)


def q_model_features(spark, sf):
    return prepared(spark, sf)


def feature_flags_long(spark, sf):
    i = inputs(spark, sf)
    flags = features.feature_flags(i.feature_config, features.geo_names(i.geo_config))
    return quality.feature_fill(i.store, flags, snap.COLUMNS).select("feature", "geo", "flag", "n_rows", "n_filled")


def geo_feature_list(spark, sf):
    i = inputs(spark, sf)
    per_geo = routed(i.features()).groupBy("geo").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("target").alias("n_labelled")
    )
    return features.geo_feature_list(i.selected()).join(per_geo, "geo")


def geo_fanout(spark, sf):
    """Customers of three nations lose their geo, so both ways of routing are met."""
    homeless = F.col("NATION_NAME").isin("NATION_0", "NATION_7", "NATION_13")
    rows = snap.feature_store(spark, sf).withColumn("GEO", F.when(~homeless, F.col("GEO")))
    return routed(rows).groupBy("geo").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("target") == 1).alias("n_positive")
    )


def split_sizes(spark, sf):
    return routing.split_sizes(routed(snap.feature_store(spark, sf)), snap.TRAIN_END, snap.EVAL_END)


def rolling_split(spark, sf):
    rows = routing.history_rows(routed(snap.feature_store(spark, sf)), MONTH)
    return rows.groupBy("geo", "is_eval").agg(
        F.min("YEAR_MONTH").alias("first_month"), F.max("YEAR_MONTH").alias("last_month"), F.count(F.lit(1)).alias("n_rows")
    )


def class_weights(spark, sf):
    rows = routing.backtest_rows(routed(snap.feature_store(spark, sf)), snap.TRAIN_END, snap.EVAL_END)
    return rounded(routing.class_weights(rows.filter(~F.col("is_eval"))), "weight", digits=6)


def month_shift(spark, sf):
    store = snap.feature_store(spark, sf)
    moved = store.groupBy("YEAR_MONTH").agg(F.count(F.lit(1)).alias("n_rows"))
    return moved.select("YEAR_MONTH", shift_month(F.col("YEAR_MONTH"), -3).alias("eval_from"), "n_rows")


def label_maturity(spark, sf):
    rows = routed(snap.feature_store(spark, sf))
    mature = routing.matured_rows(rows, MONTH, snap.HORIZON_MONTHS)
    return mature.groupBy("geo").agg(F.count(F.lit(1)).alias("n_rows"), F.max("YEAR_MONTH").alias("last_month"))


# ---- scores, cut-offs, published tables ---------------------------------------------------------


def scorecard_scores(spark, sf):
    s = scored(prepared(spark, sf))
    return s.select("geo", "EMP_ID", "YEAR_MONTH", "target", F.round("risk_score", 6).alias("risk_score"), "model_name")


def bucket_thresholds(spark, sf):
    return rounded(month_thresholds(spark, sf), "red_threshold", "amber_threshold", digits=6)


def fixed_thresholds(spark, sf):
    """One geo keeps hand-made cut-offs while the others are calibrated."""
    i = inputs(spark, sf)
    change = i.geo_config.filter(F.col("GEO") == "EUR").select(
        F.col("GEO").alias("geo"), F.lit("FIXED").alias("method"), F.lit(0.6).alias("red_threshold"), F.lit(0.55).alias("amber_threshold")
    )
    rules = features.update_by_key(i.rules, change, "geo")
    cut = buckets.calibrate(scored(routing.calibration_rows(i.features(), MONTH)), rules)
    named = buckets.assign_bucket(month_stage(spark, sf), cut)
    return named.groupBy("geo", "risk_bucket").agg(F.count(F.lit(1)).alias("employees"))


def employee_risk(spark, sf):
    return rounded(month_risk(spark, sf), "risk_score", digits=6)


def variable_risk(spark, sf):
    return rounded(risk.variable_risk(month_stage(spark, sf)), "risk_contribution", digits=6)


def variable_risk_history(spark, sf):
    every = risk.variable_risk(scored(prepared(spark, sf)))
    return every.groupBy("geo", "feature", "driver_rank").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("risk_contribution"), 6).alias("mean_contribution")
    )


def geo_drivers(spark, sf):
    held = routing.calibration_rows(prepared(spark, sf), MONTH)
    return rounded(risk.geo_drivers(score_with(routed(held), CARD, None)), "attribution", digits=6)


def ews_feed(spark, sf):
    s = month_stage(spark, sf)
    return feed.ews_feed(risk.employee_risk(s, month_thresholds(spark, sf)), risk.variable_risk(s))


def ews_feed_flat(spark, sf):
    return ews_feed(spark, sf).select(
        "geo", "EMP_ID", "YEAR_MONTH", "risk_score", "risk_bucket", "risk_rank_in_geo", "model_name", F.inline_outer("top_variable_risks")
    )


def ews_summary(spark, sf):
    return feed.ews_summary(month_risk(spark, sf))


def action_list(spark, sf):
    return feed.action_list(ews_feed(spark, sf), 20)


def explain_drivers(spark, sf):
    held = routing.calibration_rows(prepared(spark, sf), MONTH)
    return top_drivers(risk.geo_drivers(score_with(routed(held), CARD, None)))


# ---- backtest -----------------------------------------------------------------------------------


def test_predictions(spark, sf):
    return rounded(test_scores(spark, sf).drop("attributions", "model_name"), "risk_score", digits=6)


def capture_report(spark, sf):
    return buckets.capture_report(test_scores(spark, sf), eval_thresholds(spark, sf))


def lift(spark, sf):
    report = buckets.lift_report(test_scores(spark, sf), eval_thresholds(spark, sf))
    return rounded(report, "base_rate", "red_hit_rate", "flagged_share", "captured_share", "lift")


def eval_metrics(spark, sf):
    return rounded(
        metrics(spark, sf), "precision", "recall", "accuracy", "f1_score", "log_loss", "roc_auc", digits=5
    )


def eval_report(spark, sf):
    return evaluate.eval_report(metrics(spark, sf))


def roc_curve(spark, sf):
    curve = evaluate.roc_curve(test_scores(spark, sf))
    return rounded(curve, "threshold", "recall", "precision", "false_positive_rate", digits=6)


def threshold_trade_off(spark, sf):
    return trade_off(evaluate.roc_curve(test_scores(spark, sf)))


def target_cutoffs(spark, sf):
    cut = buckets.target_cutoffs(test_scores(spark, sf), 0.75, 0.8)
    return rounded(cut, "precision_cutoff", "recall_cutoff", digits=6)


def champion_choice(spark, sf):
    return rounded(evaluate.choose_champion(metrics(spark, sf), "baseline"), "roc_auc", digits=5)


def parity_report(spark, sf):
    m = fix_small(metrics(spark, sf))  # geos x families
    pair = evaluate.parity(
        m.filter(F.col("model_family") == "baseline"), m.filter(F.col("model_family") == "scorecard"), 0.02
    )
    return rounded(pair, "old_auc", "new_auc", "difference", digits=5)


# ---- quality, drift, governance -----------------------------------------------------------------


def duplicate_keys(spark, sf):
    return quality.duplicate_keys(snap.order_months(spark, sf))


def key_quarantine(spark, sf):
    clean, bad = quality.quarantine(snap.order_months(spark, sf))
    sums = [F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("value")]
    return (
        clean.groupBy(F.lit("unique").alias("part")).agg(*sums).unionByName(bad.groupBy(F.lit("quarantine").alias("part")).agg(*sums))
    )


def config_mismatch(spark, sf):
    """Configured features without data and geos without flags, with the rows they concern."""
    i = inputs(spark, sf)
    gone = {"TOTAL_QTY": "TOTAL_QUANTITY"}
    config = features.drop_geo_column(
        i.feature_config.replace(gone, subset=["MODEL_FEATURES"]), "ASI"
    )
    present = column_table(i.store, "feature_store").select(F.col("column_name").alias("name"))
    no_data = config.select(F.col("MODEL_FEATURES").alias("name")).join(present, "name", "left_anti")
    flagged = column_table(config, "feature_config").select(F.col("column_name").alias("name"))
    per_geo = i.store.groupBy(F.col("GEO").alias("name")).agg(F.count(F.lit(1)).alias("n_rows"))
    no_flags = per_geo.join(flagged, "name", "left_anti")
    return no_data.select(F.lit("feature without data").alias("problem"), "name", F.lit(0).cast("long").alias("n_rows")).unionByName(
        no_flags.select(F.lit("geo without flags").alias("problem"), "name", "n_rows")
    )


def quality_gate(spark, sf):
    return quality.quality_gate(snap.feature_store(spark, sf), ["target", "EMP_ID", "GEO", "TOTAL_LINES", "LAST_SHIP_DATE"], 200108)


def leakage_scan(spark, sf):
    return quality.leakage_scan(snap.feature_store(spark, sf), snap.DATE_COLUMNS)


def column_profile(spark, sf):
    return quality.column_profile(snap.feature_store(spark, sf))


def column_profile_by_month(spark, sf):
    """The same profile from months that were profiled as they came: history first, then a month at a time."""
    path = f"{scratch_dir(spark)}/profiles-{uuid.uuid4().hex}"
    raw = snap.feature_store(spark, sf)
    write_feature_store(raw, f"{path}-store")
    store = read_feature_store(spark, f"{path}-store", raw.schema)
    profiles.store_profiles(store.filter(F.col("YEAR_MONTH") < MONTH), path)
    for row in store.filter(F.col("YEAR_MONTH") >= MONTH).select("YEAR_MONTH").distinct().orderBy("YEAR_MONTH").collect():
        profiles.store_profiles(store.filter(F.col("YEAR_MONTH") == row.YEAR_MONTH), path)
    return profiles.merged_profile(profiles.read_profiles(spark, path), store)


def drift_sketches(spark, sf):
    """Drift of the scoring month against two earlier ones, from sketches that were stored month by month."""
    path = f"{scratch_dir(spark)}/sketches-{uuid.uuid4().hex}"
    for month in (200003, 200004, MONTH):
        sketches.store_sketches(prepared(spark, sf).filter(F.col("YEAR_MONTH") == month), NUMERIC, path)
    return rounded(sketches.quantile_drift(sketches.read_sketches(spark, path), [200003, 200004], [MONTH]), "psi")


def learnt_families(spark, sf):
    """Customer names, nearly as many as customers, as families that hold enough rows."""
    store = snap.feature_store(spark, sf)
    found = quality.learn_families(store, "CUST_NAME", 300)
    return found.groupBy("family").agg(F.count(F.lit(1)).alias("codes"), F.sum("n_rows").alias("n_rows"))


def feature_list_changes(spark, sf):
    """Feature lists before and after a flag is switched off in one geo and a geo is added."""
    i = inputs(spark, sf)
    config = features.add_geo_column(features.set_flag(i.feature_config, "TOTAL_QTY", "EUR", 0), "IND", "MEA")
    names = [*features.geo_names(i.geo_config), "IND"]
    after = features.selected_features(features.feature_flags(config, names), i.features(), i.exclusions)
    return features.list_changes(i.selected(), after)


def target_correlation(spark, sf):
    return rounded(quality.target_correlation(prepared(spark, sf), NUMERIC + snap.DATE_COLUMNS), "correlation")


def code_families(spark, sf):
    """Nations grouped into their regions, as an example of code families; one region is unknown."""
    regions = snap.read(spark, sf, "region").filter(F.col("r_name") != "ASIA")
    families = snap.read(spark, sf, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("code"), F.col("r_name").alias("family")
    )
    mapped = quality.map_codes(snap.feature_store(spark, sf), "NATION_NAME", families)
    return mapped.groupBy("NATION_NAME").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("target"), 4).alias("event_rate"))


def drift_psi(spark, sf):
    return rounded(drift.feature_drift(prepared(spark, sf), NUMERIC, 200004, MONTH), "psi")


def two_months(spark, sf):
    """Bucketed scores of the scoring month and the one before it, under the same cut-offs."""
    rows = scored(prepared(spark, sf).filter(F.col("YEAR_MONTH").isin(200103, MONTH))).drop("attributions")
    return buckets.assign_bucket(rows, month_thresholds(spark, sf))


def score_drift(spark, sf):
    return rounded(drift.score_drift(two_months(spark, sf), 200103, MONTH), "score_change", "red_share_change", "amber_share_change")


def bucket_stability(spark, sf):
    return drift.bucket_moves(two_months(spark, sf), 200103, MONTH)


def driver_drift(spark, sf):
    rows = score_with(routed(prepared(spark, sf).filter(F.col("YEAR_MONTH").isin(200103, MONTH))), CARD, None)
    per_month = rows.select("geo", "YEAR_MONTH", F.inline("attributions")).groupBy("geo", "YEAR_MONTH", "feature").agg(
        F.avg(F.abs("contribution")).alias("attribution")
    )
    return rounded(drift.driver_drift(per_month, 200103, MONTH), "share_change")


def fairness_rates(spark, sf):
    rows = score_with(routed(test_rows(spark, sf)), CARD, carry=("MKT_SEGMENT",)).drop("attributions")
    rates = quality.fairness_rates(buckets.assign_bucket(rows, eval_thresholds(spark, sf)), "MKT_SEGMENT")
    return rounded(rates, "red_share", "flagged_share", "event_rate", "flagged_hit_rate", "false_alarm_rate", "red_share_gap")


def published_feed(spark, sf):
    """Two geos are released for the month."""
    flags = snap.geo_config(spark, sf).select(
        F.col("GEO").alias("geo"), F.lit(MONTH).cast("long").alias("YEAR_MONTH"), F.col("GEO").isin("AFR", "MEA").alias("published")
    )
    out = feed.published_feed(ews_feed(spark, sf), flags)
    return out.select("geo", "EMP_ID", "YEAR_MONTH", "risk_score", "risk_bucket")


# ---- checks and scenarios -----------------------------------------------------------------------


def load_facts(spark, sf) -> dict[str, str]:
    """Expected values of the load checks, counted on the raw orders instead of the snapshots."""
    months = snap.order_months(spark, sf).select("EMP_ID", "YEAR_MONTH").distinct()
    r = months.agg(
        F.count(F.lit(1)).cast("string").alias("T101"),
        F.count_if(F.col("YEAR_MONTH") > MONTH).cast("string").alias("T104"),
        F.concat(
            F.min("YEAR_MONTH").cast("string"), F.lit(" - "), F.max("YEAR_MONTH").cast("string"), F.lit(" ("),
            F.countDistinct("YEAR_MONTH").cast("string"), F.lit(")"),
        ).alias("T105"),
        F.count_if(F.col("YEAR_MONTH") == MONTH).cast("string").alias("T108"),
    ).first()
    return {**r.asDict(), "T102": "30", "T109": "30", "T110": "5: AFR,AME,ASI,EUR,MEA"}


def checks_load(spark, sf):
    i = inputs(spark, sf)
    return checks.checks_load(i.store, i.feature_config, i.geo_config, MONTH, load_facts(spark, sf))


def checks_shared(spark, sf):
    i = inputs(spark, sf)
    names = features.geo_names(i.geo_config)
    outputs = table_list(spark, warehouse(spark, "outputs"), ["ews_employee_risk", "ews_variable_risk", "ews_geo_drivers"])
    pinned = {
        "T201": "150",
        "T202": "125",
        "T203": "AFR:17, AME:17, ASI:17, EUR:22, MEA:22",
        "T205": "AFR:0, AME:0, ASI:0, EUR:5, MEA:5",
        "T206": load_facts(spark, sf)["T101"],
        "T212": "5 rows, PERCENTILE, RED top 10%, AMBER next 20%",
    }
    return checks.checks_shared(
        i.store, i.features(), i.date_columns, features.feature_flags(i.feature_config, names), i.selected(), i.exclusions,
        i.rules, outputs, snap.TRAIN_END, snap.EVAL_END, "TOTAL_", pinned,
    )


def checks_backtest(spark, sf):
    i = inputs(spark, sf)
    family = ScorecardFamily(CARD)
    family.fit(i.store, i.checked_lists())
    pinned = {"T301": "10", "T302": "10", "T310": "5", "T304": ", ".join(f"scorecard_{g.lower()}:4" for g in snap.GEOS)}
    return checks.checks_backtest(
        metrics(spark, sf), test_scores(spark, sf), eval_thresholds(spark, sf), model_inputs(spark, family), i.exclusions,
        None, ("scorecard", "baseline"), "TOTAL_", pinned,
    )


def checks_run(spark, sf):
    i = inputs(spark, sf)
    family = ScorecardFamily(CARD)
    family.fit(i.store, i.checked_lists())
    held = score_with(routed(routing.calibration_rows(i.features(), MONTH)), CARD, None)
    drivers = risk.geo_drivers(held).withColumn("YEAR_MONTH", F.lit(MONTH).cast("long"))
    stage = month_stage(spark, sf)
    cut = month_thresholds(spark, sf)
    nothing = i.geo_config.filter(F.lit(False))
    pinned = {"T401": load_facts(spark, sf)["T108"], "T413": "5", "T414": "5",
              "T412": ", ".join(f"scorecard_{g.lower()}:4" for g in snap.GEOS)}
    return checks.checks_run(
        MONTH, risk.employee_risk(stage, cut), risk.variable_risk(stage), drivers, cut.withColumn("fresh", F.col("n_scores") > 0),
        i.selected(), i.store, model_inputs(spark, family), "AFR", "TOTAL_", nothing, pinned,
    )


def checks_feed(spark, sf):
    stage = month_stage(spark, sf)
    employee = save_scratch(risk.employee_risk(stage, month_thresholds(spark, sf)), "employee")
    alerts = feed.ews_feed(employee, risk.variable_risk(stage))
    return checks.checks_feed(MONTH, alerts, employee, feed.ews_summary(employee), {"T505": load_facts(spark, sf)["T108"]})


def scenario_flag_off(spark, sf):
    return scenarios.flag_off(inputs(spark, sf), "TOTAL_QTY", "EUR", "AFR")


def scenario_new_geo(spark, sf):
    return scenarios.new_geo(inputs(spark, sf), "IND", "AFR")


def scenario_rerun(spark, sf):
    return scenarios.rerun(inputs(spark, sf), MONTH, ScorecardFamily(CARD), warehouse(spark, "rerun"))


def scenario_config_error(spark, sf):
    """The month has been published before; the broken run must leave it as it is."""
    place = warehouse(spark, "guard")
    monthly_run(inputs(spark, sf), MONTH, ScorecardFamily(CARD), place)
    return scenarios.config_error(inputs(spark, sf), "ZZZ", MONTH, ScorecardFamily(CARD), place)


def monthly_outputs(spark, sf):
    """Two months through the whole run, read back from the output tables."""
    place = warehouse(spark, "monthly")
    for month in (200103, MONTH):
        monthly_run(inputs(spark, sf), month, ScorecardFamily(CARD), place)
    out = read_table(spark, place, "ews_employee_risk")
    return out.select("geo", "EMP_ID", "YEAR_MONTH", F.round("risk_score", 6).alias("risk_score"), "risk_bucket", "risk_rank_in_geo")


def monthly_feed(spark, sf):
    """Feed and summary of a whole run, joined to one row per geo."""
    place = warehouse(spark, "feed")
    monthly_run(inputs(spark, sf), MONTH, ScorecardFamily(CARD), place)
    alerts = read_feed(spark, place, MONTH).groupBy("geo").agg(F.count(F.lit(1)).alias("feed_rows"))
    return read_summary(spark, place, MONTH).join(alerts, "geo", "left")


class Spoilt(ScorecardFamily):
    """A scorecard whose scores leave 0..1 in one geo."""

    def __init__(self, card: Scorecard, geo: str):
        super().__init__(card)
        self.geo = geo

    def explain(self, rows, top_k=10):
        off = F.when(F.col("geo") == self.geo, F.lit(2.0)).otherwise(F.lit(1.0))
        return super().explain(rows, top_k).withColumn("risk_score", F.col("risk_score") * off)


def release_per_geo(spark, sf):
    """A second run whose scores are spoilt in one geo: that geo is read as before, the others anew."""
    place = warehouse(spark, "release")
    first = monthly_run(inputs(spark, sf), MONTH, ScorecardFamily(CARD), place)
    second = monthly_run(inputs(spark, sf), MONTH, Spoilt(CARD, "EUR"), place)
    states = read_table(spark, place, "run_log").filter(F.col("run_id") == second.run_id).select("geo", "status")
    read = read_table(spark, place, "ews_employee_risk").groupBy("geo").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("scored_at") == F.lit(first.started_at)).alias("n_earlier"),
        F.round(F.avg("risk_score"), 6).alias("mean_score"),
    )
    return states.join(read, "geo", "left")


def run_verdicts(spark, sf):
    """What the checks of a run say of each geo, from metrics observed while its outputs were written."""
    run = monthly_run(inputs(spark, sf), MONTH, ScorecardFamily(CARD), warehouse(spark, "verdicts"), plain_geo="AFR")
    return run.verdicts.filter(~F.col("test_id").isin("T405", "T406", "T410"))


def run_log(spark, sf):
    place = warehouse(spark, "log")
    monthly_run(inputs(spark, sf), MONTH, ScorecardFamily(CARD), place)
    return read_table(spark, place, "run_log").select("geo", "YEAR_MONTH", "status", "n_scored")


EXACT = {
    "feature_store": feature_store,
    "model_features": q_model_features,
    "feature_flags_long": feature_flags_long,
    "geo_feature_list": geo_feature_list,
    "geo_fanout": geo_fanout,
    "split_sizes": split_sizes,
    "rolling_split": rolling_split,
    "month_shift": month_shift,
    "class_weights": class_weights,
    "label_maturity": label_maturity,
    "scorecard_scores": scorecard_scores,
    "bucket_thresholds": bucket_thresholds,
    "fixed_thresholds": fixed_thresholds,
    "employee_risk": employee_risk,
    "variable_risk": variable_risk,
    "variable_risk_history": variable_risk_history,
    "geo_drivers": geo_drivers,
    "explain_drivers": explain_drivers,
    "ews_feed_flat": ews_feed_flat,
    "ews_summary": ews_summary,
    "action_list": action_list,
    "test_predictions": test_predictions,
    "capture_report": capture_report,
    "lift": lift,
    "eval_metrics": eval_metrics,
    "eval_report": eval_report,
    "roc_curve": roc_curve,
    "threshold_trade_off": threshold_trade_off,
    "target_cutoffs": target_cutoffs,
    "champion_choice": champion_choice,
    "parity_report": parity_report,
    "duplicate_keys": duplicate_keys,
    "key_quarantine": key_quarantine,
    "config_mismatch": config_mismatch,
    "quality_gate": quality_gate,
    "leakage_scan": leakage_scan,
    "column_profile": column_profile,
    "column_profile_by_month": column_profile_by_month,
    "target_correlation": target_correlation,
    "code_families": code_families,
    "drift_psi": drift_psi,
    "drift_sketches": drift_sketches,
    "learnt_families": learnt_families,
    "feature_list_changes": feature_list_changes,
    "score_drift": score_drift,
    "bucket_stability": bucket_stability,
    "driver_drift": driver_drift,
    "fairness_rates": fairness_rates,
    "published_feed": published_feed,
    "checks_load": checks_load,
    "checks_shared": checks_shared,
    "checks_backtest": checks_backtest,
    "checks_run": checks_run,
    "checks_feed": checks_feed,
    "scenario_flag_off": scenario_flag_off,
    "scenario_new_geo": scenario_new_geo,
    "scenario_rerun": scenario_rerun,
    "scenario_config_error": scenario_config_error,
    "monthly_outputs": monthly_outputs,
    "monthly_feed": monthly_feed,
    "run_log": run_log,
    "release_per_geo": release_per_geo,
    "run_verdicts": run_verdicts,
}
