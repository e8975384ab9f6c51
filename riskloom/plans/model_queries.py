"""Registered queries on fitted models.

What a fit finds can't be told by SQL; what must hold of it can. So each query runs the models with full
settings and returns rows that say, next to what was counted, whether the models kept their promises:
scores agree with the stored pipelines, weights are at the optimum, reports with a second computation.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.ml.stat import Summarizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.drivers import number_text
from riskloom.models.families import LinearFamily, TreeFamily, additivity, balance, model_inputs
from riskloom.models.prepare import is_text, training_rows
from riskloom.operators import risk, routing
from riskloom.operators.buckets import assign_bucket
from riskloom.plans.backtest import backtest, top_weights
from riskloom.plans.monthly import monthly_run
from riskloom.plans.queries import MONTH, inputs, prepared, routed, test_rows, warehouse
from riskloom.plans.tuning import pooled_challenger, search, search_rows
from riskloom.sources import snapshots as snap
from riskloom.sources.scratch import save_scratch, scratch_dir

KEYS = ["geo", "EMP_ID", "YEAR_MONTH"]
CLOSE = 1e-9
_fitted: dict[tuple, object] = {}  # by application, data and family: queries of one session share the fits


def _models(spark) -> str:
    return f"{scratch_dir(spark)}/models-{uuid.uuid4().hex}"


def _history(spark, sf) -> DataFrame:
    return routing.backtest_rows(prepared(spark, sf), snap.TRAIN_END, snap.EVAL_END)


def _fit(spark, sf, kind):
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _fitted:
        family = kind(_models(spark))
        family.fit(_history(spark, sf), inputs(spark, sf).checked_lists())
        family.raise_errors()
        _fitted[key] = family
    return _fitted[key]


def _month(spark, sf) -> DataFrame:
    return prepared(spark, sf).filter(F.col("YEAR_MONTH") == MONTH)


def _held(spark, sf) -> DataFrame:
    return routing.calibration_rows(prepared(spark, sf), MONTH)


def _scores(family, rows: DataFrame) -> DataFrame:
    """Scores of the kernel beside those of the stored pipelines."""
    own = family.score(rows)
    other = family.pipeline_scores(rows).select(*KEYS, F.col("risk_score").alias("other"))
    valid = F.col("risk_score").between(0, 1) & (F.abs(F.col("risk_score") - F.col("other")) < CLOSE)
    return own.join(other, KEYS, "full").select(*KEYS, "target", F.coalesce(valid, F.lit(False)).alias("valid"))


def gbt_scores(spark, sf):
    return _scores(_fit(spark, sf, TreeFamily), test_rows(spark, sf))


def logreg_scores(spark, sf):
    return _scores(_fit(spark, sf, LinearFamily), test_rows(spark, sf))


def _attributions(family, rows: DataFrame) -> DataFrame:
    """Per employee: reasons in order, all raising the risk, with the values of the data."""
    found = risk.variable_risk(save_scratch(family.explain(rows), "explained"))
    features = sorted({f for fs in family.lists.values() for f in fs})
    shown = [F.col(f) if is_text(rows, f) else number_text(F.col(f).cast("double")) for f in features]
    real = routed(rows).select(*KEYS, F.map_from_arrays(F.lit(features), F.array(*shown)).alias("real"))
    met = found.join(real, KEYS)
    place = F.rank().over(Window.partitionBy(*KEYS).orderBy(F.desc("risk_contribution")))  # ten rows at most
    same = F.element_at("real", F.col("feature")).eqNullSafe(F.col("feature_value"))
    met = met.select(*KEYS, (place == F.col("driver_rank")).alias("o"), (F.col("risk_contribution") > 0).alias("p"), same.alias("r"))
    each = met.groupBy(*KEYS).agg(F.bool_and("o").alias("ordered"), F.bool_and("p").alias("raising"), F.bool_and("r").alias("real_values"))
    flags = [F.coalesce(c, F.lit(True)).alias(c) for c in ("ordered", "raising", "real_values")]
    return routed(rows).select(*KEYS).join(each, KEYS, "left").select(*KEYS, *flags)


def gbt_attributions(spark, sf):
    return _attributions(_fit(spark, sf, TreeFamily), _month(spark, sf))


def logreg_attributions(spark, sf):
    return _attributions(_fit(spark, sf, LinearFamily), _month(spark, sf))


def gbt_geo_drivers(spark, sf):
    """Overall drivers, summed in the tasks, against the mean over all explained rows."""
    family, held = _fit(spark, sf, TreeFamily), _held(spark, sf)
    mean = risk.geo_drivers(family.explain(held, None)).withColumnRenamed("attribution", "mean")
    same = F.coalesce((F.col("attribution") >= 0) & (F.abs(F.col("attribution") - F.col("mean")) < CLOSE), F.lit(False))
    return family.drivers(held).join(mean, ["geo", "feature"], "full").select("geo", "feature", same.alias("agrees"))


def all_rounds(path: str) -> TreeFamily:
    """Trees that aren't stopped early."""
    return TreeFamily(path, rounds=40, early_stop=False)


def training_curve(spark, sf):
    """Losses of all rounds: complete, falling, and at the end those of the model's own scores."""
    family, history = _fit(spark, sf, all_rounds), _history(spark, sf)
    curve = save_scratch(family.training_curve(history), "curve")
    per_geo = curve.groupBy("geo").agg(
        ((F.min("iteration") == 1) & (F.max("iteration") == family.rounds) & (F.count(F.lit(1)) == family.rounds)).alias("complete"),
        (F.max_by("train_loss", "iteration") < F.min_by("train_loss", "iteration")).alias("falls"),
        F.max_by("train_loss", "iteration").alias("last"),
    )
    p = F.col("risk_score")
    loss = F.avg(-F.when(F.col("target") == 1, F.log(p)).otherwise(F.log(1 - p))).alias("loss")
    own = family.score(history.filter(~F.col("is_eval"))).groupBy("geo").agg(loss, F.count(F.lit(1)).alias("n_train"))
    return per_geo.join(own, "geo").select("geo", "n_train", "complete", "falls", (F.abs(F.col("last") - F.col("loss")) < 1e-8).alias("agrees"))


def _gradients(spark, sf) -> DataFrame:
    """Standardised gradient of the penalised loss at every fitted weight; zero at the optimum."""
    family, parts = _fit(spark, sf, LinearFamily), []
    for geo in sorted(family.models):
        model = family.models[geo].stages[-1]
        train = training_rows(_history(spark, sf), geo, family.lists[geo], family.facts[geo]).filter(~F.col("is_eval"))
        seen = family.models[geo].transform(train)
        spread = seen.select(Summarizer.metrics("std").summary(F.col("features"), F.col("class_weight")).alias("m")).first()["m"]["std"]
        scale = F.lit([float(x) for x in spread])
        weight = F.lit([float(c) for c in model.coefficients])
        gap = F.col("class_weight") * (vector_to_array("probability")[1] - F.col("target"))
        rows = seen.select(gap.alias("gap"), "class_weight", F.posexplode(vector_to_array("features")).alias("slot", "x"))
        sums = rows.groupBy("slot").agg((F.sum(F.col("gap") * F.col("x")) / F.sum("class_weight")).alias("slope"))
        sigma = F.get(scale, F.col("slot"))
        full = F.col("slope") + model.getRegParam() * F.get(weight, F.col("slot")) * sigma * sigma
        standard = F.when(sigma > 0, full / sigma).otherwise(F.lit(0.0))
        parts.append(sums.select(F.lit(geo).alias("geo"), F.get(F.lit(family.slots[geo]), F.col("slot")).alias("feature"), standard.alias("gradient")))
    return reduce(DataFrame.unionByName, parts)


def linear_weights(spark, sf):
    """Every input's weights are where the gradient of the penalised loss vanishes."""
    return _gradients(spark, sf).groupBy("geo", "feature").agg(F.bool_and(F.abs("gradient") < 1e-3).alias("at_optimum"))


def explain_weights(spark, sf):
    """The fifteen heaviest weights of a geo: in order, and none that is left out is heavier."""
    weights = _fit(spark, sf, LinearFamily).weights(spark)
    top = top_weights(weights).groupBy("geo").agg(F.count(F.lit(1)).alias("n_shown"), F.min(F.abs("weight")).alias("least"))
    met = weights.join(top, "geo").groupBy("geo", "n_shown").agg(F.count_if(F.abs(F.round("weight", 4)) > F.col("least")).alias("above"))
    return met.select("geo", "n_shown", (F.col("above") < F.col("n_shown")).alias("heaviest"))


def gbt_additivity(spark, sf):
    """Contributions of every TEST row against its score."""
    family = _fit(spark, sf, TreeFamily)
    return additivity(family.explain(test_rows(spark, sf), None), family.bases(spark))


def logreg_additivity(spark, sf):
    family = _fit(spark, sf, LinearFamily)
    return additivity(family.explain(test_rows(spark, sf), None), family.bases(spark))


def logreg_balance(spark, sf):
    """Residuals of the fitted benchmark on its own training rows."""
    family = _fit(spark, sf, LinearFamily)
    train = prepared(spark, sf).filter(F.col("target").isNotNull() & (F.col("YEAR_MONTH") <= snap.TRAIN_END))
    return balance(family.score(train), family.facts)


def gbt_inputs(spark, sf):
    """Inputs of the fitted models with the training rows behind them."""
    family = _fit(spark, sf, TreeFamily)
    used = routing.backtest_rows(routed(snap.feature_store(spark, sf)), snap.TRAIN_END, snap.EVAL_END)
    rows = used.groupBy("geo").agg(F.count_if(~F.col("is_eval")).alias("n_train"), F.count_if("is_eval").alias("n_eval"))
    inputs_ = model_inputs(spark, family).withColumn("geo", F.upper(F.substring_index("model", "_", -1)))
    return inputs_.join(rows, "geo")


def odd_inputs(spark, sf):
    """Rows with NaN, empty and unseen inputs: every family gives them the same score, explained or not."""
    odd = F.pmod(F.xxhash64("EMP_ID"), F.lit(4))
    nan, none = F.lit(float("nan")), F.lit(None)
    rows = test_rows(spark, sf).withColumns(
        {
            "ORDERS_VALUE": F.when(odd == 0, nan).when(odd == 1, none).otherwise(F.col("ORDERS_VALUE")),
            "LAST_SHIP_DATE": F.when(odd == 2, none).otherwise(F.col("LAST_SHIP_DATE")),
            "MKT_SEGMENT": F.when(odd == 0, "unheard of").when(odd == 1, none).otherwise(F.col("MKT_SEGMENT")),
        }
    )
    parts = []
    for kind in (TreeFamily, LinearFamily):
        family = _fit(spark, sf, kind)
        told = family.explain(rows).select(*KEYS, F.col("risk_score").alias("told"))
        met = family.score(rows).join(told, KEYS, "full").join(family.pipeline_scores(rows).select(*KEYS, F.col("risk_score").alias("other")), KEYS, "full")
        apart = [F.coalesce(F.abs(F.col("risk_score") - F.col(c)) >= CLOSE, F.lit(True)) for c in ("told", "other")]
        found = met.groupBy("geo").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(apart[0] | apart[1] | F.isnan("told")).alias("n_apart"))
        parts.append(found.select(F.lit(family.prefix).alias("model_family"), "*"))
    return parts[0].unionByName(parts[1])


def _plain_metrics(predictions: DataFrame) -> DataFrame:
    """AUC from mean ranks, F1 and log loss row by row: a second way to the report."""
    whole = Window.partitionBy("geo", "model_family")
    rank = F.rank().over(whole.orderBy("risk_score")) + (F.count(F.lit(1)).over(whole.partitionBy("geo", "model_family", "risk_score")) - 1) / 2
    y, p, hit = F.col("target"), F.col("risk_score"), F.col("risk_score") >= 0.5
    rows = predictions.withColumn("rank", rank)
    n, pos = F.count(F.lit(1)), F.sum(y)
    tp = F.count_if(hit & (y == 1))
    return rows.groupBy("geo", "model_family").agg(
        n.alias("n_rows"),
        ((F.sum(F.when(y == 1, F.col("rank"))) - pos * (pos + 1) / 2) / (pos * (n - pos))).alias("auc"),
        (2 * tp / (F.count_if(hit) + pos)).alias("f1"),
        F.avg(-F.when(y == 1, F.log(p)).otherwise(F.log(1 - p))).alias("loss"),
    )


def model_backtest(spark, sf):
    """The report of both families against a second computation from the written scores."""
    path = _models(spark)
    result = backtest(inputs(spark, sf), [TreeFamily(path), LinearFamily(path)], snap.TRAIN_END, snap.EVAL_END)
    met = result.metrics.join(_plain_metrics(result.predictions), ["geo", "model_family"], "full")
    close = lambda a, b: F.abs(F.col(a) - F.col(b)) < 1e-6
    agrees = close("roc_auc", "auc") & close("f1_score", "f1") & close("log_loss", "loss")
    return met.select("geo", "model_family", "n_rows", F.coalesce(agrees, F.lit(False)).alias("agrees"))


def model_capture(spark, sf):
    """Employees and events of all buckets of a geo, and whether hit rates and shares follow from the written scores."""
    result = backtest(inputs(spark, sf), [TreeFamily(_models(spark))], snap.TRAIN_END, snap.EVAL_END)
    named = assign_bucket(result.of_primary(), result.thresholds)
    bucket = F.concat(F.when(F.col("risk_bucket") == "RED", "1-").when(F.col("risk_bucket") == "AMBER", "2-").otherwise("3-"), F.col("risk_bucket"))
    again = named.groupBy("geo", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.sum("target").alias("events"), F.round(F.avg("target"), 3).alias("rate"))
    met = result.capture().join(again, ["geo", "bucket"], "full")
    same = F.coalesce((F.col("employees") == F.col("n")) & (F.col("actual_events") == F.col("events")) & (F.col("hit_rate") == F.col("rate")), F.lit(False))
    return met.groupBy("geo").agg(
        F.sum("employees").alias("employees"),
        F.sum("actual_events").alias("actual_events"),
        (F.bool_and(same) & (F.abs(F.sum("share_of_all_events") - 1) < 0.002)).alias("agrees"),
    )


def model_monthly_run(spark, sf):
    """Checks of a production run, all but those of shares, hit rates and ties at the cut-offs, which depend on the fit."""
    place = warehouse(spark, "model-run")
    run = monthly_run(inputs(spark, sf), MONTH, TreeFamily(_models(spark)), place, plain_geo="AFR")
    return run.checks.filter(~F.col("test_id").isin("T405", "T406", "T409", "T410", "T414", "T416"))


def pooled_model(spark, sf):
    """Metrics of the pooled challenger, all within their bounds."""
    found = pooled_challenger(inputs(spark, sf), _models(spark), snap.TRAIN_END, snap.EVAL_END)
    bounds = [F.col(c).between(0, 1) for c in ("recall", "accuracy", "roc_auc")] + [F.col("log_loss") > 0]
    return found.select("geo", "model_family", F.coalesce(reduce(lambda a, b: a & b, bounds), F.lit(False)).alias("valid"))


def hyper_search(spark, sf):
    """Rounds, depth and step; metrics of fewer rounds, read from the same trees, against a fit of so many rounds."""
    grid = [{"depth": depth, "step": step} for depth in (3, 5) for step in (0.05, 0.1)]
    given = inputs(spark, sf)
    rows = search_rows(given, snap.TRAIN_END, snap.EVAL_END)
    try:
        found = search(given, _models(spark), grid, [5, 10, 20], snap.TRAIN_END, snap.EVAL_END, rows)
        again = search(given, _models(spark), grid[:1], [5], snap.TRAIN_END, snap.EVAL_END, rows)
    finally:
        rows.close()
    met = found.join(again.select("geo", "params", F.col("log_loss").alias("loss"), F.col("roc_auc").alias("auc")), ["geo", "params"], "left")
    same = (F.abs(F.col("log_loss") - F.col("loss")) < CLOSE) & F.coalesce(F.abs(F.col("roc_auc") - F.col("auc")) < CLOSE, F.lit(True))
    valid = F.col("log_loss") > 0
    return met.select("geo", "params", F.coalesce(valid & F.when(F.col("loss").isNull(), True).otherwise(same), F.lit(False)).alias("agrees"))


MODELS = {
    f.__name__: f
    for f in (
        gbt_scores, gbt_attributions, gbt_geo_drivers, gbt_additivity, gbt_inputs, training_curve, logreg_scores, logreg_attributions,
        logreg_additivity, logreg_balance, linear_weights, explain_weights, odd_inputs, model_backtest, model_capture, model_monthly_run,
        pooled_model, hyper_search,
    )
}
