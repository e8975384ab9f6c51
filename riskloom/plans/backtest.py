"""One-time validation: fit on TRAIN, calibrate on EVAL, report on TEST."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.buckets import calibrate, capture_report
from riskloom.operators.evaluate import eval_report, evaluate, roc_curve
from riskloom.operators.routing import backtest_rows
from riskloom.plans.inputs import Inputs
from riskloom.sources.scratch import save_scratch


@dataclass(frozen=True)
class Backtest:
    """``predictions``: TEST scores of all families; ``thresholds``: cut-offs of the first family."""

    predictions: DataFrame
    thresholds: DataFrame
    metrics: DataFrame
    drivers: DataFrame
    primary: str

    def report(self) -> DataFrame:
        return eval_report(self.metrics)

    def of_primary(self) -> DataFrame:
        return self.predictions.filter(F.col("model_family") == self.primary)

    def capture(self) -> DataFrame:
        return capture_report(self.of_primary(), self.thresholds)

    def trade_off(self) -> DataFrame:
        return roc_curve(self.of_primary())


def backtest(inputs: Inputs, families: list, train_end: int, eval_end: int) -> Backtest:
    """Fit every family for every geo. The first family is the primary one.

    TEST scores are written once per family and shared by all reports.
    """
    lists = inputs.checked_lists()
    features = inputs.features()
    history = backtest_rows(features, train_end, eval_end)
    test = features.filter(F.col("target").isNotNull() & (F.col("YEAR_MONTH") > eval_end))
    validation = history.filter("is_eval").drop("is_eval")
    scored = []
    for family in families:
        family.fit(history, lists)
        family.raise_errors()
        scored.append(save_scratch(family.score(test).withColumn("model_family", F.lit(family.prefix)), "predictions"))
    predictions = scored[0]
    for other in scored[1:]:
        predictions = predictions.unionByName(other)
    primary = families[0]
    return Backtest(
        predictions,
        calibrate(primary.score(validation).select("geo", "risk_score"), inputs.active_rules()),
        evaluate(predictions),
        primary.drivers(validation),
        primary.prefix,
    )


def top_drivers(drivers: DataFrame, n: int = 15) -> DataFrame:
    """The strongest overall drivers of every geo. The input has a row per geo and feature."""
    first = Window.partitionBy("geo").orderBy(F.desc("attribution"), "feature")
    best = drivers.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= n)
    return best.select("geo", "feature", F.round("attribution", 4).alias("attribution"))


def top_weights(weights: DataFrame, n: int = 15) -> DataFrame:
    """The heaviest standardised weights of every geo, by size, with their direction."""
    first = Window.partitionBy("geo").orderBy(F.abs("weight").desc(), "feature")
    best = weights.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= n)
    return best.select("geo", "feature", F.round("weight", 4).alias("weight"))


def trade_off(curve: DataFrame) -> DataFrame:
    """Every cut-off of every geo, highest first, with recall, precision and false alarms."""
    measures = ("threshold", "recall", "precision", "false_positive_rate")
    return curve.orderBy("geo", F.desc("threshold")).select("geo", *[F.round(c, 3).alias(c) for c in measures])
