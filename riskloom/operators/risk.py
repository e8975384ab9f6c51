"""From the scored stage to the published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.drivers import driver_names, raising
from riskloom.operators.buckets import assign_bucket
from riskloom.operators.ladder import with_rank


def employee_risk(stage: DataFrame, thresholds: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Score, bucket, rank in geo and the three strongest drivers of every employee, and ``carry``."""
    slim = stage.select(
        "geo",
        "EMP_ID",
        "YEAR_MONTH",
        "risk_score",
        driver_names(raising(F.col("attributions")), 3).alias("top_risk_drivers"),
        "model_name",
        *carry,
    )
    ranked = with_rank(assign_bucket(slim, thresholds), ["geo", "YEAR_MONTH"], "risk_score", "risk_rank_in_geo")
    return ranked.select(
        "geo",
        "EMP_ID",
        "YEAR_MONTH",
        "risk_score",
        "risk_bucket",
        "risk_rank_in_geo",
        "top_risk_drivers",
        "model_name",
        *carry,
    )


def variable_risk(stage: DataFrame) -> DataFrame:
    """One row per driver that raises an employee's risk, with the actual value and the rank.

    The rank is taken inside the row's own array, so no window and no shuffle is needed.
    """
    return stage.select("geo", "EMP_ID", "YEAR_MONTH", F.inline(raising(F.col("attributions")))).select(
        "geo", "EMP_ID", "YEAR_MONTH", "feature", "feature_value", "risk_contribution", "driver_rank"
    )


def geo_drivers(stage: DataFrame) -> DataFrame:
    """Mean absolute contribution per geo and feature. ``stage`` must hold all contributions."""
    return (
        stage.select("geo", F.inline("attributions"))
        .groupBy("geo", "feature")
        .agg(F.avg(F.abs("contribution")).alias("attribution"))
    )
