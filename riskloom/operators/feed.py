"""What consumers read: the alert feed, the summary, the action list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.drivers import driver_sentence


def ews_feed(employee: DataFrame, variable: DataFrame, drivers: int = 5) -> DataFrame:
    """RED and AMBER employees with their strongest drivers as an array.

    Both sides are cut before they meet: buckets on one, ranks on the other. The join and the
    aggregation use the same three keys, so one shuffle serves both.
    """
    keys = ["geo", "EMP_ID", "YEAR_MONTH"]
    flagged = employee.filter(F.col("risk_bucket").isin("RED", "AMBER"))
    top = variable.filter(F.col("driver_rank") <= drivers).select(
        *keys,
        F.struct(
            "driver_rank", "feature", "feature_value", F.round("risk_contribution", 4).alias("risk_contribution")
        ).alias("driver"),
    )
    rest = [c for c in ("risk_score", "risk_bucket", "risk_rank_in_geo", "model_name", "scored_at") if c in employee.columns]
    return (
        flagged.join(top, keys, "left")
        .groupBy(*keys, *rest)
        .agg(F.slice(F.sort_array(F.collect_list("driver")), 1, drivers).alias("top_variable_risks"))
        .withColumn("risk_score", F.round("risk_score", 4))
    )


def ews_summary(employee: DataFrame) -> DataFrame:
    """Counts per bucket and mean score, per geo and month."""
    return employee.groupBy("geo", "YEAR_MONTH").agg(
        F.count(F.lit(1)).alias("employees_scored"),
        F.count_if(F.col("risk_bucket") == "RED").alias("red"),
        F.count_if(F.col("risk_bucket") == "AMBER").alias("amber"),
        F.count_if(F.col("risk_bucket") == "GREEN").alias("green"),
        F.round(F.avg("risk_score"), 4).alias("avg_risk_score"),
    )


def action_list(feed: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` highest scores with readable reasons; geo and id break ties."""
    return (
        feed.orderBy(F.desc("risk_score"), "geo", "EMP_ID")
        .limit(n)
        .select(
            "geo",
            "EMP_ID",
            "risk_score",
            "risk_bucket",
            "risk_rank_in_geo",
            driver_sentence(F.col("top_variable_risks")).alias("recommended_variable_risks"),
        )
    )


def published_feed(feed: DataFrame, published: DataFrame) -> DataFrame:
    """Only the geo-months that were released. ``published`` holds the newest flag per geo-month."""
    released = published.filter("published").select("geo", "YEAR_MONTH")
    return feed.join(released, ["geo", "YEAR_MONTH"], "left_semi")
