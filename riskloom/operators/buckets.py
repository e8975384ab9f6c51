"""RED / AMBER / GREEN: cut-offs, buckets, and how well the buckets capture events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.ladder import score_ladder, upper_cutoff
from riskloom.sources.scratch import fix_small


def calibrate(scores: DataFrame, rules: DataFrame) -> DataFrame:
    """Cut-offs per geo from validation scores (geo, risk_score), for all geos in one pass.

    RED is the top ``red_top_pct`` percent, AMBER the next ``amber_next_pct``. FIXED geos, and
    geos without any validation score, keep the cut-offs of their rule.
    """
    wanted = rules.filter(F.col("method") == "PERCENTILE").select("geo", "red_top_pct", "amber_next_pct")
    ladder = score_ladder(scores.join(wanted.select("geo"), "geo", "left_semi"), ["geo"], "risk_score", {"n": F.lit(1)})
    red = F.col("red_top_pct")
    fresh = (
        ladder.join(wanted, "geo")
        .groupBy("geo")
        .agg(
            upper_cutoff("risk_score", "n", red).alias("new_red"),
            upper_cutoff("risk_score", "n", red + F.col("amber_next_pct")).alias("new_amber"),
            F.max("n_total").alias("n_scores"),
        )
    )
    return rules.join(fix_small(fresh), "geo", "left").select(
        "geo",
        "method",
        "red_top_pct",
        "amber_next_pct",
        F.coalesce("new_red", "red_threshold").alias("red_threshold"),
        F.coalesce("new_amber", "amber_threshold").alias("amber_threshold"),
        F.coalesce("n_scores", F.lit(0)).cast("long").alias("n_scores"),
    )


def bucket(score: Column, red: Column, amber: Column) -> Column:
    """Ties with a cut-off fall upwards."""
    return F.when(score >= red, "RED").when(score >= amber, "AMBER").otherwise("GREEN")


def assign_bucket(scores: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Add risk_bucket. ``thresholds`` has one row per geo."""
    cut = fix_small(thresholds.select("geo", "red_threshold", "amber_threshold"))
    return (
        scores.join(cut, "geo")
        .withColumn("risk_bucket", bucket(F.col("risk_score"), F.col("red_threshold"), F.col("amber_threshold")))
        .drop("red_threshold", "amber_threshold")
    )


def capture_report(predictions: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Employees, events, hit rate and share of all events, per geo and bucket."""
    events = F.sum("target")
    counted = (
        assign_bucket(predictions, thresholds)
        .groupBy("geo", "risk_bucket")
        .agg(F.count(F.lit(1)).alias("employees"), events.alias("actual_events"), F.avg("target").alias("rate"))
    )
    per_geo = Window.partitionBy("geo")  # three buckets at most
    order = F.when(F.col("risk_bucket") == "RED", "1-RED").when(F.col("risk_bucket") == "AMBER", "2-AMBER").otherwise("3-GREEN")
    return counted.select(
        "geo",
        order.alias("bucket"),
        "employees",
        "actual_events",
        F.round("rate", 3).alias("hit_rate"),
        F.round(F.try_divide(F.col("actual_events"), F.sum("actual_events").over(per_geo)), 3).alias("share_of_all_events"),
    )


def lift_report(predictions: DataFrame, thresholds: DataFrame) -> DataFrame:
    """RED hit rate against the base rate of the geo."""
    red = F.col("risk_bucket") == "RED"
    return (
        assign_bucket(predictions, thresholds)
        .groupBy("geo")
        .agg(
            F.avg("target").alias("base_rate"),
            F.avg(F.when(red, F.col("target"))).alias("red_hit_rate"),
            F.avg(F.when(F.col("risk_bucket").isin("RED", "AMBER"), F.lit(1)).otherwise(0)).alias("flagged_share"),
            F.try_divide(
                F.sum(F.when(F.col("risk_bucket").isin("RED", "AMBER"), F.col("target")).otherwise(0)), F.sum("target")
            ).alias("captured_share"),
        )
        .withColumn("lift", F.try_divide("red_hit_rate", "base_rate"))
    )


def target_cutoffs(predictions: DataFrame, min_precision: float, min_recall: float) -> DataFrame:
    """Cut-offs by target instead of by share.

    ``precision_cutoff``: the lowest score at which flagging everything from there up still has
    the wanted precision. ``recall_cutoff``: the highest score that reaches the wanted recall.
    """
    ladder = score_ladder(predictions, ["geo"], "risk_score", {"n": F.lit(1), "pos": F.col("target")})
    flagged = F.col("n_above") + F.col("n")
    hits = F.col("pos_above") + F.col("pos")
    return ladder.groupBy("geo").agg(
        F.min(F.when(hits >= F.lit(min_precision) * flagged, F.col("risk_score"))).alias("precision_cutoff"),
        F.max(F.when(hits >= F.lit(min_recall) * F.col("pos_total"), F.col("risk_score"))).alias("recall_cutoff"),
    )
