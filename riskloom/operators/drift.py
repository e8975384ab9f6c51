"""Changes between two months."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EPSILON = 1e-4


def feature_drift(df: DataFrame, features: list[str], base_month: int, month: int, bins: int = 10) -> DataFrame:
    """Population stability index per numeric feature.

    Bins have equal width over the base month's range; values outside fall into the outer bins,
    empty values into their own. Only the two months are read, and every task sends at most
    features x bins rows.
    """
    both = df.filter(F.col("YEAR_MONTH").isin(base_month, month)).select(
        "YEAR_MONTH", *[F.col(c).cast("double").alias(c) for c in features]
    )
    ranges = (
        both.filter(F.col("YEAR_MONTH") == base_month)
        .agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in features])
        .first()
    )

    def bin_of(c: str):
        lo, hi = ranges[c]["lo"], ranges[c]["hi"]
        if lo is None or hi == lo:
            place = F.when(F.col(c) < F.lit(lo), 0).when(F.col(c) > F.lit(lo), bins - 1).otherwise(bins // 2)
        else:
            place = F.floor((F.col(c) - lo) / ((hi - lo) / bins))
        return F.when(F.col(c).isNull(), -1).otherwise(F.greatest(F.lit(0), F.least(F.lit(bins - 1), place))).cast("int")

    counted = (
        both.select("YEAR_MONTH", *[bin_of(c).alias(c) for c in features])
        .unpivot(["YEAR_MONTH"], features, "feature", "bin")
        .groupBy("feature", "bin")
        .agg(
            F.count_if(F.col("YEAR_MONTH") == base_month).alias("n_base"),
            F.count_if(F.col("YEAR_MONTH") == month).alias("n_now"),
        )
    )
    whole = Window.partitionBy("feature")  # at most bins + 1 rows
    p = F.greatest(F.try_divide("n_base", F.sum("n_base").over(whole)), F.lit(EPSILON))
    q = F.greatest(F.try_divide("n_now", F.sum("n_now").over(whole)), F.lit(EPSILON))
    return (
        counted.withColumn("part", (q - p) * F.log(q / p))
        .groupBy("feature")
        .agg(F.sum("n_base").alias("n_base"), F.sum("n_now").alias("n_now"), F.sum("part").alias("psi"))
    )


def score_drift(employee: DataFrame, base_month: int, month: int) -> DataFrame:
    """Mean score and bucket shares per geo, month against base month."""
    now = F.col("YEAR_MONTH") == month
    then = F.col("YEAR_MONTH") == base_month
    flag = {b: F.col("risk_bucket") == b for b in ("RED", "AMBER")}

    def share(side, cond):
        return F.avg(F.when(side, F.when(cond, 1.0).otherwise(0.0)))

    return (
        employee.filter(then | now)
        .groupBy("geo")
        .agg(
            F.count_if(then).alias("n_base"),
            F.count_if(now).alias("n_now"),
            (F.avg(F.when(now, F.col("risk_score"))) - F.avg(F.when(then, F.col("risk_score")))).alias("score_change"),
            (share(now, flag["RED"]) - share(then, flag["RED"])).alias("red_share_change"),
            (share(now, flag["AMBER"]) - share(then, flag["AMBER"])).alias("amber_share_change"),
        )
    )


def driver_drift(drivers: DataFrame, base_month: int, month: int) -> DataFrame:
    """Change of each geo driver's share of all attribution."""
    whole = Window.partitionBy("geo", "YEAR_MONTH")  # one row per feature
    share = F.try_divide(F.col("attribution"), F.sum("attribution").over(whole))
    shares = drivers.filter(F.col("YEAR_MONTH").isin(base_month, month)).withColumn("share", share)
    return shares.groupBy("geo", "feature").agg(
        (
            F.coalesce(F.sum(F.when(F.col("YEAR_MONTH") == month, F.col("share"))), F.lit(0.0))
            - F.coalesce(F.sum(F.when(F.col("YEAR_MONTH") == base_month, F.col("share"))), F.lit(0.0))
        ).alias("share_change")
    )


def bucket_moves(employee: DataFrame, base_month: int, month: int) -> DataFrame:
    """How many employees moved from which bucket to which; NEW and GONE for the unmatched.

    One aggregation per employee instead of a self join.
    """
    per_employee = (
        employee.filter(F.col("YEAR_MONTH").isin(base_month, month))
        .groupBy("geo", "EMP_ID")
        .agg(
            F.max(F.when(F.col("YEAR_MONTH") == base_month, F.col("risk_bucket"))).alias("was"),
            F.max(F.when(F.col("YEAR_MONTH") == month, F.col("risk_bucket"))).alias("is"),
        )
    )
    return per_employee.groupBy(
        "geo",
        F.coalesce("was", F.lit("NEW")).alias("from_bucket"),
        F.coalesce("is", F.lit("GONE")).alias("to_bucket"),
    ).agg(F.count(F.lit(1)).alias("employees"))
