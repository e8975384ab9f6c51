"""Which rows belong to which geo, and to which part of the time split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.dates import month_plus


def route_to_geos(df: DataFrame, geos: list[str]) -> DataFrame:
    """A row with a geo goes to its own geo's model; a row without one goes to every model.

    The list is exploded inside the row, which gives an equi-key ``geo`` without a join.
    """
    every = F.array(*[F.lit(g) for g in geos])
    own = F.filter(every, lambda g: g == F.col("GEO"))
    routed = df.withColumn("model_geo", F.explode(F.when(F.col("GEO").isNull(), every).otherwise(own)))
    return routed.drop("GEO").withColumnRenamed("model_geo", "geo")


def split_name(year_month: Column, train_end: int, eval_end: int) -> Column:
    """TRAIN up to ``train_end``, EVAL up to ``eval_end``, TEST after it."""
    return F.when(year_month <= train_end, "TRAIN").when(year_month <= eval_end, "EVAL").otherwise("TEST")


def backtest_rows(df: DataFrame, train_end: int, eval_end: int) -> DataFrame:
    """Labelled TRAIN and EVAL rows with the validation flag."""
    return df.filter(F.col("target").isNotNull() & (F.col("YEAR_MONTH") <= eval_end)).withColumn(
        "is_eval", F.col("YEAR_MONTH") > train_end
    )


def eval_start(scoring_month: int, months: int = 3) -> int:
    """First month of the validation window in front of a scoring month."""
    return month_plus(scoring_month, -months)


def history_rows(df: DataFrame, scoring_month: int, months: int = 3) -> DataFrame:
    """Labelled rows before the scoring month; the last ``months`` are the validation window."""
    return df.filter(F.col("target").isNotNull() & (F.col("YEAR_MONTH") < scoring_month)).withColumn(
        "is_eval", F.col("YEAR_MONTH") >= eval_start(scoring_month, months)
    )


def calibration_rows(df: DataFrame, scoring_month: int, months: int = 3) -> DataFrame:
    """Labelled rows of the validation window."""
    start = eval_start(scoring_month, months)
    return df.filter(F.col("target").isNotNull() & F.col("YEAR_MONTH").between(start, month_plus(scoring_month, -1)))


def matured_rows(df: DataFrame, scoring_month: int, horizon_months: int) -> DataFrame:
    """Rows whose label is final at the end of ``scoring_month``."""
    return df.filter(F.col("target").isNotNull() & (F.col("YEAR_MONTH") <= month_plus(scoring_month, -horizon_months)))


def split_sizes(df: DataFrame, train_end: int, eval_end: int) -> DataFrame:
    """Rows, labelled rows and positives per geo and part."""
    return df.groupBy("geo", split_name(F.col("YEAR_MONTH"), train_end, eval_end).alias("split")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("target").alias("n_labelled"),
        F.count_if(F.col("target") == 1).alias("n_positive"),
    )


def class_weights(df: DataFrame) -> DataFrame:
    """Balanced weight per geo and label: rows / (classes x rows of the class)."""
    counts = df.filter(F.col("target").isNotNull()).groupBy("geo", "target").agg(F.count(F.lit(1)).alias("n"))
    classes = Window.partitionBy("geo")  # at most one row per class
    return counts.select(
        "geo",
        "target",
        "n",
        (F.sum("n").over(classes) / (F.count(F.lit(1)).over(classes) * F.col("n"))).alias("weight"),
    )
