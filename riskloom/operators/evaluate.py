"""Model quality from scored, labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.ladder import score_ladder

KEYS = ["geo", "model_family"]


def evaluate(predictions: DataFrame, cut: float = 0.5) -> DataFrame:
    """Precision, recall, accuracy, F1, log loss and ROC AUC per geo and model family.

    AUC counts, for every distinct score, the negatives at that score against the positives above
    it, ties half; it needs no window over a geo.
    """
    y = F.col("target")
    hit = F.col("risk_score") >= cut
    p = F.greatest(F.least(F.col("risk_score"), F.lit(1 - 1e-15)), F.lit(1e-15))
    ladder = score_ladder(predictions.filter(y.isNotNull()), KEYS, "risk_score", {"pos": y, "neg": 1 - y})
    sums = ladder.groupBy(*KEYS).agg(
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
        F.max("pos_total").alias("p"),
        F.max("neg_total").alias("n"),
        (-F.sum(F.col("pos") * F.log(p) + F.col("neg") * F.log(1 - p))).alias("loss"),
        F.sum(F.col("neg") * (F.col("pos_above") + F.col("pos") / 2)).alias("ordered_pairs"),
    )
    precision = F.try_divide("tp", F.col("tp") + F.col("fp"))
    recall = F.try_divide("tp", "p")
    rows = F.col("p") + F.col("n")
    return sums.select(
        *KEYS,
        precision.alias("precision"),
        recall.alias("recall"),
        ((F.col("tp") + F.col("n") - F.col("fp")) / rows).alias("accuracy"),
        F.try_divide(2 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("p")).alias("f1_score"),
        (F.col("loss") / rows).alias("log_loss"),
        F.try_divide(F.col("ordered_pairs"), F.col("p").cast("double") * F.col("n")).alias("roc_auc"),
    )


def eval_report(metrics: DataFrame) -> DataFrame:
    """Family against family, three decimals."""
    return metrics.select(
        *KEYS,
        F.round("roc_auc", 3).alias("roc_auc"),
        F.round("recall", 3).alias("recall"),
        F.round("precision", 3).alias("precision"),
        F.round("f1_score", 3).alias("f1"),
        F.round("log_loss", 3).alias("log_loss"),
    )


def roc_curve(predictions: DataFrame) -> DataFrame:
    """Every distinct score of a geo as a cut-off, with the counts and rates it gives."""
    ladder = score_ladder(
        predictions.filter(F.col("target").isNotNull()),
        ["geo"],
        "risk_score",
        {"pos": F.col("target"), "neg": 1 - F.col("target")},
    )
    tp = F.col("pos_above") + F.col("pos")
    fp = F.col("neg_above") + F.col("neg")
    return ladder.select(
        "geo",
        F.col("risk_score").alias("threshold"),
        tp.alias("true_positives"),
        fp.alias("false_positives"),
        (F.col("pos_total") - tp).alias("false_negatives"),
        (F.col("neg_total") - fp).alias("true_negatives"),
        F.try_divide(tp, "pos_total").alias("recall"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(fp, "neg_total").alias("false_positive_rate"),
    )


def choose_champion(metrics: DataFrame, current: str, margin: float = 0.0) -> DataFrame:
    """Per geo, the challenger replaces the current family only with a better AUC.

    ``margin`` is the gain a challenger must show.
    """
    adjusted = F.col("roc_auc") - F.when(F.col("model_family") == current, 0.0).otherwise(margin)
    best = Window.partitionBy("geo").orderBy(
        adjusted.desc(), F.when(F.col("model_family") == current, 0).otherwise(1), "model_family"
    )  # one row per model family
    return (
        metrics.withColumn("place", F.row_number().over(best))
        .filter(F.col("place") == 1)
        .select(
            "geo",
            F.col("model_family").alias("approved_family"),
            (F.col("model_family") != current).alias("promoted"),
            "roc_auc",
        )
    )


def parity(old: DataFrame, new: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """Old against new metrics; a difference within the tolerance counts as equal."""
    pair = old.select("geo", F.col("roc_auc").alias("old_auc")).join(
        new.select("geo", F.col("roc_auc").alias("new_auc")), "geo"
    )
    gap = F.col("new_auc") - F.col("old_auc")
    return pair.select(
        "geo",
        "old_auc",
        "new_auc",
        gap.alias("difference"),
        F.when(F.abs(gap) <= tolerance, "EQUAL").when(gap > 0, "BETTER").otherwise("WORSE").alias("verdict"),
    )
