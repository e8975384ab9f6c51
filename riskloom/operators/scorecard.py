"""Linear scores as plain columns: a fixed scorecard, or a fitted linear model.

Produces the scored stage that all business operators read:
``geo, EMP_ID, YEAR_MONTH, target, risk_score, attributions, model_name``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.drivers import DRIVER_TYPE, raw_values, readable, strongest

STAGE_COLUMNS = ["geo", "EMP_ID", "YEAR_MONTH", "target", "risk_score", "attributions", "model_name"]


@dataclass(frozen=True)
class Weight:
    """One input of a scorecard: contribution = weight * (x - mean) / scale, 0 for NULL."""

    feature: str
    weight: float
    mean: float
    scale: float


@dataclass(frozen=True)
class Scorecard:
    name: str
    intercept: float
    weights: tuple[Weight, ...]


def contribution(w: Weight) -> Column:
    x = F.col(w.feature).cast("double")
    return F.coalesce(F.lit(w.weight) * (x - F.lit(w.mean)) / F.lit(w.scale), F.lit(0.0))


def score_with(df: DataFrame, card: Scorecard, top_k: int | None = 10, carry: tuple[str, ...] = ()) -> DataFrame:
    """Score routed rows (column ``geo``) and keep the strongest contributions and ``carry``."""
    return linear_stage(df, card.name, F.lit(card.intercept), card_parts(card), top_k, carry)


def card_parts(card: Scorecard) -> list[tuple[str, Column]]:
    return [(w.feature, contribution(w)) for w in card.weights]


def linear_drivers(df: DataFrame, parts: list[tuple[str, Column]]) -> DataFrame:
    """Mean absolute contribution per geo and feature, aggregated without building driver arrays."""
    means = df.groupBy("geo").agg(*[F.avg(F.abs(c)).alias(f"m_{name}") for name, c in parts])
    pairs = F.array(
        *[F.struct(F.lit(name).alias("feature"), F.col(f"m_{name}").alias("attribution")) for name, _ in parts]
    )
    return means.select("geo", F.inline(pairs))


def linear_stage(
    df: DataFrame,
    model_name: str,
    intercept: Column,
    parts: list[tuple[str, Column]],
    top_k: int | None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Stage rows from pairs (feature, contribution); values are those of the feature's column.

    Contributions and values are one array each, so the plan stays flat with many hundred features.
    """
    features = [name for name, _ in parts]
    slim = df.select(
        "geo",
        "EMP_ID",
        "YEAR_MONTH",
        "target",
        *carry,
        F.array(*[c for _, c in parts]).alias("c"),
        raw_values(df, features).alias("v"),
    )
    margin = F.aggregate("c", intercept, lambda total, c: total + c)
    names = F.lit(features)
    drivers = F.transform(
        "c",
        lambda c, i: F.struct(
            F.get(names, i).alias("feature"), F.get("v", i).alias("feature_value"), c.alias("contribution")
        ),
    ).cast(DRIVER_TYPE)
    return slim.select(
        "geo",
        "EMP_ID",
        "YEAR_MONTH",
        "target",
        (F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))).alias("risk_score"),
        readable(strongest(drivers, top_k), df, features).alias("attributions"),
        F.concat(F.lit(f"{model_name}_"), F.lower("geo")).alias("model_name"),
        *carry,
    )
