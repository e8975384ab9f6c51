"""Arrays of per-variable contributions, handled inside the row without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

DRIVER_TYPE = "array<struct<feature:string,feature_value:string,contribution:double>>"


def number_text(value: Column) -> Column:
    """A number as text with at most six decimals and no trailing zeros: 58.0 -> '58'."""
    fixed = value.try_cast("decimal(30,6)").cast("string")
    return F.coalesce(F.regexp_replace(fixed, r"\.?0+$", ""), value.cast("string"))


def raw_values(df: DataFrame, features: list[str]) -> Column:
    """The features' values as one array of strings, to be made readable for the chosen ones only."""
    logical = [isinstance(df.schema[f].dataType, BooleanType) for f in features]
    return F.array(*[(F.col(f).cast("int") if b else F.col(f)).cast("string") for f, b in zip(features, logical)])


def readable(drivers: Column, df: DataFrame, features: list[str]) -> Column:
    """Drivers with the numbers among their raw values written by ``number_text``."""
    text = [f for f in features if isinstance(df.schema[f].dataType, StringType)]
    number = lambda d: number_text(d["feature_value"])
    shown = lambda d: F.when(d["feature"].isin(text), d["feature_value"]).otherwise(number(d)) if text else number(d)
    return F.transform(drivers, lambda d: d.withField("feature_value", shown(d)))


def strongest(drivers: Column, k: int | None) -> Column:
    """The ``k`` entries with the largest absolute contribution; feature name breaks ties."""
    keyed = F.transform(
        drivers,
        lambda d: F.struct((-F.abs(d["contribution"])).alias("order"), d["feature"].alias("name"), d.alias("driver")),
    )
    ordered = F.transform(F.array_sort(keyed), lambda k_: k_["driver"])
    return ordered if k is None else F.slice(ordered, 1, k)


def raising(drivers: Column) -> Column:
    """Entries that push the risk up, strongest first, each with its rank (ties share a rank)."""
    positive = F.filter(drivers, lambda d: d["contribution"] > 0)
    ranked = F.transform(
        positive,
        lambda d: F.struct(
            (F.size(F.filter(positive, lambda o: o["contribution"] > d["contribution"])) + 1)
            .cast("long")
            .alias("driver_rank"),
            d["feature"].alias("feature"),
            d["feature_value"].alias("feature_value"),
            d["contribution"].alias("risk_contribution"),
        ),
    )
    return F.array_sort(ranked)


def driver_names(ranked: Column, k: int) -> Column:
    """First ``k`` names joined by ', '; NULL when nothing raises the risk."""
    names = F.transform(F.slice(ranked, 1, k), lambda d: d["feature"])
    return F.when(F.size(ranked) > 0, F.array_join(names, ", "))


def driver_sentence(top: Column) -> Column:
    """Readable reasons: ``1. NAME = value (+0.123)  |  2. ...``."""
    parts = F.transform(
        top,
        lambda d: F.concat(
            d["driver_rank"].cast("string"),
            F.lit(". "),
            d["feature"],
            F.lit(" = "),
            F.coalesce(d["feature_value"], F.lit("NULL")),
            F.lit(" (+"),
            F.format_string("%.3f", F.round(d["risk_contribution"], 3)),
            F.lit(")"),
        ),
    )
    return F.when(F.size(top) > 0, F.array_join(parts, "  |  "))
