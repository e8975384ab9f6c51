"""From feature columns to an MLlib feature vector."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riskloom.operators.routing import route_to_geos


COLUMNS_PER_PASS = 40
MAX_LABELS = 256  # text columns of (about) more distinct values are hashed
HASH_BUCKETS = 256
HASHED = "__h"  # end of the name of a hashed column


@dataclass(frozen=True)
class GeoFacts:
    """What one geo's training rows say before any fit."""

    low: dict[str, float]
    mean: dict[str, float]
    weight: dict[int, float]
    n_rows: int
    has_eval: bool
    hashed: list[str] = field(default_factory=list)


def is_text(df: DataFrame, feature: str) -> bool:
    return isinstance(df.schema[feature].dataType, StringType)


def rows_of_geo(df: DataFrame, geo: str) -> DataFrame:
    """Rows for one geo's model: its own, and those without a geo. Reaches the scan as a filter."""
    return df.filter((F.col("GEO") == geo) | F.col("GEO").isNull()).drop("GEO").withColumn("geo", F.lit(geo))


def geo_facts(history: DataFrame, lists: dict[str, list[str]]) -> dict[str, GeoFacts]:
    """Minimum and mean of every numeric input and the class weights, for all geos together.

    The result has geos x features numbers, which configuration bounds.
    """
    numeric = sorted({f for fs in lists.values() for f in fs if not is_text(history, f)})
    routed = route_to_geos(history.select("GEO", "target", "is_eval", *numeric), sorted(lists))
    train = routed.filter(~F.col("is_eval"))
    counted = routed.groupBy("geo", "target", "is_eval").agg(F.count(F.lit(1)).alias("n")).collect()
    weights: dict[str, dict[int, float]] = {}
    sizes: dict[str, int] = {}
    for r in counted:
        sizes[r["geo"]] = sizes.get(r["geo"], 0) + r["n"]
        if not r["is_eval"]:
            weights.setdefault(r["geo"], {})[r["target"]] = r["n"]
    for geo, by_class in weights.items():
        weights[geo] = {label: sum(by_class.values()) / (len(by_class) * n) for label, n in by_class.items()}
    held = {r["geo"] for r in counted if r["is_eval"]}
    low: dict[str, dict[str, float]] = {g: {} for g in weights}
    mean: dict[str, dict[str, float]] = {g: {} for g in weights}
    # A pass per group of columns: each column is read once, and the aggregation stays compiled.
    for at in range(0, len(numeric), COLUMNS_PER_PASS):
        group = numeric[at : at + COLUMNS_PER_PASS]
        measures = [f(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))).alias(f"{name}_{c}") for c in group for name, f in (("low", F.min), ("mean", F.avg))]
        for r in train.groupBy("geo").agg(*measures).collect():
            low[r["geo"]].update({c: r[f"low_{c}"] or 0.0 for c in group})
            mean[r["geo"]].update({c: r[f"mean_{c}"] or 0.0 for c in group})
    hashed = _many_labels(history, lists)
    return {g: GeoFacts(low[g], mean[g], weights[g], sizes[g], g in held, hashed.get(g, [])) for g in weights}


def _many_labels(history: DataFrame, lists: dict[str, list[str]]) -> dict[str, list[str]]:
    """Text inputs of each geo with more than MAX_LABELS values, by sketches: no label reaches the driver."""
    texts = sorted({f for fs in lists.values() for f in fs if is_text(history, f)})
    if not texts:
        return {}
    train = route_to_geos(history.filter(~F.col("is_eval")).select("GEO", *texts), sorted(lists))
    counts = train.groupBy("geo").agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in texts]).collect()
    return {r["geo"]: [c for c in texts if c in lists[r["geo"]] and r[c] > MAX_LABELS] for r in counts}


def training_rows(history: DataFrame, geo: str, features: list[str], facts: GeoFacts) -> DataFrame:
    weight = F.lit(None).cast("double")
    for label, value in facts.weight.items():
        weight = F.when(F.col("target") == label, value).otherwise(weight)
    return rows_of_geo(history, geo).select(
        "EMP_ID",
        "YEAR_MONTH",
        *features,
        F.col("target").cast("double").alias("target"),
        "is_eval",
        weight.alias("class_weight"),
    )


def encoder(df: DataFrame, features: list[str], facts: GeoFacts, one_hot: bool) -> Pipeline:
    """Fill, index and assemble, in the order of ``features``.

    Empty numbers, NaN among them: for trees one below the smallest value, so that a single split separates
    them; for linear models the mean, which makes their contribution zero. Unseen or empty texts
    get a category of their own. Texts with many values are hashed to HASH_BUCKETS codes, so neither the
    driver nor a tree's bins grow with the number of values.
    """
    text = [f for f in features if is_text(df, f)]
    hashed = [f for f in text if f in facts.hashed]
    fills = [f"CAST(crc32(CAST(`{f}` AS BINARY)) % {HASH_BUCKETS} AS STRING) AS `{f}{HASHED}`" for f in hashed]
    for f in features:
        if f not in text:
            fill = facts.mean[f] if one_hot else facts.low[f] - 1.0
            fills.append(f"coalesce(nanvl(CAST(`{f}` AS DOUBLE), NULL), CAST({fill!r} AS DOUBLE)) AS `{f}__x`")
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(fills)} FROM __THIS__")] if fills else []
    if text:
        named = {f: f"{f}__i" if one_hot else f"{f}__x" for f in text}
        counted = [f for f in text if f not in hashed]
        if counted:
            outputs = [named[f] for f in counted]
            stages.append(StringIndexer(inputCols=counted, outputCols=outputs, handleInvalid="keep", stringOrderType="frequencyDesc"))
        if hashed:
            codes = [[str(k) for k in range(HASH_BUCKETS)] for _ in hashed]
            fixed = StringIndexerModel.from_arrays_of_labels(codes, inputCols=[f"{f}{HASHED}" for f in hashed], outputCols=[named[f] for f in hashed], handleInvalid="keep")
            stages.append(fixed)
        indexed = list(named.values())
        if one_hot:
            stages.append(
                OneHotEncoder(inputCols=indexed, outputCols=[f"{f}__x" for f in text], dropLast=False, handleInvalid="keep")
            )
    stages.append(VectorAssembler(inputCols=[f"{f}__x" for f in features], outputCol="features"))
    return Pipeline(stages=stages)


def slots(encoded: DataFrame, features: list[str]) -> list[str]:
    """Feature behind every position of the assembled vector.

    A position is named ``<feature>__x``, or ``<feature>__x_<category>``.
    """
    meta = encoded.schema["features"].metadata["ml_attr"]
    names = sorted((a["idx"], a["name"]) for group in meta["attrs"].values() for a in group)
    exact = {f"{f}__x": f for f in features}
    return [exact.get(name) or max((f for f in features if name.startswith(f"{f}__x_")), key=len) for _, name in names]

