"""Scorecard, boosted trees and logistic regression behind one interface.

Every family offers ``fit(history, lists)``, ``score(rows)``, ``explain(rows, top_k)``,
``drivers(rows)`` and ``inputs()``. Rows carry GEO; scores carry geo, EMP_ID, YEAR_MONTH, target,
risk_score; explained rows the attributions and model name on top; drivers are the mean absolute
contribution per geo and feature.
"""

from __future__ import annotations

import json
import time
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.errors import ConfigError, TrainingError
from riskloom.functions.drivers import DRIVER_TYPE, raw_values, readable
from riskloom.models import kernel
from riskloom.models.attribution import build_explainer
from riskloom.models.prepare import HASH_BUCKETS, HASHED, GeoFacts, encoder, geo_facts, is_text, rows_of_geo, slots, training_rows
from riskloom.operators.routing import route_to_geos
from riskloom.operators.scorecard import (
    STAGE_COLUMNS,
    Scorecard,
    card_parts,
    linear_drivers,
    score_with,
)
from riskloom.sources.scratch import local_table, side_by_side

SCORE_COLUMNS = STAGE_COLUMNS[:5]
PARTITION_BYTES = 32 * 1024 * 1024


class ScorecardFamily:
    """Fixed weights; nothing to fit."""

    def __init__(self, card: Scorecard):
        self.card = card
        self.prefix = card.name
        self.lists: dict[str, list[str]] = {}
        self.errors: dict[str, str] = {}

    def fit(self, history: DataFrame, lists: dict[str, list[str]]) -> None:
        self.lists = lists

    def raise_errors(self) -> None:
        pass

    def n_inputs(self, features: list[str]) -> int:
        """Inputs that the model of a geo with these features has."""
        return len(self.card.weights)

    def explain(self, rows: DataFrame, top_k: int | None = 10) -> DataFrame:
        return score_with(route_to_geos(rows, sorted(self.lists)), self.card, top_k)

    def score(self, rows: DataFrame) -> DataFrame:
        return self.explain(rows).select(*SCORE_COLUMNS)

    def drivers(self, rows: DataFrame) -> DataFrame:
        return linear_drivers(route_to_geos(rows, sorted(self.lists)), card_parts(self.card))

    def inputs(self) -> dict[str, list[str]]:
        return {f"{self.prefix}_{g.lower()}": [w.feature for w in self.card.weights] for g in self.lists}


class TrainingRows:
    """Facts and encoded rows of all geos for several fits on the same history, each made at its first use.

    The rows stay persisted until ``close``. Only families of one kind and one history may share them.
    """

    def __init__(self, history: DataFrame, lists: dict[str, list[str]]):
        self.history = history
        self.lists = lists
        self.facts = geo_facts(history, lists)
        self.geos: dict[str, tuple[PipelineModel, DataFrame, list[str]]] = {}

    def of(self, geo: str, one_hot: bool) -> tuple[PipelineModel, DataFrame, list[str]]:
        """Fitted encoder, persisted rows, and the feature behind each slot of their vectors."""
        if geo not in self.geos:
            self.geos[geo] = self._encode(geo, one_hot)
        return self.geos[geo]

    def _encode(self, geo: str, one_hot: bool) -> tuple[PipelineModel, DataFrame, list[str]]:
        facts, features = self.facts[geo], self.lists[geo]
        rows = training_rows(self.history, geo, features, facts)
        coding = encoder(rows, features, facts, one_hot).fit(rows.filter(~F.col("is_eval")))
        columns = ["features", "target", "is_eval", "class_weight"]
        encoded = coding.transform(rows).select("EMP_ID", "YEAR_MONTH", *columns)
        # A geo's rows are spread thinly over the store's files; every training round reads them
        # again, so they are gathered once into even partitions of a size that suits the data. The
        # order by key makes row sampling repeatable, also when a lost partition is built again.
        places = slots(encoded, features)
        parts = facts.n_rows * len(places) * 8 // PARTITION_BYTES + 1
        key = ["EMP_ID", "YEAR_MONTH"]
        encoded = encoded.repartition(parts, *key).sortWithinPartitions(*key).select(*columns)
        return coding, encoded.persist(StorageLevel.MEMORY_AND_DISK), places

    def drop(self, geo: str) -> None:
        if geo in self.geos:
            self.geos.pop(geo)[1].unpersist()

    def close(self) -> None:
        for geo in list(self.geos):
            self.drop(geo)


class FittedFamily:
    """One MLlib pipeline per geo, fitted side by side from a driver thread pool."""

    prefix = ""
    one_hot = False

    def __init__(self, path: str, name: str | None = None, parallelism: int = 8, seed: int = 7):
        """``path``: folder of this version of the models; ``name``: prefix of the model names."""
        self.path = path
        self.prefix = name or self.prefix
        self.paths: dict[str, str] = {}
        self.parallelism = parallelism
        self.seed = seed
        self.lists: dict[str, list[str]] = {}
        self.models: dict[str, PipelineModel] = {}
        self.slots: dict[str, list[str]] = {}
        self.facts: dict[str, GeoFacts] = {}
        self.errors: dict[str, str] = {}
        self.seconds: dict[str, float] = {}
        self._rows: TrainingRows | None = None
        self._keep = False
        self._read: dict[str, dict] = {}  # what the kernel knows of each geo's model

    def estimator(self, categories: int, has_eval: bool):
        raise NotImplementedError

    def fit(self, history: DataFrame, lists: dict[str, list[str]], shared: TrainingRows | None = None) -> None:
        """Fit every geo. A geo that cannot be fitted is named in ``errors``; the others go on.

        ``shared`` keeps the encoded rows of ``history`` for further fits; whoever made it closes it.
        """
        self.lists = lists
        self._read = {}
        self._keep = shared is not None
        self._rows = shared or TrainingRows(history, lists)
        self.facts = self._rows.facts
        spark = history.sparkSession

        def one(geo: str) -> None:
            started = time.monotonic()
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{geo}")
            try:
                self._fit_geo(history, geo)
            except Exception as error:  # noqa: BLE001 - the message goes to the run log
                self.errors[geo] = f"{type(error).__name__}: {error}"
            self.seconds[geo] = time.monotonic() - started

        side_by_side(spark, one, sorted(lists), self.parallelism)
        self._rows = None

    def _fit_geo(self, history: DataFrame, geo: str) -> None:
        facts = self.facts.get(geo)
        if facts is None or len(facts.weight) < 2:
            raise ConfigError(f"Geo {geo} has no training rows of both classes")
        try:
            coding, encoded, self.slots[geo] = self._rows.of(geo, self.one_hot)
            categories = max(
                [len(labels) + 1 for s in coding.stages if isinstance(s, StringIndexerModel) for labels in s.labelsArray],
                default=2,
            )
            model = self._fit_rows(encoded, categories, facts.has_eval, geo)
        finally:
            if not self._keep:
                self._rows.drop(geo)
        fitted = PipelineModel(stages=[*coding.stages, model])
        fitted.write().overwrite().save(self.model_path(geo))
        # what was stored is what is used; a training summary would drag the session into every task
        self.models[geo] = PipelineModel.load(self.model_path(geo))
        self._save_state(history.sparkSession, geo)

    def _fit_rows(self, encoded: DataFrame, categories: int, has_eval: bool, geo: str):
        raise NotImplementedError

    def model_path(self, geo: str) -> str:
        return f"{self.paths.get(geo, self.path)}/{self.prefix}/{geo}"

    def _state(self, geo: str) -> dict:
        facts = self.facts[geo]
        return {
            "features": self.lists[geo],
            "slots": self.slots[geo],
            "facts": {**vars(facts), "weight": {str(k): v for k, v in facts.weight.items()}},
        }

    def _restore(self, geo: str, state: dict) -> None:
        self.lists[geo] = state["features"]
        self.slots[geo] = state["slots"]
        facts = state["facts"]
        self.facts[geo] = GeoFacts(**{**facts, "weight": {int(k): v for k, v in facts["weight"].items()}})

    def _save_state(self, spark: SparkSession, geo: str) -> None:
        text = local_table(spark, {"value": pa.array([json.dumps(self._state(geo))], pa.string())})
        text.write.mode("overwrite").text(f"{self.model_path(geo)}_state")

    def load(self, spark: SparkSession, versions: dict[str, str]) -> None:
        """Take over fitted models: geo -> path they were fitted under. Replaces ``fit``."""
        self.paths = dict(versions)
        self._read = {}
        for geo in versions:
            self.models[geo] = PipelineModel.load(self.model_path(geo))
            self._restore(geo, json.loads(spark.read.text(f"{self.model_path(geo)}_state").first()["value"]))

    def n_inputs(self, features: list[str]) -> int:
        return len(features)

    def _arrays(self, spark: SparkSession, geo: str) -> dict:
        """The fitted model as plain arrays, for the kernel."""
        raise NotImplementedError

    def book(self, rows: DataFrame) -> dict:
        """All geos' models for the kernel; ``rows`` tells which inputs are texts."""
        spark = rows.sparkSession
        every = sorted({f for g in self.models for f in self.lists[g]})
        texts = [f for f in every if is_text(rows, f)]
        numbers = [f for f in every if f not in texts]
        place = {f: k for k, f in enumerate(every)}
        geos = {}
        for geo in sorted(self.models):
            if geo not in self._read:
                self._read[geo] = self._arrays(spark, geo)
            features = self.lists[geo]
            fill = self.facts[geo].mean if self.one_hot else {f: low - 1.0 for f, low in self.facts[geo].low.items()}
            labels = self.labels(geo)
            geos[geo] = {
                "features": features,
                "names": np.array([place[f] for f in features], np.int64),
                "inputs": [(f in texts, (texts if f in texts else numbers).index(f)) for f in features],
                "fill": [fill.get(f) for f in features],
                "labels": [labels.get(f) for f in features],
                **self._read[geo],
            }
        return {"numbers": numbers, "texts": texts, "every": every, "geos": geos}

    def labels(self, geo: str) -> dict[str, list[str] | int]:
        """How each text input is coded: its labels in order, or the number of hash buckets."""
        indexers = [s for s in self.models[geo].stages if isinstance(s, StringIndexerModel)]
        found = {c: list(ls) for s in indexers for c, ls in zip(s.getInputCols(), s.labelsArray)}
        hashed = self.facts[geo].hashed
        return {c: ls for c, ls in found.items() if c.removesuffix(HASHED) not in hashed} | dict.fromkeys(hashed, HASH_BUCKETS)

    def pipeline_scores(self, rows: DataFrame) -> DataFrame:
        """Scores by the stored pipelines themselves, a scan per geo: what the kernel has to agree with."""
        parts = []
        for geo in sorted(self.models):
            own = rows_of_geo(rows, geo).select("geo", "EMP_ID", "YEAR_MONTH", "target", *self.lists[geo])
            scored = self.models[geo].transform(own)
            parts.append(scored.withColumn("risk_score", vector_to_array("probability")[1]).select(*SCORE_COLUMNS))
        return reduce(DataFrame.unionByName, parts)

    def _routed(self, rows: DataFrame) -> DataFrame:
        geos = sorted(self.models)
        return route_to_geos(rows.filter(F.col("GEO").isNull() | F.col("GEO").isin(geos)), geos)

    def score(self, rows: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
        """Scores of all geos' rows, read and routed once; ``carry`` names features to keep."""
        book = self.book(rows)
        margin = kernel.scorer(rows.sparkSession.sparkContext.broadcast(book))
        ready = self._routed(rows).select(*SCORE_COLUMNS[:4], *carry, *kernel.inputs_of(book))
        odds = F.exp(-margin("geo", "n", "t"))
        return ready.select(*SCORE_COLUMNS[:4], (F.lit(1.0) / (F.lit(1.0) + odds)).alias("risk_score"), *carry)

    def explain(self, rows: DataFrame, top_k: int | None = 10) -> DataFrame:
        """Score and strongest contributions with their values, from one batch of the kernel."""
        book = self.book(rows)
        explained = kernel.explainer(rows.sparkSession.sparkContext.broadcast(book), top_k)
        routed = self._routed(rows)
        ready = routed.select(*SCORE_COLUMNS[:4], *kernel.inputs_of(book), raw_values(routed, book["every"]).alias("v"))
        out = ready.withColumn("m", explained("geo", "n", "t"))
        names = F.lit(book["every"])
        drivers = F.transform(
            F.arrays_zip(F.col("m.place").alias("place"), F.col("m.contribution").alias("contribution")),
            lambda d: F.struct(F.get(names, d["place"]).alias("feature"), F.get("v", d["place"]).alias("feature_value"), d["contribution"].alias("contribution")),
        ).cast(DRIVER_TYPE)
        return out.select(
            *SCORE_COLUMNS[:4],
            (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("m.margin")))).alias("risk_score"),
            readable(drivers, rows, book["every"]).alias("attributions"),
            F.concat(F.lit(f"{self.prefix}_"), F.lower("geo")).alias("model_name"),
        )

    def drivers(self, rows: DataFrame) -> DataFrame:
        """Mean absolute contribution per geo and feature, summed inside the tasks."""
        book = self.book(rows)
        shared = rows.sparkSession.sparkContext.broadcast(book)
        ready = self._routed(rows).select("geo", *kernel.inputs_of(book))
        sums = ready.mapInArrow(kernel.driver_sums(shared), "geo string, feature string, total double, n bigint")
        return sums.groupBy("geo", "feature").agg((F.sum("total") / F.sum("n")).alias("attribution"))

    def bases(self, spark: SparkSession) -> dict[str, float]:
        """Log-odds per geo of a row whose inputs say nothing."""
        return {geo: self._base(spark, geo) for geo in self.models}

    def _base(self, spark: SparkSession, geo: str) -> float:
        raise NotImplementedError

    def raise_errors(self) -> None:
        """Stop with the reasons if any geo could not be fitted."""
        if self.errors:
            raise TrainingError("; ".join(f"{g}: {m}" for g, m in sorted(self.errors.items())))

    def inputs(self) -> dict[str, list[str]]:
        return {f"{self.prefix}_{g.lower()}": sorted(set(s)) for g, s in self.slots.items()}


class TreeFamily(FittedFamily):
    """Boosted trees with row and column sampling and early stopping."""

    prefix = "btree"

    def __init__(self, path: str, rounds: int = 100, depth: int = 6, early_stop: bool = True, step: float = 0.1, **kwargs):
        super().__init__(path, **kwargs)
        self.rounds = rounds
        self.depth = depth
        self.early_stop = early_stop
        self.step = step

    def estimator(self, categories: int, has_eval: bool) -> GBTClassifier:
        stopping = {"validationIndicatorCol": "is_eval", "validationTol": 0.005} if has_eval and self.early_stop else {}
        return GBTClassifier(
            labelCol="target",
            weightCol="class_weight",
            maxIter=self.rounds,
            maxDepth=self.depth,
            stepSize=self.step,
            subsamplingRate=0.8,
            featureSubsetStrategy="0.8",
            maxBins=max(32, categories),
            seed=self.seed,
            **stopping,
        )

    def _fit_rows(self, encoded: DataFrame, categories: int, has_eval: bool, geo: str):
        rows = encoded if has_eval and self.early_stop else encoded.filter(~F.col("is_eval"))
        return self.estimator(categories, has_eval).fit(rows)

    def _nodes(self, spark: SparkSession, geo: str) -> list[dict]:
        """The saved trees. Their size is bounded by rounds x 2^(depth+1) nodes."""
        stage = len(self.models[geo].stages) - 1
        trees = self.models[geo].stages[-1]
        folder = f"{self.model_path(geo)}/stages/{stage}_{trees.uid}/data"
        rows = spark.read.parquet(folder).select(
            F.col("treeID").alias("tree"),
            F.col("nodeData.id").alias("id"),
            F.col("nodeData.prediction").alias("prediction"),
            F.col("nodeData.impurityStats")[0].alias("cover"),
            F.col("nodeData.leftChild").alias("left"),
            F.col("nodeData.rightChild").alias("right"),
            F.col("nodeData.split.featureIndex").alias("feature"),
            F.col("nodeData.split.leftCategoriesOrThreshold").alias("split"),
            F.col("nodeData.split.numCategories").alias("n_categories"),
        )
        return [r.asDict() for r in rows.collect()]

    def _arrays(self, spark: SparkSession, geo: str) -> dict:
        trees = self.models[geo].stages[-1]
        return {"trees": build_explainer(self._nodes(spark, geo), list(trees.treeWeights), len(self.slots[geo]))}

    def _base(self, spark: SparkSession, geo: str) -> float:
        if geo not in self._read:
            self._read[geo] = self._arrays(spark, geo)
        return self._read[geo]["trees"]["base"]

    def staged_scores(self, rows: DataFrame, rounds: list[int]) -> DataFrame:
        """Scores after each of the numbers of rounds, an array per row: what fits of fewer rounds would say."""
        book = self.book(rows)
        margin = kernel.scorer(rows.sparkSession.sparkContext.broadcast(book), rounds)
        ready = self._routed(rows).select(*SCORE_COLUMNS[:4], *kernel.inputs_of(book))
        staged = F.transform(margin("geo", "n", "t"), lambda m: F.lit(1.0) / (F.lit(1.0) + F.exp(-m)))
        return ready.select(*SCORE_COLUMNS[:4], staged.alias("risk_scores"))

    def training_curve(self, history: DataFrame) -> DataFrame:
        """Log loss after every round, on training and validation rows, from one pass over ``history``.

        The time is known per fit only, and null for models that were loaded.
        """
        book = self.book(history)
        shared = history.sparkSession.sparkContext.broadcast(book)
        ready = self._routed(history.filter(F.col("target").isNotNull())).select("geo", "target", "is_eval", *kernel.inputs_of(book))
        sums = ready.mapInArrow(kernel.curve_sums(shared, self.rounds), "geo string, is_eval boolean, iteration bigint, total double, n bigint")
        mean = lambda part: F.sum(F.when(part, F.col("total"))) / F.sum(F.when(part, F.col("n")))
        curve = sums.groupBy("geo", "iteration").agg(mean(~F.col("is_eval")).alias("train_loss"), mean(F.col("is_eval")).alias("eval_loss"))
        seconds = F.lit(None).cast("double")
        for geo, value in self.seconds.items():
            seconds = F.when(F.col("geo") == geo, value).otherwise(seconds)
        return curve.withColumn("fit_seconds", seconds)


class LinearFamily(FittedFamily):
    """Logistic regression with L2 penalty; explained with plain columns."""

    prefix = "logreg"
    one_hot = True

    def estimator(self, categories: int, has_eval: bool) -> LogisticRegression:
        return LogisticRegression(
            labelCol="target", weightCol="class_weight", regParam=0.1, elasticNetParam=0.0, maxIter=30
        )

    def __init__(self, path: str, **kwargs):
        super().__init__(path, **kwargs)
        self.moments: dict[str, tuple[list[float], list[float]]] = {}

    def _fit_rows(self, encoded: DataFrame, categories: int, has_eval: bool, geo: str):
        train = encoded.filter(~F.col("is_eval"))
        found = train.select(Summarizer.metrics("mean", "std").summary(F.col("features")).alias("m")).first()["m"]
        self.moments[geo] = (list(found["mean"]), list(found["std"]))
        return self.estimator(categories, has_eval).fit(train)

    def _state(self, geo: str) -> dict:
        return {**super()._state(geo), "moments": self.moments[geo]}

    def _restore(self, geo: str, state: dict) -> None:
        super()._restore(geo, state)
        self.moments[geo] = tuple(state["moments"])

    def _base(self, spark: SparkSession, geo: str) -> float:
        """The row that equals the training means."""
        model = self.models[geo].stages[-1]
        return float(model.intercept) + sum(float(c) * m for c, m in zip(model.coefficients, self.moments[geo][0]))

    def weights(self, spark: SparkSession) -> DataFrame:
        """Coefficient x standard deviation per input; the intercept is left out."""
        flat = []
        for geo in sorted(self.models):
            coefficients = self.models[geo].stages[-1].coefficients
            names = _slot_names(self.models[geo], self.lists[geo], self.slots[geo])
            flat += [(geo, n, float(c) * s) for n, c, s in zip(names, coefficients, self.moments[geo][1])]
        return local_table(
            spark,
            {
                "geo": pa.array([r[0] for r in flat], pa.string()),
                "feature": pa.array([r[1] for r in flat], pa.string()),
                "weight": pa.array([r[2] for r in flat], pa.float64()),
            },
        )

    def _arrays(self, spark: SparkSession, geo: str) -> dict:
        """Weights and means per input. A text input has a weight for each of its codes, the last for any other."""
        coefficients = [float(c) for c in self.models[geo].stages[-1].coefficients]
        means, labels = self.moments[geo][0], self.labels(geo)
        weights, middles, at = [], [], 0
        for f in self.lists[geo]:
            width = self.slots[geo].count(f) if f in labels else 1
            own = coefficients[at : at + width]
            if f in labels:
                known = labels[f] if isinstance(labels[f], int) else len(labels[f])
                weights.append(np.array(own[:known] + [own[known] if width > known else 0.0]))
                middles.append(sum(c * m for c, m in zip(own, means[at : at + width])))
            else:
                weights.append(np.array(own))
                middles.append(means[at])
            at += width
        return {"base": self._base(spark, geo), "weights": weights, "means": middles}


def _slot_names(model: PipelineModel, features: list[str], positions: list[str]) -> list[str]:
    labels = {
        c: list(ls) + ["(other)"]
        for s in model.stages
        if isinstance(s, StringIndexerModel)
        for c, ls in zip(s.getInputCols(), s.labelsArray)
    }
    seen: dict[str, int] = {}
    names = []
    for f in positions:
        k = seen.get(f, 0)
        seen[f] = k + 1
        names.append(f"{f}={labels[f][k]}" if f in labels and k < len(labels[f]) else f)
    return names


def additivity(stage: DataFrame, bases: dict[str, float], tolerance: float = 1e-6) -> DataFrame:
    """Rows per geo, and how many whose contributions do not add up to their log-odds.

    ``stage`` must hold all contributions.
    """
    base = F.lit(None).cast("double")
    for geo, value in bases.items():
        base = F.when(F.col("geo") == geo, value).otherwise(base)
    total = F.aggregate("attributions", base, lambda acc, d: acc + d["contribution"])
    gap = F.abs(total - F.log(F.try_divide(F.col("risk_score"), 1 - F.col("risk_score"))))
    return stage.groupBy("geo").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(gap.isNull() | (gap > tolerance)).alias("n_off")
    )


def balance(scores: DataFrame, facts: dict[str, GeoFacts], tolerance: float = 1e-3) -> DataFrame:
    """Rows per geo, and whether the class-weighted residuals cancel out.

    They do at the optimum of a logistic regression on its training rows, because the intercept
    is not penalised.
    """
    weight = F.lit(None).cast("double")
    for geo, fact in facts.items():
        for label, value in fact.weight.items():
            weight = F.when((F.col("geo") == geo) & (F.col("target") == label), value).otherwise(weight)
    gap = F.sum(weight * (F.col("target") - F.col("risk_score"))) / F.sum(weight)
    return scores.groupBy("geo").agg(F.count(F.lit(1)).alias("n_rows"), (F.abs(gap) < tolerance).alias("balanced"))


def model_inputs(spark: SparkSession, family) -> DataFrame:
    """Inputs of every model as rows (model, feature)."""
    pairs = [(m, f) for m, fs in sorted(family.inputs().items()) for f in fs]
    return local_table(
        spark,
        {"model": pa.array([p[0] for p in pairs], pa.string()), "feature": pa.array([p[1] for p in pairs], pa.string())},
    )
