"""Challengers: one pooled model for all geos, and a small parameter search on the time split."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.models.families import TrainingRows, TreeFamily
from riskloom.operators.evaluate import evaluate
from riskloom.operators.routing import backtest_rows
from riskloom.plans.inputs import Inputs
from riskloom.sources.scratch import save_scratch

POOL = "ALL"


def pooled_challenger(inputs: Inputs, path: str, train_end: int, eval_end: int, **params) -> DataFrame:
    """TEST metrics per geo of one model fitted on all geos, with the geo as an input.

    Its inputs are the features that every geo may use.
    """
    lists = inputs.checked_lists()
    shared = sorted(set.intersection(*map(set, lists.values())))
    rows = inputs.features().withColumn("HOME_GEO", F.col("GEO")).withColumn("GEO", F.lit(POOL))
    family = TreeFamily(path, **params)
    family.fit(backtest_rows(rows, train_end, eval_end), {POOL: [*shared, "HOME_GEO"]})
    family.raise_errors()
    test = rows.filter(F.col("target").isNotNull() & (F.col("YEAR_MONTH") > eval_end))
    scores = save_scratch(family.score(test, carry=("HOME_GEO",)).drop("geo").withColumnRenamed("HOME_GEO", "geo"), "pooled")
    return evaluate(scores.withColumn("model_family", F.lit("pooled")))


def search_rows(inputs: Inputs, train_end: int, eval_end: int) -> TrainingRows:
    """The encoded TRAIN rows, for one or more searches; to be closed after them."""
    rows = backtest_rows(inputs.features(), train_end, eval_end)
    return TrainingRows(rows.filter(~F.col("is_eval")), inputs.checked_lists())


def search(
    inputs: Inputs, path: str, grid: list[dict], rounds: list[int], train_end: int, eval_end: int, shared: TrainingRows | None = None
) -> DataFrame:
    """EVAL metrics per geo of each parameter set and number of rounds, best AUC first within a geo.

    Fits see TRAIN only, without early stopping, so that the EVAL months stay unseen. A set is fitted once,
    with the largest number of rounds; what fewer rounds would have said is read from the same trees, all
    numbers in one pass over the EVAL rows. All sets are fitted on the same encoded rows, those of ``shared``
    (see ``search_rows``) if it is given.
    """
    held = backtest_rows(inputs.features(), train_end, eval_end).filter("is_eval").drop("is_eval")
    training = shared or search_rows(inputs, train_end, eval_end)
    try:
        scored = _scored(training, held, path, grid, sorted(rounds))
    finally:
        if not shared:
            training.close()
    trials = evaluate(reduce(DataFrame.unionByName, scored))
    return trials.withColumnRenamed("model_family", "params").orderBy("geo", F.desc("roc_auc"))


def _scored(training: TrainingRows, held: DataFrame, path: str, grid: list[dict], rounds: list[int]) -> list[DataFrame]:
    """Written scores of the EVAL rows by each parameter set, for each number of rounds."""
    scored = []
    for number, params in enumerate(grid):
        family = TreeFamily(f"{path}/{number}", rounds=rounds[-1], early_stop=False, **params)
        family.fit(training.history, training.lists, training)
        family.raise_errors()
        labels = F.lit([json.dumps({**params, "rounds": n}, sort_keys=True) for n in rounds])
        staged = save_scratch(family.staged_scores(held, rounds), "staged")
        each = F.inline(F.arrays_zip(labels.alias("model_family"), F.col("risk_scores").alias("risk_score")))
        scored.append(staged.select("geo", "EMP_ID", "YEAR_MONTH", "target", each))
    return scored
