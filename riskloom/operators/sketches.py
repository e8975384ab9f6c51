"""Drift between any two months from stored quantile sketches.

A month is read once, when it arrives: every numeric column leaves a KLL sketch of some ten kilobytes. Months
are compared, and put together to longer periods, by merging sketches; their rows aren't read again.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.drift import EPSILON
from riskloom.sources.scratch import save_scratch

K = 2048  # the error of a rank is about 0.1 %; months of up to some K values are held exactly
COLUMNS_PER_PASS = 100


def month_sketches(df: DataFrame, columns: list[str], k: int = K) -> DataFrame:
    """(YEAR_MONTH, feature, n_rows, n_filled, sketch) of the months in ``df``.

    Sketches are built inside the tasks and merged; a column without values has none. NaN counts as empty.
    Groups of columns are read one after another, so that a task holds at most COLUMNS_PER_PASS sketches a month.
    """
    parts = []
    for at in range(0, len(columns), COLUMNS_PER_PASS):
        group = columns[at : at + COLUMNS_PER_PASS]
        numbers = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in group}
        rows = df.select("YEAR_MONTH", *[numbers[c].alias(c) for c in group])
        made = [F.struct(F.count(c).alias("n_filled"), F.kll_sketch_agg_double(c, k).alias("sketch")).alias(c) for c in group]
        months = rows.groupBy("YEAR_MONTH").agg(F.count(F.lit(1)).alias("n_rows"), *made)
        pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}.n_filled").alias("n_filled"), F.col(f"{c}.sketch").alias("sketch")) for c in group])
        parts.append(months.select("YEAR_MONTH", "n_rows", F.inline(pairs)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("YEAR_MONTH", "feature", "n_rows", "n_filled", F.when(F.col("n_filled") > 0, F.col("sketch")).alias("sketch"))


def store_sketches(df: DataFrame, columns: list[str], path: str) -> None:
    """Sketch the months in ``df`` and keep them, a folder per month; months that are there are replaced."""
    made = month_sketches(df, columns).repartition("YEAR_MONTH")
    made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("YEAR_MONTH").parquet(path)


def read_sketches(spark, path: str) -> DataFrame:
    schema = "feature string, n_rows bigint, n_filled bigint, sketch binary, YEAR_MONTH bigint"
    return spark.read.schema(schema).parquet(path)


def merged(sketches: DataFrame, months: list[int]) -> DataFrame:
    """One row per feature for a period: the sum of its months."""
    some = sketches.filter(F.col("YEAR_MONTH").isin(months))
    return some.groupBy("feature").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_filled").alias("n_filled"), F.kll_merge_agg_double(F.col("sketch"), K).alias("sketch")
    )


def quantile_drift(sketches: DataFrame, base: list[int], now: list[int], bins: int = 10) -> DataFrame:
    """Population stability index per feature between two periods, over bins of equal share of the base period.

    Empty values are a bin of their own. Shares come from ranks, so a share is off by twice the sketch's error
    at most; a value that fills several bins is one.
    """
    shares = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    old = merged(sketches, base).select("feature", F.col("n_rows").alias("n_base"), F.col("n_filled").alias("f_base"), F.col("sketch").alias("s_base"))
    new = merged(sketches, now).select("feature", F.col("n_rows").alias("n_now"), F.col("n_filled").alias("f_now"), F.col("sketch").alias("s_now"))
    both = save_scratch(old.join(new, "feature"), "sketches")
    cuts = both.filter("f_base > 0").select("feature", F.array_sort(F.array_distinct(F.kll_sketch_get_quantile_double("s_base", shares))).alias("cuts"))
    both = both.drop("s_base", "s_now").join(_ranks(both, {r.feature: r.cuts for r in cuts.collect()}), "feature", "left")  # bins - 1 numbers a feature

    def parts(ranks: str, filled: str, whole: str):
        """Shares of the bins, the empty values last."""
        some = F.col(filled) > 0
        edges = F.concat(F.array(F.lit(0.0)), ranks, F.array(F.when(some, 1.0).otherwise(0.0)))
        between = F.transform(F.slice(edges, F.lit(2), F.size(edges) - 1), lambda r, i: (r - F.get(edges, i)) * F.col(filled) / F.col(whole))
        unsplit = F.array(F.col(filled) / F.col(whole))  # nothing to cut by
        empty = F.array((F.col(whole) - F.col(filled)) / F.col(whole))
        return F.transform(F.concat(F.coalesce(between, unsplit), empty), lambda x: F.greatest(x, F.lit(EPSILON)))

    both = both.withColumns({"p": parts("r_base", "f_base", "n_base"), "q": parts("r_now", "f_now", "n_now")})
    psi = F.aggregate(F.zip_with("p", "q", lambda p, q: (q - p) * F.log(q / p)), F.lit(0.0), lambda total, x: total + x)
    return both.select("feature", "n_base", "n_now", psi.alias("psi"))


def _ranks(both: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """(feature, r_base, r_now): ranks of each feature's cuts in both sketches.

    Spark takes cuts as constants only, so sketches come to stand side by side in one row, of some megabytes.
    """
    names = sorted(cuts)
    if not names:
        return both.select("feature", *[F.lit(None).cast("array<double>").alias(c) for c in ("r_base", "r_now")]).limit(0)
    place = F.expr(f"array_position(array({', '.join(map(_text, names))}), feature) - 1").alias("place")
    held = both.select(place, "s_base", "s_now").filter("place >= 0")
    one = held.agg(*[F.expr(f"max(CASE WHEN place = {k} THEN {s} END) AS {s}_{k}") for k in range(len(names)) for s in ("s_base", "s_now")])

    def ranks(sketch: str, name: str) -> str:
        places = ", ".join(_number(x) for x in cuts[name])
        return f"coalesce(kll_sketch_get_rank_double({sketch}, array({places})), array_repeat(0D, {len(cuts[name])}))"

    rows = [f"named_struct('feature', {_text(f)}, 'r_base', {ranks(f's_base_{k}', f)}, 'r_now', {ranks(f's_now_{k}', f)})" for k, f in enumerate(names)]
    return one.selectExpr(f"inline(array({', '.join(rows)}))")


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _number(value: float) -> str:
    return f"{value!r}D" if math.isfinite(value) else f"double('{value}')"
