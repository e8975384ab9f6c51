"""Running totals along a score, for groups of any size.

Ranks, exact percentiles, ROC points and AUC all need totals over "rows with a higher score". A
window over a whole geo would put that geo into one task. Here rows are first aggregated to one
row per distinct score, ranged into blocks by (keys, score), and summed within blocks; the block
totals, a few rows per shuffle partition, supply the offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from riskloom.sources.scratch import fix_small, save_scratch


def score_ladder(
    df: DataFrame, keys: list[str], score: str, sums: dict[str, Column], small_rows: int | None = None
) -> DataFrame:
    """One row per (keys, distinct score), with for every entry ``x`` of ``sums``:

    ``x``        sum over the rows with this score,
    ``x_above``  sum over the rows with a higher score,
    ``x_total``  sum over the whole key group.

    The ranged rows are written once, so that block numbers cannot shift between the two reads.
    With few distinct scores altogether (``small_rows``, see ``fix_small``), one window does.
    """
    steps = (
        df.filter(F.col(score).isNotNull())
        .groupBy(*keys, score)
        .agg(*[F.sum(column).alias(name) for name, column in sums.items()])
    )
    ranged = steps.repartitionByRange(*[F.col(k) for k in keys], F.col(score).desc())
    stored = save_scratch(ranged.withColumn("block", F.spark_partition_id()), "ladder")
    few = fix_small(stored, small_rows)
    return _in_blocks(stored, keys, score, list(sums)) if few is stored else _in_one(few, keys, score, list(sums))


def _before(window: WindowSpec, name: str) -> Column:
    return F.coalesce(F.sum(name).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _in_one(steps: DataFrame, keys: list[str], score: str, names: list[str]) -> DataFrame:
    higher = Window.partitionBy(*keys).orderBy(F.col(score).desc())
    whole = Window.partitionBy(*keys)
    return steps.select(
        *keys,
        score,
        *names,
        *[_before(higher, n).alias(f"{n}_above") for n in names],
        *[F.sum(n).over(whole).alias(f"{n}_total") for n in names],
    )


def _in_blocks(steps: DataFrame, keys: list[str], score: str, names: list[str]) -> DataFrame:
    in_block = Window.partitionBy(*keys, "block").orderBy(F.col(score).desc())
    higher_blocks = Window.partitionBy(*keys).orderBy("block")
    whole = Window.partitionBy(*keys)
    offsets = (
        steps.groupBy(*keys, "block")
        .agg(*[F.sum(n).alias(n) for n in names])
        .select(
            *keys,
            "block",
            *[_before(higher_blocks, n).alias(f"{n}_offset") for n in names],
            *[F.sum(n).over(whole).alias(f"{n}_total") for n in names],
        )
    )
    local = steps.select("*", *[_before(in_block, n).alias(f"{n}_local") for n in names])
    return local.join(offsets, [*keys, "block"]).select(
        *keys,
        score,
        *names,
        *[(F.col(f"{n}_offset") + F.col(f"{n}_local")).alias(f"{n}_above") for n in names],
        *[f"{n}_total" for n in names],
    )


def with_rank(df: DataFrame, keys: list[str], score: str, name: str, small_rows: int | None = None) -> DataFrame:
    """Add RANK by descending score within ``keys`` (ties share a rank, gaps follow).

    ``score`` must come from a stored table or a repeatable expression: rows meet their rank
    again by equality of the score. Few distinct scores are broadcast; with many, AQE splits the
    join partition of a score that very many rows share.
    """
    ladder = score_ladder(df, keys, score, {"n": F.lit(1)}, small_rows)
    ranks = ladder.select(*keys, score, (F.col("n_above") + 1).alias(name))
    return df.join(ranks, [*keys, score], "left").select(*df.columns, name)


def upper_cutoff(score: str, count: str, share_pct: Column) -> Column:
    """Aggregate over a ladder: the lowest score with at most ``share_pct`` % of rows above it.

    This equals the discrete percentile at 100 - share_pct.
    """
    return F.min(F.when(F.col(f"{count}_above") * 100 <= share_pct * F.col(f"{count}_total"), F.col(score)))
