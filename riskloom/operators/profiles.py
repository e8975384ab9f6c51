"""Column profiles kept by month: a month is read when it arrives, and any months add up to one profile.

A month leaves a row per column: counts, the only value if there is one, a sketch of the distinct texts, and
the exact counts of the values that hold 1 / KEPT of its rows. A value that holds a share of some months
together holds that share of one of them at least, so a spike is always among the values kept. Its count in the
months that didn't keep it is below 1 / KEPT of their rows; only where that leaves the verdict open, or the
count of a spike unknown, those months are read again, and of them only that column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from riskloom.functions.drivers import number_text
from riskloom.operators.sketches import COLUMNS_PER_PASS, _text
from riskloom.sources.scratch import save_scratch

KEPT = 16  # the least spike is 1 / KEPT of the rows
TRACKED = 1000  # entries of a sketch: it is off by less than 1 / KEPT of the rows by far
VALUES_PER_PASS = 500
_SCHEMA = (
    "column_name string, n_rows bigint, n_filled bigint, numeric boolean, text boolean, only_value string, distinct_texts binary, "
    "kept array<struct<value: string, n: bigint>>, YEAR_MONTH bigint"
)


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _count_of(df: DataFrame, column: str, value: str, where: str = "true") -> str:
    """Texts of expressions: those of 700 columns would take Python much longer than Spark to plan."""
    return f"count_if({where} AND {_name(column)} = CAST({_text(value)} AS {df.schema[column].dataType.simpleString()}))"


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def month_profiles(df: DataFrame) -> DataFrame:
    """One row per month and column of ``df``; two passes over groups of columns, aggregated inside the tasks.

    The first pass names the values that may hold 1 / KEPT of a month (its sketch never counts too low), the
    second counts them exactly, each in its month. Rows without a month are profiled as month null.
    """
    parts = []
    for at in range(0, len(df.columns), COLUMNS_PER_PASS):
        group = df.columns[at : at + COLUMNS_PER_PASS]
        made = []
        for c in group:
            kind, name = df.schema[c].dataType, _name(c)
            text = isinstance(kind, StringType)
            made.append(
                F.expr(
                    f"""named_struct('column_name', {_text(c)}, 'n_rows', count(1), 'n_filled', count({name}),
                      'numeric', {isinstance(kind, NumericType)}, 'text', {text},
                      'only_value', CASE WHEN min({name}) = max({name}) THEN CAST(min({name}) AS string) END,
                      'distinct_texts', {f"hll_sketch_agg({name}, 12)" if text else "CAST(NULL AS binary)"},
                      'top', CAST(approx_top_k({name}, {KEPT + 2}, {TRACKED}) AS array<struct<item: string, count: bigint>>)) AS profile_{len(made)}"""
                )
            )
        months = df.groupBy(F.col("YEAR_MONTH").cast("bigint").alias("month")).agg(*made)
        pairs = F.array(*[f"profile_{k}" for k in range(len(made))])
        parts.append(months.select(F.col("month").alias("YEAR_MONTH"), F.inline(pairs)))
    likely = F.expr(f"transform(filter(top, t -> t.item IS NOT NULL AND t.count * {KEPT} >= n_rows), t -> t.item)")
    first = save_scratch(_union(parts).withColumn("likely", likely).drop("top"), "profiles")
    slots = {r[0]: r[1] for r in first.groupBy("column_name").agg(F.max(F.size("likely"))).collect()}
    counted = [c for c in df.columns if slots.get(c)]
    parts = []
    for at in range(0, len(counted), COLUMNS_PER_PASS):
        group = counted[at : at + COLUMNS_PER_PASS]
        typed = [
            F.expr(f"transform(max(CASE WHEN column_name = {_text(c)} THEN likely END), v -> CAST(v AS {df.schema[c].dataType.simpleString()})) AS likely_{k}")
            for k, c in enumerate(group)
        ]
        # a row per month, of KEPT values a column at most
        values = first.filter(F.col("column_name").isin(group)).groupBy(F.col("YEAR_MONTH").alias("kept_month")).agg(*typed)
        rows = df.select(F.expr("CAST(YEAR_MONTH AS bigint) AS row_month"), *[F.expr(f"{_name(c)} AS value_{k}") for k, c in enumerate(group)])
        counts = [
            F.expr(f"array({', '.join(f'count_if(value_{k} = get(likely_{k}, {i}))' for i in range(slots[c]))}) AS counts_{k}") for k, c in enumerate(group)
        ]
        months = rows.join(values, F.col("row_month").eqNullSafe(F.col("kept_month"))).groupBy("kept_month").agg(*counts)
        pairs = [f"named_struct('kept_column', {_text(c)}, 'counts', counts_{k})" for k, c in enumerate(group)]
        parts.append(months.selectExpr("kept_month", f"inline(array({', '.join(pairs)}))"))
    none = "CAST(array() AS array<struct<value: string, n: bigint>>)"
    if not parts:
        return first.drop("likely").withColumn("kept", F.expr(none))
    same = F.col("YEAR_MONTH").eqNullSafe(F.col("kept_month")) & (F.col("column_name") == F.col("kept_column"))
    zipped = "transform(likely, (v, i) -> named_struct('value', v, 'n', counts[i]))"
    kept = F.expr(f"CASE WHEN counts IS NULL THEN {none} ELSE {zipped} END")
    return first.join(_union(parts), same, "left").withColumn("kept", kept).drop("kept_month", "kept_column", "counts", "likely")


def store_profiles(df: DataFrame, path: str) -> None:
    """Profile the months in ``df`` and keep them, a folder per month; months that are there are replaced."""
    made = month_profiles(df).repartition("YEAR_MONTH")
    made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("YEAR_MONTH").parquet(path)


def read_profiles(spark, path: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(path)


def merged_profile(profiles: DataFrame, rows: DataFrame | None = None, near_unique_share: float = 0.05, spike_share: float = 0.25) -> DataFrame:
    """Profile of all months in ``profiles`` together, with the columns and meaning of ``column_profile``.

    ``rows`` is the table that was profiled, read for open counts only; without it these stop the call. Shares of
    a column that came later refer to the months that have it.
    """
    if spike_share * KEPT < 1:
        raise ValueError(f"values below 1/{KEPT} of a month aren't kept")
    per_column = profiles.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_filled").alias("n_filled"),
        F.coalesce((F.min("only_value") == F.max("only_value")) & (F.count_if((F.col("n_filled") > 0) & F.col("only_value").isNull()) == 0), F.lit(False)).alias("is_constant"),
        F.max("text").alias("text"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_texts")).alias("n_distinct"),
    )
    known = (
        profiles.select("column_name", "numeric", "YEAR_MONTH", F.col("n_rows").alias("month_rows"), F.inline("kept"))
        .groupBy("column_name", "numeric", "value")
        .agg(F.sum("n").alias("n"), F.sum("month_rows").alias("rows_known"), F.collect_list(F.coalesce("YEAR_MONTH", F.lit(-1))).alias("months_known"))
        .join(per_column.select("column_name", "n_rows"), "column_name")
    )
    bar = F.col("n_rows") * spike_share
    possible = save_scratch(known.filter(F.col("n") + (F.col("n_rows") - F.col("rows_known")) / KEPT >= bar), "spikes")
    open_counts = "rows_known < n_rows AND column_name <> 'YEAR_MONTH'"  # a month stands in no other month
    unread = possible.filter(open_counts).select("column_name", "value", "months_known").orderBy("column_name", "value").collect()
    if unread:
        more = _missing_counts(rows, profiles, unread)
        possible = possible.join(more, ["column_name", "value"], "left").withColumn("n", F.col("n") + F.coalesce("more", F.lit(0))).drop("more")
    order = F.struct("n", F.when(F.col("numeric"), F.expr("try_cast(value AS double)")), "value")
    shown = F.when(F.col("numeric"), number_text(F.col("value"))).otherwise(F.col("value"))
    spikes = possible.filter(F.col("n") >= bar).groupBy("column_name").agg(F.max_by(F.struct(shown.alias("shown"), "n"), order).alias("spike"))
    near = F.col("text") & (F.col("n_distinct") > near_unique_share * F.col("n_rows"))
    reason = F.when(F.col("is_constant"), "Constant").when(F.col("is_near_unique"), "Near-unique code")
    return per_column.join(spikes, "column_name", "left").withColumn("is_near_unique", F.coalesce(near, F.lit(False))).select(
        "column_name",
        "n_rows",
        (F.col("n_rows") - F.col("n_filled")).alias("n_null"),
        "is_constant",
        "is_near_unique",
        F.col("spike.shown").alias("spike_value"),
        F.col("spike.n").alias("spike_rows"),
        reason.alias("proposed_exclusion"),
    )


def _missing_counts(rows: DataFrame | None, profiles: DataFrame, unread: list) -> DataFrame:
    """(column_name, value, more): how often values stand in the months that haven't kept their count."""
    if rows is None:
        raise ValueError("some counts are open: " + ", ".join(f"{r.column_name} = {r.value}" for r in unread[:5]))
    months = {r[0]: set(r[1]) for r in profiles.groupBy("column_name").agg(F.collect_set(F.coalesce("YEAR_MONTH", F.lit(-1)))).collect()}
    parts = []
    for at in range(0, len(unread), VALUES_PER_PASS):
        chunk = unread[at : at + VALUES_PER_PASS]
        wanted = [sorted(months[r.column_name] - set(r.months_known)) for r in chunk]
        some = rows.filter(_month_in(sorted(set().union(*wanted))))
        counts = [F.expr(f"{_count_of(rows, r.column_name, r.value, _month_in(w))} AS n_{k}") for k, (r, w) in enumerate(zip(chunk, wanted))]
        found = [f"named_struct('column_name', {_text(r.column_name)}, 'value', {_text(r.value)}, 'more', n_{k})" for k, r in enumerate(chunk)]
        parts.append(some.agg(*counts).selectExpr(f"inline(array({', '.join(found)}))"))
    return _union(parts)


def _month_in(months: list[int]) -> str:
    """A predicate on the month alone, so that folders are pruned; -1 stands for rows without one."""
    some = [f"YEAR_MONTH IN ({', '.join(str(m) for m in months if m != -1)})"] if set(months) != {-1} else []
    return "(" + " OR ".join(some + (["YEAR_MONTH IS NULL"] if -1 in months else [])) + ")"
