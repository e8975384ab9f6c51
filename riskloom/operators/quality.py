"""Data quality in front of training: keys, dates, columns, labels."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType

from riskloom.errors import QualityError
from riskloom.functions.dates import days_before, month_end, text_to_date
from riskloom.functions.drivers import number_text
from riskloom.sources.scratch import fix_small, local_table, save_scratch

KEY = ["EMP_ID", "YEAR_MONTH"]


def duplicate_keys(df: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Keys that occur more than once, counted with map-side combining."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_copies")).filter(F.col("n_copies") > 1)


def quarantine(df: DataFrame, keys: list[str] = KEY) -> tuple[DataFrame, DataFrame]:
    """Split rows into (unique key, repeated key). No row of a repeated key is trusted.

    Repeated keys are counted first and joined back, so that a key with very many copies is
    never gathered in one task: a short list of keys is broadcast, a long one is joined by
    shuffle, where AQE splits a skewed key.
    """
    repeated = fix_small(duplicate_keys(df, keys))
    return df.join(repeated, keys, "left_anti"), df.join(repeated, keys, "inner")


def quality_gate(df: DataFrame, required: list[str], newest_month: int) -> DataFrame:
    """Row count, duplicate keys, empty required columns, freshness: one row per rule."""
    per_key = df.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required],
    )
    one = per_key.agg(
        F.sum("n").alias("rows"),
        F.count_if(F.col("n") > 1).alias("dup"),
        F.max("YEAR_MONTH").alias("newest"),
        *[F.sum(f"null_{c}").alias(f"null_{c}") for c in required],
    )
    rules = [
        ("rows present", F.coalesce("rows", F.lit(0)), F.coalesce("rows", F.lit(0)) > 0),
        ("duplicate keys", F.col("dup"), F.col("dup") == 0),
        ("newest month", F.col("newest"), F.coalesce(F.col("newest") >= newest_month, F.lit(False))),
        *[(f"empty {c}", F.col(f"null_{c}"), F.col(f"null_{c}") == 0) for c in required],
    ]
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(rule).alias("rule"),
                        observed.cast("long").alias("observed"),
                        F.when(ok, "PASS").otherwise("FAIL").alias("status"),
                    )
                    for rule, observed, ok in rules
                ]
            )
        )
    )


def gate_required(month: DataFrame, required: tuple[str, ...]) -> None:
    """Stop with an error if a required column of the month has empty values."""
    empty = month.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).first().asDict()
    found = [f"{n} rows without {c}" for c, n in empty.items() if n]
    if found:
        raise QualityError(", ".join(found))


def leakage_scan(feature_store: DataFrame, date_columns: list[str]) -> DataFrame:
    """Per date column: values after the snapshot, values that cannot be read, empty values."""
    end = month_end(F.col("YEAR_MONTH"))
    measures = []
    for c in date_columns:
        days = days_before(end, text_to_date(F.col(c)))
        measures += [
            F.count(c).alias(f"filled_{c}"),
            F.count_if(days < 0).alias(f"after_{c}"),
            F.count_if(F.col(c).isNotNull() & days.isNull()).alias(f"unread_{c}"),
        ]
    one = feature_store.agg(F.count(F.lit(1)).alias("n"), *measures)
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.col("n").alias("n_rows"),
                        F.col(f"filled_{c}").alias("n_filled"),
                        F.col(f"after_{c}").alias("n_after_snapshot"),
                        F.col(f"unread_{c}").alias("n_unreadable"),
                        (F.col(f"after_{c}") > 0).alias("leaks"),
                    )
                    for c in date_columns
                ]
            )
        )
    )


def column_profile(df: DataFrame, near_unique_share: float = 0.05, spike_share: float = 0.25, tracked: int = 1000) -> DataFrame:
    """Per column: empty values, constant, near-unique text, and a dominating value with its count.

    One pass of mergeable sketches names the values that may hold ``spike_share`` of the rows (the
    sketch never counts too low), a second pass counts only these exactly. Both passes return one
    row, whatever the size of the table.
    """
    text = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    one = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(c).alias(f"filled_{c}") for c in df.columns],
        *[(F.min(c) == F.max(c)).alias(f"constant_{c}") for c in df.columns],
        *[F.hll_sketch_estimate(F.hll_sketch_agg(c, 12)).alias(f"distinct_{c}") for c in df.columns if c in text],
        *[F.expr(f"approx_top_k(`{c}`, {int(1 / spike_share) + 1}, {tracked})").alias(f"top_{c}") for c in df.columns],
    ).first()
    n = one["n"]
    likely = [
        (c, t["item"])
        for c in df.columns
        for t in one[f"top_{c}"]
        if t["item"] is not None and t["count"] >= spike_share * n
    ]
    found = df.agg(
        F.lit(0),
        *[F.count_if(F.col(c) == F.lit(v)) for c, v in likely],
        *[_shown(F.lit(v).cast(df.schema[c].dataType), df.schema[c].dataType) for c, v in likely],
    ).first()[1:]
    spikes: dict[str, tuple] = {}
    for (c, value), count, shown in zip(likely, found, found[len(likely) :]):
        if count >= spike_share * n and (c not in spikes or (count, value) > spikes[c][:2]):
            spikes[c] = (count, value, shown)
    rows = []
    for c in df.columns:
        count, _, shown = spikes.get(c, (None, None, None))
        constant = bool(one[f"constant_{c}"])
        near_unique = c in text and one[f"distinct_{c}"] > near_unique_share * n
        reason = "Constant" if constant else "Near-unique code" if near_unique else None
        rows.append((c, n, n - one[f"filled_{c}"], constant, near_unique, shown, count, reason))
    names = {
        "column_name": pa.string(),
        "n_rows": pa.int64(),
        "n_null": pa.int64(),
        "is_constant": pa.bool_(),
        "is_near_unique": pa.bool_(),
        "spike_value": pa.string(),
        "spike_rows": pa.int64(),
        "proposed_exclusion": pa.string(),
    }
    return local_table(df.sparkSession, {k: pa.array([r[i] for r in rows], t) for i, (k, t) in enumerate(names.items())})


def _shown(value: Column, kind: DataType) -> Column:
    """Numbers by ``number_text``, everything else as Spark writes it."""
    return number_text(value) if isinstance(kind, NumericType) else value.cast("string")


def target_correlation(df: DataFrame, features: list[str]) -> DataFrame:
    """Correlation of each numeric feature with the label, in one pass."""
    one = df.filter(F.col("target").isNotNull()).agg(
        *[F.corr(F.col(c).cast("double"), F.col("target").cast("double")).alias(c) for c in features]
    )
    return one.unpivot([], features, "feature", "correlation").filter(F.col("correlation").isNotNull())


def feature_fill(df: DataFrame, flags: DataFrame, features: list[str]) -> DataFrame:
    """Flags next to the data they select: rows and filled values per geo and feature."""
    counted = df.groupBy(F.col("GEO").alias("geo")).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(f"filled_{c}") for c in features]
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(f"filled_{c}").alias("n_filled")) for c in features]
    )
    return flags.join(counted.select("geo", "n_rows", F.inline(pairs)), ["geo", "feature"], "left")


def map_codes(df: DataFrame, column: str, families: DataFrame, unknown: str = "OTHER") -> DataFrame:
    """Replace a near-unique code by its family. ``families`` has columns (code, family)."""
    joined = df.join(fix_small(families).withColumnRenamed("code", column), column, "left")
    return joined.withColumn(column, F.coalesce("family", F.lit(unknown))).drop("family").select(*df.columns)


def learn_families(df: DataFrame, column: str, min_rows: int, max_length: int = 32) -> DataFrame:
    """(code, n_rows, family) for every code: families are beginnings that stand for enough rows.

    A code of ``min_rows`` rows is a family. The rows of all others are rolled up, a character at a time, to the
    beginning that they share, until that holds ``min_rows``; what is left at the end has the family ''. So a family
    never holds the rows of a longer one. Only rows per code are shuffled, and every level but those of the
    codes left reads less. Codes beyond ``max_length`` characters count by their beginning.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.substring(column, 1, max_length).alias("code")).agg(F.count(F.lit(1)).alias("n_rows"))
    left = save_scratch(counts, "codes")
    length = left.agg(F.max(F.length("code"))).first()[0] or 0
    found = []
    for size in range(length, 0, -1):
        reach = left.withColumn("family", F.substring("code", 1, size))
        enough = reach.groupBy("family").agg(F.sum("n_rows").alias("rows")).filter(F.col("rows") >= min_rows).select("family")
        enough = save_scratch(enough, "families")
        if enough.isEmpty():
            continue
        found.append(save_scratch(reach.join(enough, "family").select("code", "n_rows", "family"), "learnt"))
        left = save_scratch(reach.join(enough, "family", "left_anti").select("code", "n_rows"), "codes")
    out = left.withColumn("family", F.lit(""))
    for part in found:
        out = out.unionByName(part)
    return out


def fairness_rates(predictions: DataFrame, group: str) -> DataFrame:
    """Bucket shares and real event rates per group, against the whole population."""
    flagged = F.col("risk_bucket").isin("RED", "AMBER")
    per_group = predictions.groupBy("geo", group).agg(
        F.count(F.lit(1)).alias("employees"),
        F.avg(F.when(F.col("risk_bucket") == "RED", 1.0).otherwise(0.0)).alias("red_share"),
        F.avg(F.when(flagged, 1.0).otherwise(0.0)).alias("flagged_share"),
        F.avg("target").alias("event_rate"),
        F.avg(F.when(flagged, F.col("target"))).alias("flagged_hit_rate"),
        F.avg(F.when((F.col("target") == 0), F.when(flagged, 1.0).otherwise(0.0))).alias("false_alarm_rate"),
    )
    per_geo = Window.partitionBy("geo")  # one row per group value
    return per_group.withColumn("red_share_gap", F.col("red_share") - F.min("red_share").over(per_geo))
