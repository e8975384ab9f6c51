"""Feature selection from configuration: model-ready columns, flags, guard list, lists per geo."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.errors import ConfigError
from riskloom.functions.dates import days_before, month_end, text_to_date
from riskloom.sources.files import column_table
from riskloom.sources.scratch import collect_config, local_table

# Date columns of the HR feature store.
HR_DATE_COLUMNS = [
    "EMP_ACTION_DATE",
    "DV_WEEK_EMP_ACTION_DATE",
    "DV_EMP_RECENT_DATE_JOINING",
    "DV_MONTHS_EMP_ACTION_DATE",
    "DV_DAY_EMP_ACTION_DATE",
    "DV_EMP_COMPANY_SENIORITY_DATE",
    "DV_WDAY_EMP_RECENT_DATE_JOINING",
    "DV_WDAY_EMP_ACTION_DATE",
    "DV_WEEK_EMP_ORGINSTANCE_SERVICE_DATE",
    "DV_DAY_EMP_RECENT_DATE_JOINING",
]

# Guard list of the HR feature store.
HR_EXCLUSIONS = [
    ("target", "Label"),
    ("GEO", "Geo selector"),
    ("YEAR_MONTH", "Snapshot key"),
    ("DV_EMP_MTH_YEAR_MONTH", "Duplicate of YEAR_MONTH"),
    ("EMP_ID", "Identifier"),
    ("EMP_PROJECT_ID", "Identifier"),
    ("EMP_SUPERVISOR_ID", "Identifier"),
    ("EMP_SUB_PROGRAM_ID", "Identifier"),
    ("EMP_PROJECT_MANAGER_ID", "Identifier"),
    ("EMP_LAST_ACTION_REASON", "Near-unique code"),
    ("EMP_LAST_ACTION", "Near-unique code"),
    ("EMP_STATE", "Near-unique code"),
    ("EMP_DESIGNATION", "Near-unique code"),
    ("EMP_COMPANY", "Near-unique code"),
    ("EMP_TYPE", "Near-unique code"),
    ("EMP_VERTICAL", "Near-unique code"),
    ("DV_EMP_DOJ", "Near-unique code"),
    ("EMP_REGULAR_TEMP", "Constant"),
    ("EMP_JOB_CODE", "Constant"),
    ("EMP_MEDIUM", "Constant"),
    ("EMP_TEAM_CODE", "Constant"),
]


def model_features(feature_store: DataFrame, date_columns: list[str] = HR_DATE_COLUMNS) -> DataFrame:
    """Dates become days before the snapshot's month end under the same name.

    ``date_columns`` comes from a feature dictionary (see ``date_columns_of``), so nothing has to
    be written by hand when a date feature arrives. A store without GEO gets a NULL one.
    """
    end = month_end(F.col("YEAR_MONTH"))
    days = {c: days_before(end, text_to_date(F.col(c).cast("string"))) for c in date_columns}
    if "GEO" not in feature_store.columns:
        days["GEO"] = F.lit(None).cast("string")
    return feature_store.withColumns(days)


def date_columns_of(dictionary: DataFrame) -> list[str]:
    """Date features named by a dictionary with columns (feature, role)."""
    rows = dictionary.filter(F.col("role") == "date").select("feature").orderBy("feature")
    return [r.feature for r in collect_config(rows)]


def geo_names(geo_config: DataFrame) -> list[str]:
    """Configured geos in order."""
    return [r.GEO for r in collect_config(geo_config.select("GEO").distinct().orderBy("GEO"))]


def feature_flags(feature_config: DataFrame, geos: list[str]) -> DataFrame:
    """Wide 0/1 columns to rows (feature, geo, flag); empty flags are dropped."""
    missing = [g for g in geos if g not in feature_config.columns]
    if missing:
        raise ConfigError(f"No column in feature_config for geo {', '.join(missing)}")
    typed = feature_config.select(
        F.col("MODEL_FEATURES").alias("feature"), *[F.col(g).cast("long").alias(g) for g in geos]
    )
    return typed.unpivot(["feature"], geos, "geo", "flag").filter(F.col("flag").isNotNull())


def feature_exclusions(spark: SparkSession, rows: list[tuple[str, str]] = HR_EXCLUSIONS) -> DataFrame:
    """Columns that are never model inputs, with the reason."""
    return local_table(
        spark,
        {"feature": pa.array([r[0] for r in rows], pa.string()), "reason": pa.array([r[1] for r in rows], pa.string())},
    )


def selected_features(flags: DataFrame, features: DataFrame, exclusions: DataFrame) -> DataFrame:
    """(geo, feature) pairs that are flagged, present in the data and not excluded."""
    present = column_table(features, "model_features").select(F.col("column_name").alias("feature"))
    return (
        flags.filter(F.col("flag") == 1)
        .join(present, "feature", "left_semi")
        .join(exclusions, "feature", "left_anti")
        .select("geo", "feature")
    )


def geo_feature_list(selected: DataFrame) -> DataFrame:
    """One row per geo: number of features and the ordered list."""
    return selected.groupBy("geo").agg(
        F.count(F.lit(1)).alias("n_features"),
        F.array_join(F.sort_array(F.collect_list("feature")), ", ").alias("feature_list"),
    )


def feature_lists(selected: DataFrame) -> dict[str, list[str]]:
    """The lists as Python values, for building projections. Size: geos x configured columns."""
    lists = selected.groupBy("geo").agg(F.sort_array(F.collect_list("feature")).alias("features"))
    return {r.geo: r.features for r in collect_config(lists.orderBy("geo"))}


def set_flag(feature_config: DataFrame, feature: str, geo: str, value: int) -> DataFrame:
    """Change one flag."""
    return feature_config.withColumn(
        geo, F.when(F.col("MODEL_FEATURES") == feature, F.lit(value).cast("long")).otherwise(F.col(geo))
    )


def add_geo_column(feature_config: DataFrame, geo: str, like: str | None = None) -> DataFrame:
    """Add a geo column: a copy of another geo's flags, or all zero."""
    return feature_config.withColumn(geo, F.col(like) if like else F.lit(0).cast("long"))


def drop_geo_column(feature_config: DataFrame, geo: str) -> DataFrame:
    return feature_config.drop(geo)


def insert_rows(config: DataFrame, columns: dict[str, pa.Array]) -> DataFrame:
    """Add literal rows to a config table."""
    return config.unionByName(local_table(config.sparkSession, columns), allowMissingColumns=True)


def delete_rows(config: DataFrame, condition) -> DataFrame:
    """Remove the rows that match; a row whose condition is unknown stays."""
    return config.filter(~F.coalesce(condition, F.lit(False)))


def update_by_key(config: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Overwrite the columns of ``changes`` in the rows with the same key."""
    columns = [c for c in changes.columns if c != key]
    renamed = changes.select(key, F.lit(True).alias("_changed"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = config.join(renamed, key, "left")
    return joined.select(
        *[
            F.when(F.col("_changed"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in config.columns
        ]
    )


def bucket_config(geos: DataFrame) -> DataFrame:
    """Default RED / AMBER rule for every geo."""
    return geos.select(
        F.col("GEO").alias("geo"),
        F.lit("PERCENTILE").alias("method"),
        F.lit(10).cast("long").alias("red_top_pct"),
        F.lit(20).cast("long").alias("amber_next_pct"),
        F.lit(0.70).alias("red_threshold"),
        F.lit(0.40).alias("amber_threshold"),
    )


def config_problems(geos: DataFrame, selected: DataFrame, rules: DataFrame) -> DataFrame:
    """Geos without any feature or without a bucket rule, one row per problem."""
    wanted = geos.select(F.col("GEO").alias("geo")).distinct()
    no_features = wanted.join(selected, "geo", "left_anti").select(
        "geo", F.concat(F.lit("No features resolved for geo "), F.col("geo"), F.lit(" - check feature_config")).alias("problem")
    )
    no_rule = wanted.join(rules, "geo", "left_anti").select(
        "geo", F.concat(F.lit("No bucket rule for geo "), F.col("geo"), F.lit(" - check risk_bucket_config")).alias("problem")
    )
    return no_features.unionByName(no_rule)


def config_guard(geos: DataFrame, selected: DataFrame, rules: DataFrame) -> None:
    """Check every geo before anything is trained or written."""
    found = collect_config(config_problems(geos, selected, rules).orderBy("geo", "problem"))
    if found:
        raise ConfigError("; ".join(r.problem for r in found))


def list_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Feature lists (geo, feature) of two configurations, compared per geo: sizes, and whether they are the same.

    A full outer join of the pairs; a geo that only one side knows has the size 0 on the other.
    """
    pair = ["geo", "feature"]
    old = before.select(*pair).distinct().withColumn("was", F.lit(True))
    new = after.select(*pair).distinct().withColumn("is", F.lit(True))
    both = F.col("was").isNotNull() & F.col("is").isNotNull()
    return old.join(new, pair, "full").groupBy("geo").agg(
        F.count("was").alias("n_before"), F.count("is").alias("n_after"), F.bool_and(both).alias("unchanged")
    )
