"""Business scenarios on copies of the configuration, as check rows."""

from __future__ import annotations

from dataclasses import replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.errors import ConfigError
from riskloom.models.prepare import rows_of_geo
from riskloom.operators.checks import literal_rows
from riskloom.operators.features import (
    add_geo_column,
    delete_rows,
    drop_geo_column,
    feature_lists,
    insert_rows,
    list_changes,
    set_flag,
)
from riskloom.operators.routing import route_to_geos
from riskloom.plans.inputs import Inputs
from riskloom.plans.monthly import monthly_run
from riskloom.sources.tables import read_table


def _filled(df: DataFrame, columns: list[str]) -> Column:
    return F.aggregate(F.array(*[F.count(c) for c in columns]), F.lit(0).cast("long"), lambda total, n: total + n)


def flag_off(inputs: Inputs, feature: str, geo: str, other: str) -> DataFrame:
    """M101-M106: switch a feature off for one geo and on again; M107: what its model input loses."""
    before = feature_lists(inputs.selected())
    off = replace(inputs, feature_config=set_flag(inputs.feature_config, feature, geo, 0))
    after = feature_lists(off.selected())
    back = replace(off, feature_config=set_flag(off.feature_config, feature, geo, 1))
    restored = feature_lists(back.selected())
    n = len(before[geo])
    own = rows_of_geo(inputs.features(), geo)
    sizes = own.agg(
        _filled(own, before[geo]).alias("full"), _filled(own, after[geo]).alias("rest"), F.count(feature).alias("one")
    ).first()
    return literal_rows(
        inputs.store.sparkSession,
        [
            ("M101", f"{geo} features before", str(n), str(len(before[geo]))),
            ("M102", f"{geo} features with {feature} off", str(n - 1), str(len(after[geo]))),
            ("M103", f"{feature} still listed for {geo}", "false", str(feature in after[geo]).lower()),
            ("M104", f"{other} features unchanged", str(len(before[other])), str(len(after[other]))),
            ("M105", f"{geo} features after switching back", str(n), str(len(restored[geo]))),
            ("M106", f"{feature} listed again for {geo}", "true", str(feature in restored[geo]).lower()),
            ("M107", f"values {geo}'s model input loses", str(sizes["one"]), str(sizes["full"] - sizes["rest"])),
        ],
    )


def new_geo(inputs: Inputs, geo: str, like: str) -> DataFrame:
    """M201-M207: a geo goes live by configuration only and leaves again; M208: rows it would score."""
    spark = inputs.store.sparkSession
    before = feature_lists(inputs.selected())
    rule = inputs.rules.filter(F.col("geo") == like).withColumn("geo", F.lit(geo))
    grown = replace(
        inputs,
        feature_config=add_geo_column(inputs.feature_config, geo, like),
        geo_config=insert_rows(inputs.geo_config, {"GEO": pa.array([geo], pa.string())}),
        rules=inputs.rules.unionByName(rule),
    )
    after = grown.checked_lists()
    shrunk = replace(
        grown,
        feature_config=drop_geo_column(grown.feature_config, geo),
        geo_config=delete_rows(grown.geo_config, F.col("GEO") == geo),
        rules=delete_rows(grown.rules, F.col("geo") == geo),
    )
    restored = shrunk.checked_lists()
    lists = grown.selected()
    named = lambda g: lists.filter(F.col("geo") == g).withColumn("geo", F.lit(geo))
    same = list_changes(named(like), named(geo)).first()
    flags = shrunk.feature_config.count() * len(restored)
    homeless = inputs.features().select("EMP_ID", F.lit(None).cast("string").alias("GEO"))
    routed = route_to_geos(homeless, sorted(after)).agg(
        F.count(F.lit(1)).alias("all"), F.count_if(F.col("geo") == geo).alias("own")
    ).first()
    expected_flags = inputs.feature_config.count() * len(before)
    return literal_rows(
        spark,
        [
            ("M201", "geos before", str(inputs.geo_config.count()), str(len(before))),
            ("M202", f"geos with {geo}", str(len(before) + 1), str(len(after))),
            ("M203", f"{geo} features", str(len(before[like])), str(len(after.get(geo, [])))),
            ("M204", f"{geo} list equals {like}", "true", str(bool(same and same.unchanged)).lower()),
            ("M205", f"{like} unchanged", str(len(before[like])), str(len(after[like]))),
            ("M206", "geos after removal", str(len(before)), str(len(restored))),
            ("M207", "flags after removal", str(expected_flags), str(flags)),
            ("M208", f"rows without a geo that reach {geo}", str(routed["all"] // len(after)), str(routed["own"])),
        ],
    )


def rerun(inputs: Inputs, month: int, family, warehouse: str) -> DataFrame:
    """M301-M305: running a month again replaces its output."""
    spark = inputs.store.sparkSession
    monthly_run(inputs, month, family, warehouse)
    in_month = F.col("YEAR_MONTH") == month
    first = read_table(spark, warehouse, "ews_employee_risk").filter(in_month).count()
    second = monthly_run(inputs, month, family, warehouse)

    def look(table: str, keys: list[str]) -> tuple[int, int, int]:
        per_key = read_table(spark, warehouse, table).filter(in_month).groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("scored_at") < F.lit(second.started_at)).alias("old")
        )
        one = per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra"),
            F.coalesce(F.sum("old"), F.lit(0)).alias("old"),
        ).first()
        return one["n"], one["extra"], one["old"]

    employee = look("ews_employee_risk", ["geo", "EMP_ID"])
    variable = look("ews_variable_risk", ["geo", "EMP_ID", "feature"])
    drivers = look("ews_geo_drivers", ["geo", "feature"])
    return literal_rows(
        spark,
        [
            ("M301", "employee rows after the second run", str(first), str(employee[0])),
            ("M302", "repeated (geo, EMP_ID)", "0", str(employee[1])),
            ("M303", "repeated (geo, EMP_ID, feature)", "0", str(variable[1])),
            ("M304", "repeated (geo, feature)", "0", str(drivers[1])),
            ("M305", "rows of the first run left", "0", str(employee[2] + variable[2] + drivers[2])),
        ],
    )


def config_error(inputs: Inputs, geo: str, month: int, family, warehouse: str) -> DataFrame:
    """M401-M403: a geo without features stops the run before anything is written."""
    spark = inputs.store.sparkSession
    before = _rows_written(spark, warehouse)
    broken = replace(
        inputs,
        feature_config=add_geo_column(inputs.feature_config, geo),
        geo_config=insert_rows(inputs.geo_config, {"GEO": pa.array([geo], pa.string())}),
    )
    try:
        monthly_run(broken, month, family, warehouse)
        message = "(no error raised)"
    except ConfigError as error:
        message = str(error)
    wanted = f"No features resolved for geo {geo}"
    return literal_rows(
        spark,
        [
            ("M401", "run stopped by a configuration error", f"contains: {wanted}", message, wanted in message),
            ("M402", "rows in the output tables", str(before), str(_rows_written(spark, warehouse))),
            ("M403", "geos of the unchanged configuration", str(inputs.geo_config.count()), str(len(inputs.checked_lists()))),
        ],
    )


def _rows_written(spark, warehouse: str) -> int:
    tables = ("ews_employee_risk", "ews_variable_risk", "ews_geo_drivers")
    return sum(read_table(spark, warehouse, t).count() for t in tables)
