"""Check suites: rows (test_id, scenario, expected, observed, status).

Every table is aggregated in one pass to one row, from which its checks are read. ``pinned``
holds the expected text of checks whose value depends on the data; a check without one is
reported as INFO.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.dates import text_to_date
from riskloom.operators.quality import duplicate_keys
from riskloom.sources.files import column_table
from riskloom.sources.scratch import local_table

NOT_PINNED = "INFO: no expected value given"


def text(value) -> Column:
    return (value if isinstance(value, Column) else F.col(value)).cast("string")


def status_of(expected: Column, observed: Column, ok: Column) -> Column:
    return (
        F.when(expected.startswith("INFO"), "INFO")
        .when(ok.isNotNull(), F.when(ok, "PASS").otherwise("FAIL"))
        .when(expected == observed, "PASS")
        .otherwise("FAIL")
    )


def rows(one: DataFrame, *checks: tuple) -> DataFrame:
    """Check rows from a one-row table. A check is (id, scenario, expected, observed[, ok])."""
    built = []
    for test_id, scenario, expected, observed, *ok in checks:
        built.append(
            F.struct(
                F.lit(test_id).alias("test_id"),
                F.lit(scenario).alias("scenario"),
                (expected if isinstance(expected, Column) else F.lit(expected)).alias("expected"),
                observed.alias("observed"),
                (ok[0] if ok else F.lit(None).cast("boolean")).alias("ok"),
            )
        )
    return one.select(F.inline(F.array(*built)))


def suite(*parts: DataFrame) -> DataFrame:
    """Put the rows of several tables together and judge them."""
    return reduce(DataFrame.unionByName, parts).select(
        "test_id",
        "scenario",
        "expected",
        "observed",
        status_of(F.col("expected"), F.col("observed"), F.col("ok")).alias("status"),
    )


def listed(name: str, value: str) -> Column:
    """Aggregate 'name:value' over a small table, ordered by name."""
    return F.array_join(F.sort_array(F.collect_list(F.concat(F.col(name), F.lit(":"), text(value)))), ", ")


def counted(cond: Column) -> Column:
    return text(F.count_if(cond))


def pct(value: Column) -> Column:
    return F.concat(F.format_string("%.1f", F.round(100 * value, 1)), F.lit("%"))


def three(value: Column) -> Column:
    return F.coalesce(F.format_string("%.3f", F.round(value, 3)), F.lit("n/a"))


def share(cond: Column) -> Column:
    return F.avg(F.when(cond, 1.0).otherwise(0.0))


def checks_load(
    store: DataFrame, feature_config: DataFrame, geo_config: DataFrame, scoring_month: int, pinned: dict[str, str]
) -> DataFrame:
    """T101-T112: the data as received."""
    want = lambda k: pinned.get(k, NOT_PINNED)
    facts = store.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("target") == 0).alias("neg"),
        F.count_if(F.col("target") == 1).alias("pos"),
        F.count_if(F.col("target").isNull()).alias("open"),
        F.min("YEAR_MONTH").alias("lo"),
        F.max("YEAR_MONTH").alias("hi"),
        F.countDistinct("YEAR_MONTH").alias("months"),
        F.count_if(F.col("YEAR_MONTH") == scoring_month).alias("scoring"),
    )
    four = [c for c in ("target", "YEAR_MONTH", "EMP_ID") if c in store.columns]
    kinds = ", ".join(store.schema[c].dataType.simpleString() for c in four)
    store_columns = column_table(store, "feature_store").select(F.col("column_name").alias("feature"))
    config_columns = column_table(feature_config, "feature_config").select(F.col("column_name").alias("GEO"))
    return suite(
        rows(
            facts,
            ("T101", "rows in the feature store", want("T101"), text("n")),
            ("T103", "labels 0 / 1", want("T103"), F.concat_ws(" / ", text("neg"), text("pos"))),
            ("T104", "rows without label", want("T104"), text("open")),
            (
                "T105",
                "month range (distinct months)",
                want("T105"),
                F.concat(text("lo"), F.lit(" - "), text("hi"), F.lit(" ("), text("months"), F.lit(")")),
            ),
            ("T106", "types of label, month and id", "bigint, bigint, string", F.lit(kinds)),
            ("T108", "rows in the scoring month", want("T108"), text("scoring")),
        ),
        rows(store_columns.agg(F.count(F.lit(1)).alias("n")), ("T102", "columns of the feature store", want("T102"), text("n"))),
        rows(
            duplicate_keys(store).agg(F.count(F.lit(1)).alias("n")),
            ("T107", "repeated (EMP_ID, YEAR_MONTH) keys", pinned.get("T107", "0"), text("n")),
        ),
        rows(feature_config.agg(F.count(F.lit(1)).alias("n")), ("T109", "rows of feature_config", want("T109"), text("n"))),
        rows(
            geo_config.agg(F.count(F.lit(1)).alias("n"), F.array_join(F.sort_array(F.collect_list("GEO")), ",").alias("geos")),
            ("T110", "configured geos", want("T110"), F.concat(text("n"), F.lit(": "), F.col("geos"))),
        ),
        rows(
            geo_config.join(config_columns, "GEO", "left_anti").agg(F.count(F.lit(1)).alias("n")),
            ("T111", "geos without a flag column", "0", text("n")),
        ),
        rows(
            feature_config.select(F.col("MODEL_FEATURES").alias("feature"))
            .join(store_columns, "feature", "left_anti")
            .agg(F.count(F.lit(1)).alias("n")),
            ("T112", "configured features missing from the data", "0", text("n")),
        ),
    )


def checks_shared(
    store: DataFrame,
    features: DataFrame,
    date_columns: list[str],
    flags: DataFrame,
    selected: DataFrame,
    exclusions: DataFrame,
    rules: DataFrame,
    tables: DataFrame,
    train_end: int,
    eval_end: int,
    telemetry_prefix: str,
    pinned: dict[str, str],
) -> DataFrame:
    """T201-T213: feature preparation and configuration objects."""
    want = lambda k: pinned.get(k, NOT_PINNED)
    month = F.col("YEAR_MONTH")
    parts = {"TRAIN": month <= train_end, "EVAL": (month > train_end) & (month <= eval_end), "TEST": month > eval_end}
    split = lambda extra: F.concat_ws(" / ", *[F.concat(F.lit(f"{p} "), counted(c & extra)) for p, c in parts.items()])
    unread = reduce(lambda a, b: a | b, [F.col(c).isNotNull() & text_to_date(F.col(c)).isNull() for c in date_columns])
    per_geo = selected.groupBy("geo").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("feature").startswith(telemetry_prefix)).alias("telemetry")
    )
    return suite(
        rows(
            flags.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("flag") == 1).alias("on")),
            ("T201", "flag rows", want("T201"), text("n")),
            ("T202", "flags switched on", want("T202"), text("on")),
        ),
        rows(
            per_geo.agg(listed("geo", "n").alias("n"), listed("geo", "telemetry").alias("t")),
            ("T203", "features per geo", want("T203"), F.col("n")),
            ("T205", "telemetry features per geo", want("T205"), F.col("t")),
        ),
        rows(
            selected.join(exclusions, "feature", "left_semi").agg(F.count(F.lit(1)).alias("n")),
            ("T204", "excluded columns in a feature list", "0", text("n")),
        ),
        rows(
            store.agg(counted(unread).alias("unread")),
            ("T207", "rows with a date that cannot be read", "0", F.col("unread")),
        ),
        rows(
            features.agg(
                F.count(F.lit(1)).alias("n"),
                counted(F.col(date_columns[-1]) < 0).alias("late"),
                split(F.lit(True)).alias("sizes"),
                split(F.col("target") == 1).alias("positives"),
            ),
            ("T206", "rows kept by feature preparation", want("T206"), text("n")),
            ("T209", f"{date_columns[-1]} after the snapshot", want("T209"), F.col("late")),
            ("T210", "split sizes", want("T210"), F.col("sizes")),
            ("T211", "positives per split", want("T211"), F.col("positives")),
        ),
        rows(
            column_table(features, "model_features")
            .filter(F.col("column_name") == date_columns[0])
            .agg(F.max("data_type").alias("t")),
            ("T208", "type of a converted date", "bigint", F.col("t")),
        ),
        rows(
            rules.agg(
                F.concat(
                    text(F.count(F.lit(1))),
                    F.lit(" rows, "),
                    F.max("method"),
                    F.lit(", RED top "),
                    text(F.max("red_top_pct")),
                    F.lit("%, AMBER next "),
                    text(F.max("amber_next_pct")),
                    F.lit("%"),
                ).alias("d")
            ),
            ("T212", "default bucket rule", want("T212"), F.col("d")),
        ),
        rows(tables.agg(F.count(F.lit(1)).alias("n")), ("T213", "output tables that exist", "3", text("n"))),
    )


def checks_backtest(
    metrics: DataFrame,
    predictions: DataFrame,
    thresholds: DataFrame,
    model_inputs: DataFrame,
    exclusions: DataFrame,
    rounds: DataFrame | None,
    families: tuple[str, str],
    telemetry_prefix: str,
    pinned: dict[str, str],
) -> DataFrame:
    """T301-T314: backtest results. ``model_inputs`` has columns (model, feature)."""
    want = lambda k: pinned.get(k, NOT_PINNED)
    score, red, amber = F.col("risk_score"), F.col("red_threshold"), F.col("amber_threshold")
    is_red, is_amber = score >= red, (score >= amber) & (score < red)
    cut = thresholds.select("geo", "red_threshold", "amber_threshold")
    scored = predictions.join(cut, "geo").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(score.isNull() | (score < 0) | (score > 1)).alias("bad"),
        F.stddev_samp(score).alias("spread"),
        share(is_red).alias("red"),
        share(is_amber).alias("amber"),
        F.avg(F.when(is_red, F.col("target"))).alias("hit_red"),
        F.avg(F.when(is_amber, F.col("target"))).alias("hit_amber"),
        F.avg(F.when(score < amber, F.col("target"))).alias("hit_green"),
    )
    per_model = model_inputs.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("feature").startswith(telemetry_prefix)).alias("telemetry")
    )
    auc = F.col("roc_auc")
    parts = [
        rows(
            metrics.agg(
                F.count(F.lit(1)).alias("n"),
                F.count_if((auc > 0) & (auc < 1)).alias("valid"),
                F.avg(F.when(F.col("model_family") == families[0], auc)).alias("a"),
                F.avg(F.when(F.col("model_family") == families[1], auc)).alias("b"),
            ),
            ("T301", "models evaluated", want("T301"), text("n")),
            ("T302", "models with AUC between 0 and 1", want("T302"), text("valid")),
            ("T303", "mean AUC of both families", "INFO: for review", F.concat_ws(" | ", three(F.col("a")), three(F.col("b")))),
        ),
        rows(
            per_model.agg(listed("model", "n").alias("n"), listed("model", "telemetry").alias("t")),
            ("T304", "inputs per model", want("T304"), F.col("n")),
            ("T306", "telemetry inputs per model", want("T306"), F.col("t")),
        ),
        rows(
            model_inputs.join(exclusions, "feature", "left_semi").agg(F.count(F.lit(1)).alias("n")),
            ("T305", "excluded columns used as inputs", "0", text("n")),
        ),
        rows(
            scored,
            ("T307", "test predictions", want("T307"), text("n")),
            ("T308", "scores missing or outside 0..1", "0", text("bad")),
            ("T309", "scores vary", "> 0.001", F.format_string("%.4f", F.round("spread", 4)), F.col("spread") > 0.001),
            ("T311", "RED share", "3% - 20%", pct(F.col("red")), F.col("red").between(0.03, 0.20)),
            ("T312", "AMBER share", "10% - 35%", pct(F.col("amber")), F.col("amber").between(0.10, 0.35)),
            (
                "T313",
                "hit rate RED | AMBER | GREEN",
                "INFO: RED above GREEN shows a useful order",
                F.concat_ws(" | ", three(F.col("hit_red")), three(F.col("hit_amber")), three(F.col("hit_green"))),
            ),
        ),
        rows(
            thresholds.agg(F.count_if((amber > 0) & (amber < red) & (red < 1)).alias("n")),
            ("T310", "geos with valid cut-offs", want("T310"), text("n")),
        ),
    ]
    if rounds is not None:
        parts.append(
            rows(
                rounds.agg(F.countDistinct("iteration").alias("n")),
                ("T314", "training rounds", "1 - 100", text("n"), F.col("n").between(1, 100)),
            )
        )
    return suite(*parts)


def checks_run(
    month: int,
    employee: DataFrame,
    variable: DataFrame,
    drivers: DataFrame,
    thresholds: DataFrame,
    selected: DataFrame,
    labels: DataFrame,
    model_inputs: DataFrame,
    plain_geo: str,
    telemetry_prefix: str,
    leftovers: DataFrame,
    pinned: dict[str, str],
) -> DataFrame:
    """T401-T417: the monthly outputs. ``labels`` has (EMP_ID, YEAR_MONTH, target) if known.

    ``thresholds`` must be the month's own: T414 checks that they were renewed by this run
    (column ``fresh``) and not only that they are in order.
    """
    want = lambda k: pinned.get(k, NOT_PINNED)
    in_month = F.col("YEAR_MONTH") == month
    score, red, amber = F.col("risk_score"), F.col("red_threshold"), F.col("amber_threshold")
    right = F.when(score >= red, "RED").when(score >= amber, "AMBER").otherwise("GREEN")
    bucket = F.col("risk_bucket")
    known = labels.filter(in_month).groupBy("EMP_ID").agg(F.max("target").alias("target"))
    scored = (
        employee.filter(in_month)
        .join(thresholds.select("geo", "red_threshold", "amber_threshold"), "geo")
        .join(known, "EMP_ID", "left")
    )
    per_geo = scored.groupBy("geo").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(score.isNull() | (score < 0) | (score > 1)).alias("bad"),
        F.count_if(bucket != right).alias("wrong"),
        F.count_if(bucket == "RED").alias("red"),
        F.count_if(bucket == "AMBER").alias("amber"),
        F.count_if((bucket == "RED") & F.col("top_risk_drivers").isNull()).alias("mute"),
        *[F.sum(F.when(bucket == b, F.col("target"))).alias(f"hits_{b}") for b in ("RED", "AMBER", "GREEN")],
        *[F.count(F.when(bucket == b, F.col("target"))).alias(f"known_{b}") for b in ("RED", "AMBER", "GREEN")],
    )
    red_share, amber_share = F.col("red") / F.col("n"), F.col("amber") / F.col("n")
    whole = per_geo.agg(
        F.sum("n").alias("n"),
        F.sum("bad").alias("bad"),
        F.sum("wrong").alias("wrong"),
        F.sum("red").alias("red"),
        F.sum("amber").alias("amber"),
        F.sum("mute").alias("mute"),
        F.count(F.lit(1)).alias("geos"),
        F.min("n").alias("lo"),
        F.max("n").alias("hi"),
        *[F.try_divide(F.sum(f"hits_{b}"), F.sum(f"known_{b}")).alias(f"rate_{b}") for b in ("RED", "AMBER", "GREEN")],
    )
    reasons = variable.filter(in_month)
    rank = F.col("driver_rank")
    reason_facts = reasons.agg(
        F.count_if(F.col("risk_contribution") <= 0).alias("lowering"),
        F.count_if(F.col("feature_value").isNull()).alias("valueless"),
        F.min(rank).alias("lo"),
        F.max(rank).alias("hi"),
        F.count_if((F.col("geo") == plain_geo) & F.col("feature").startswith(telemetry_prefix)).alias("telemetry"),
    )
    per_list = selected.groupBy("geo").agg(F.count(F.lit(1)).alias("n_features"))
    covered = drivers.filter(in_month).groupBy("geo").agg(F.count(F.lit(1)).alias("n")).join(per_list, "geo")
    return suite(
        rows(
            whole,
            ("T401", "employees scored", want("T401"), text("n")),
            (
                "T402",
                "geos, smallest and largest",
                want("T402"),
                F.concat(text("geos"), F.lit(" geos, min "), text("lo"), F.lit(", max "), text("hi")),
            ),
            ("T403", "scores missing or outside 0..1", "0", text("bad")),
            ("T404", "buckets that contradict the cut-offs", "0", text("wrong")),
            ("T405", "RED share", "3% - 20%", pct(red_share), red_share.between(0.03, 0.20)),
            ("T406", "AMBER share", "10% - 35%", pct(amber_share), amber_share.between(0.10, 0.35)),
            ("T415", "RED employees without a driver", "0", text("mute")),
            (
                "T416",
                "event rate RED | AMBER | GREEN",
                "INFO: RED above GREEN shows a useful order",
                F.concat_ws(" | ", *[three(F.col(f"rate_{b}")) for b in ("RED", "AMBER", "GREEN")]),
            ),
        ),
        rows(
            reason_facts,
            ("T407", "drivers that do not raise the risk", "0", text("lowering")),
            ("T409", "drivers without a value", pinned.get("T409", "0"), text("valueless")),
            (
                "T410",
                "driver ranks",
                "min 1, max <= 10",
                F.concat(F.lit("min "), text("lo"), F.lit(", max "), text("hi")),
                (F.col("lo") == 1) & (F.col("hi") <= 10),
            ),
            ("T411", f"telemetry drivers in {plain_geo}", "0", text("telemetry")),
        ),
        rows(
            reasons.join(selected, ["geo", "feature"], "left_anti").agg(F.count(F.lit(1)).alias("n")),
            ("T408", "drivers outside the geo's feature list", "0", text("n")),
        ),
        rows(
            model_inputs.groupBy("model").agg(F.count(F.lit(1)).alias("n")).agg(listed("model", "n").alias("n")),
            ("T412", "inputs per production model", want("T412"), F.col("n")),
        ),
        rows(
            covered.agg(F.count_if((F.col("n") > 0) & (F.col("n") <= F.col("n_features"))).alias("n")),
            ("T413", "geos with overall drivers", want("T413"), text("n")),
        ),
        rows(
            thresholds.agg(F.count_if((amber > 0) & (amber < red) & (red < 1) & F.col("fresh")).alias("n")),
            ("T414", "geos whose cut-offs were renewed", want("T414"), text("n")),
        ),
        rows(leftovers.agg(F.count(F.lit(1)).alias("n")), ("T417", "stage tables left behind", "0", text("n"))),
    )


def checks_feed(month: int, feed: DataFrame, employee: DataFrame, summary: DataFrame, pinned: dict[str, str]) -> DataFrame:
    """T501-T507: feed and summary against the tables they come from."""
    in_month = F.col("YEAR_MONTH") == month
    top = F.col("top_variable_risks")
    first = F.get(top, F.lit(0))
    flagged = employee.filter(in_month).agg(F.count_if(F.col("risk_bucket").isin("RED", "AMBER"))).first()[0]
    facts = feed.filter(in_month).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.col("risk_bucket").isin("RED", "AMBER")).alias("other"),
        F.count_if((F.size(top) == 0) | (F.size(top) > 5) | first["feature"].isNull()).alias("odd"),
        F.count_if(first["driver_rank"] != 1).alias("late"),
    )
    n_feed = facts.first()["n"]
    totals = summary.filter(in_month).agg(
        F.sum("employees_scored").alias("n"),
        F.sum(F.col("red") + F.col("amber")).alias("flagged"),
        F.count(F.lit(1)).alias("geos"),
        F.count_if(F.col("red") + F.col("amber") + F.col("green") == F.col("employees_scored")).alias("closed"),
    )
    return suite(
        rows(
            facts,
            ("T501", "feed rows = RED + AMBER employees", str(flagged), text("n")),
            ("T502", "feed rows of another bucket", "0", text("other")),
            ("T503", "feed rows without 1 to 5 drivers", "0", text("odd")),
            ("T504", "feed rows whose first driver is not rank 1", "0", text("late")),
        ),
        rows(
            totals,
            ("T505", "employees in the summary", pinned.get("T505", NOT_PINNED), text("n")),
            ("T506", "RED + AMBER of the summary = feed rows", str(n_feed), text("flagged")),
            ("T507", "geos whose buckets add up", text("geos"), text("closed")),
        ),
    )


def literal_rows(spark, checks: list[tuple]) -> DataFrame:
    """Check rows whose values the driver already holds: (id, scenario, expected, observed[, ok])."""
    columns = list(zip(*[(c + (None,))[:5] for c in checks]))
    names = ["test_id", "scenario", "expected", "observed", "ok"]
    kinds = [pa.string()] * 4 + [pa.bool_()]
    return suite(local_table(spark, {n: pa.array(list(v), k) for n, v, k in zip(names, columns, kinds)}))
