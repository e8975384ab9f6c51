import math

import numpy as np

import pytest
from pyspark.sql import functions as F

from riskloom.operators.drift import bucket_moves, driver_drift, feature_drift, score_drift
from riskloom.operators.quality import (
    column_profile,
    duplicate_keys,
    fairness_rates,
    leakage_scan,
    map_codes,
    quality_gate,
    quarantine,
    target_correlation,
)
from riskloom.operators.feed import action_list, ews_feed, ews_summary, published_feed
from riskloom.operators.risk import employee_risk, variable_risk
from riskloom.sources.scratch import fix_small
from riskloom.functions.drivers import DRIVER_TYPE


def test_quarantine_with_a_hot_key(spark):
    hot = spark.range(3000).select(F.lit("E0").alias("EMP_ID"), F.lit(202401).cast("long").alias("YEAR_MONTH"), F.col("id").alias("v"))
    rest = spark.range(1, 500).select(F.concat(F.lit("E"), F.col("id")).alias("EMP_ID"), F.lit(202401).cast("long").alias("YEAR_MONTH"), F.col("id").alias("v"))
    clean, bad = quarantine(hot.unionByName(rest))
    assert (clean.count(), bad.count()) == (499, 3000)
    assert {(r.EMP_ID, r.n_copies) for r in bad.select("EMP_ID", "n_copies").distinct().collect()} == {("E0", 3000)}
    assert duplicate_keys(rest).count() == 0


def test_fix_small_leaves_large_tables_alone(spark):
    df = spark.range(50)
    assert fix_small(df, 10) is df and fix_small(df, 50).count() == 50


def test_quality_gate(spark):
    df = spark.createDataFrame([("E1", 202401, 1), ("E1", 202401, None), ("E2", 202401, 0)], "EMP_ID string, YEAR_MONTH long, target long")
    got = {r.rule: (r.observed, r.status) for r in quality_gate(df, ["target"], 202402).collect()}
    assert got == {
        "rows present": (3, "PASS"), "duplicate keys": (1, "FAIL"), "newest month": (202401, "FAIL"), "empty target": (1, "FAIL"),
    }
    empty = {r.rule: r.status for r in quality_gate(df.limit(0), ["target"], 202402).collect()}
    assert empty["rows present"] == "FAIL" and empty["newest month"] == "FAIL"


def test_leakage_scan(spark):
    df = spark.createDataFrame(
        [(202401, "2/2/2024 0:00"), (202401, "1/2/2024 0:00"), (202401, "junk"), (202401, None)], "YEAR_MONTH long, D string"
    )
    r = leakage_scan(df, ["D"]).first()
    assert (r.n_rows, r.n_filled, r.n_after_snapshot, r.n_unreadable, r.leaks) == (4, 3, 1, 1, True)


def test_column_profile(spark):
    df = spark.range(1000).select(
        F.lit("R").alias("same"),
        F.concat(F.lit("c"), F.col("id")).alias("code"),
        F.when(F.col("id") < 400, 18.0).otherwise(F.col("id") * 1.0).alias("age"),
        F.when(F.col("id") < 10, F.lit(None)).otherwise(F.col("id") * 1.0).alias("wide"),
        F.lit(None).cast("string").alias("nothing"),
    )
    got = {r.column_name: r for r in column_profile(df).collect()}
    assert got["same"].proposed_exclusion == "Constant" and got["code"].proposed_exclusion == "Near-unique code"
    assert (got["age"].spike_value, got["age"].spike_rows) == ("18", 400)
    assert got["wide"].spike_value is None and got["wide"].n_null == 10 and got["wide"].proposed_exclusion is None
    assert got["nothing"].n_null == 1000 and not got["nothing"].is_constant


def test_correlation(spark):
    df = spark.range(100).select((F.col("id") * 1.0).alias("x"), (F.col("id") >= 50).cast("long").alias("target"), F.lit(1.0).alias("flat"))
    got = {r.feature: r.correlation for r in target_correlation(df, ["x"]).collect()}
    assert got["x"] == pytest.approx(0.866, abs=1e-3)


def test_code_families(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "code_col string, v long")
    families = spark.createDataFrame([("a", "vowel")], "code string, family string")
    got = {r.v: r.code_col for r in map_codes(df, "code_col", families).collect()}
    assert got == {1: "vowel", 2: "OTHER", 3: "OTHER"}


def test_psi(spark):
    base = [(202401, float(i % 10), 5.0) for i in range(100)]
    now = [(202402, float(i % 5), 5.0) for i in range(100)] + [(202402, None, 5.0)]
    df = spark.createDataFrame(base + now, "YEAR_MONTH long, x double, flat double")
    got = {r.feature: r for r in feature_drift(df, ["x", "flat"], 202401, 202402).collect()}
    assert got["flat"].psi == 0
    parts = [(0.1, 20 / 101)] * 5 + [(0.1, 1e-4)] * 5 + [(1e-4, 1 / 101)]
    assert got["x"].psi == pytest.approx(sum((q - p) * math.log(q / p) for p, q in parts))
    assert (got["x"].n_base, got["x"].n_now) == (100, 101)


def test_moves_and_score_drift(spark):
    df = spark.createDataFrame(
        [("A", "1", 1, "RED", 0.9), ("A", "1", 2, "GREEN", 0.1), ("A", "2", 1, "GREEN", 0.2), ("A", "3", 2, "RED", 0.8)],
        "geo string, EMP_ID string, YEAR_MONTH long, risk_bucket string, risk_score double",
    )
    got = {(r.from_bucket, r.to_bucket): r.employees for r in bucket_moves(df, 1, 2).collect()}
    assert got == {("RED", "GREEN"): 1, ("GREEN", "GONE"): 1, ("NEW", "RED"): 1}
    r = score_drift(df, 1, 2).first()
    assert r.score_change == pytest.approx(-0.1) and r.red_share_change == 0


def test_driver_drift_with_a_new_feature(spark):
    df = spark.createDataFrame([("A", 1, "x", 1.0), ("A", 2, "x", 1.0), ("A", 2, "y", 3.0)], "geo string, YEAR_MONTH long, feature string, attribution double")
    assert {r.feature: r.share_change for r in driver_drift(df, 1, 2).collect()} == {"x": -0.75, "y": 0.75}


def test_fairness(spark):
    df = spark.createDataFrame(
        [("A", "F", "RED", 1), ("A", "F", "GREEN", 0), ("A", "M", "GREEN", 0), ("A", "M", "GREEN", 1)],
        "geo string, sex string, risk_bucket string, target long",
    )
    got = {r.sex: r for r in fairness_rates(df, "sex").collect()}
    assert got["F"].red_share_gap == 0.5 and got["F"].flagged_hit_rate == 1.0 and got["M"].flagged_hit_rate is None


@pytest.fixture(scope="module")
def stage(spark):
    many = [(f"f{i}", str(i), 0.1 * (i + 1)) for i in range(8)]
    return spark.createDataFrame(
        [
            ("A", "1", 202401, 1, 0.9, many, "m_a"),
            ("A", "2", 202401, 0, 0.6, [("f1", None, 0.2), ("f2", "x", -0.3)], "m_a"),
            ("A", "3", 202401, 0, 0.6, [("f1", "1", -0.2)], "m_a"),
            ("A", "4", 202401, None, 0.1, [("f1", "1", 0.2)], "m_a"),
        ],
        f"geo string, EMP_ID string, YEAR_MONTH long, target long, risk_score double, attributions {DRIVER_TYPE}, model_name string",
    )


def test_feed(spark, stage):
    cut = spark.createDataFrame([("A", 0.8, 0.5)], "geo string, red_threshold double, amber_threshold double")
    employee, variable = employee_risk(stage, cut), variable_risk(stage)
    ranks = {r.EMP_ID: (r.risk_rank_in_geo, r.risk_bucket, r.top_risk_drivers) for r in employee.collect()}
    assert ranks == {"1": (1, "RED", "f7, f6, f5"), "2": (2, "AMBER", "f1"), "3": (2, "AMBER", None), "4": (4, "GREEN", "f1")}
    feed = ews_feed(employee, variable)
    tops = {r.EMP_ID: [d.feature for d in r.top_variable_risks] for r in feed.collect()}
    assert tops == {"1": ["f7", "f6", "f5", "f4", "f3"], "2": ["f1"], "3": []}
    s = ews_summary(employee).first()
    assert (s.employees_scored, s.red, s.amber, s.green, s.avg_risk_score) == (4, 1, 2, 1, 0.55)
    actions = action_list(feed, 2).collect()
    assert [r.EMP_ID for r in actions] == ["1", "2"]
    assert actions[1].recommended_variable_risks == "1. f1 = NULL (+0.200)"
    flags = spark.createDataFrame([("A", 202401, False)], "geo string, YEAR_MONTH long, published boolean")
    assert published_feed(feed, flags).count() == 0


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from riskloom.sources.scratch import LOCAL_DIR, scratch_dir

    def session(master, folder):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=SimpleNamespace(master=master, applicationId="app")
        )

    assert scratch_dir(session("yarn", "hdfs:///shared/")) == "hdfs:///shared/riskloom/app"
    assert scratch_dir(session("local[2]", None)).startswith(LOCAL_DIR)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(session("yarn", None))


def test_drift_from_sketches_is_within_the_rank_error(spark, tmp_path):
    """700 columns, two periods, one of two months: close to the index of all values, from stored sketches only."""
    from riskloom.operators.sketches import quantile_drift, read_sketches, store_sketches

    names = [f"f{k:03d}" for k in range(700)]
    value = lambda k: F.when(F.col("id") % 17 != k % 17, (F.xxhash64("id", F.lit(k)) % 1000 + F.col("m") * (k % 5) * 40).cast("double"))
    rows = spark.range(3000).withColumn("m", F.floor(F.col("id") / 1000))
    wide = rows.select((F.lit(202401) + F.col("m")).cast("long").alias("YEAR_MONTH"), *[value(k).alias(n) for k, n in enumerate(names)]).cache()
    path = str(tmp_path / "sketches")
    store_sketches(wide.filter(F.col("YEAR_MONTH") < 202403), names, path)
    store_sketches(wide.filter(F.col("YEAR_MONTH") == 202403), names, path)
    found = {r.feature: r for r in quantile_drift(read_sketches(spark, path), [202401, 202402], [202403]).collect()}
    assert len(found) == 700 and all(r.n_base == 2000 and r.n_now == 1000 for r in found.values())
    assert set(read_sketches(spark, path).columns) == {"feature", "n_rows", "n_filled", "sketch", "YEAR_MONTH"}  # all that it reads
    data = wide.select("YEAR_MONTH", *names[:20]).toPandas()
    for name in names[:20]:
        base, now = data[data.YEAR_MONTH < 202403][name], data[data.YEAR_MONTH == 202403][name]
        cuts = np.unique(base.dropna().quantile([k / 10 for k in range(1, 10)], interpolation="lower"))
        share = lambda x: np.maximum(np.append(np.histogram(x.dropna(), [-np.inf, *np.nextafter(cuts, np.inf), np.inf])[0], x.isna().sum()) / len(x), 1e-4)
        p, q = share(base), share(now)
        assert abs(found[name].psi - ((q - p) * np.log(q / p)).sum()) < 0.02
    wide.unpersist()


def test_drift_of_empty_and_constant_columns(spark, tmp_path):
    from riskloom.operators.sketches import quantile_drift, read_sketches, store_sketches

    rows = [(1, None, 5.0, float("nan")), (1, None, 5.0, 1.0), (2, None, 5.0, None), (2, 3.0, 5.0, 1.0)]
    store_sketches(spark.createDataFrame(rows, "YEAR_MONTH long, none double, same double, odd double"), ["none", "same", "odd"], str(tmp_path / "s"))
    found = {r.feature: r.psi for r in quantile_drift(read_sketches(spark, str(tmp_path / "s")), [1], [2]).collect()}
    assert found["same"] == 0 and found["odd"] == 0 and found["none"] > 1


def test_families_are_the_longest_beginnings_with_enough_rows(spark):
    from riskloom.operators.quality import learn_families

    codes = ["AB1"] * 6 + ["AB2"] * 2 + ["AB3"] * 3 + ["AC1"] * 1 + ["B"] * 1 + [None] * 9 + [""] * 2
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    found = {r.code: r.family for r in learn_families(df, "code", 5).collect()}
    assert found == {"AB1": "AB1", "AB2": "AB", "AB3": "AB", "AC1": "", "B": "", "": ""}
    assert learn_families(df.limit(0), "code", 5).count() == 0


def test_feature_lists_are_compared_as_relations(spark):
    from riskloom.operators.features import list_changes

    pairs = lambda *x: spark.createDataFrame(x, "geo string, feature string")
    before = pairs(("A", "x"), ("A", "y"), ("B", "x"), ("C", "z"))
    after = pairs(("A", "y"), ("A", "x"), ("B", "y"), ("D", "z"))
    found = {r.geo: (r.n_before, r.n_after, r.unchanged) for r in list_changes(before, after).collect()}
    assert found == {"A": (2, 2, True), "B": (1, 1, False), "C": (1, 0, False), "D": (0, 1, False)}


def test_profile_of_700_columns_reads_an_added_month_only(spark, tmp_path):
    """Equal to the profile of all rows, from stored months alone: the rows of earlier months are gone by then."""
    from riskloom.operators.profiles import merged_profile, read_profiles, store_profiles

    names = [f"f{k:03d}" for k in range(700)]
    kinds = ["double", "string", "long"]
    value = "CAST(CASE WHEN id % 11 <> {k} % 11 THEN CASE WHEN pmod(xxhash64(id, {k}), 10) < {k} % 5 THEN {k} ELSE id + {k} END END AS {kind}) AS {name}"
    wide = spark.range(900).selectExpr("202401 + id DIV 300 AS YEAR_MONTH", *[value.format(k=k, kind=kinds[k % 3], name=n) for k, n in enumerate(names)])
    path = str(tmp_path / "profiles")
    store_profiles(wide.filter("YEAR_MONTH < 202403"), path)
    store_profiles(wide.filter("YEAR_MONTH = 202403"), path)
    found = {r.column_name: r for r in merged_profile(read_profiles(spark, path)).collect()}  # rows aren't given
    assert len(found) == 701 and found["YEAR_MONTH"].spike_rows == 300
    data = wide.toPandas()
    for k, name in enumerate(names):
        row, counts = found[name], data[name].value_counts()
        expected = (str(k), counts.iloc[0]) if counts.iloc[0] >= 0.25 * 900 else (None, None)
        assert (row.spike_value, row.spike_rows) == expected, name
        assert (row.n_rows, row.n_null, row.is_constant) == (900, data[name].isna().sum(), False)
        assert row.is_near_unique == (k % 3 == 1)
    assert sum(r.spike_rows is not None for r in found.values()) > 200


def test_open_counts_are_read_from_the_months_that_lack_them(spark, tmp_path):
    """A value that fills one month and is rare in the next: counted there; one that can't reach the share isn't."""
    from riskloom.operators.profiles import merged_profile, read_profiles, store_profiles

    def month(m, spike, rare):
        return [(m, "S" if i < spike else "R" if i < spike + rare else f"x{m}-{i}") for i in range(100)]

    parts = {m: spark.createDataFrame(month(m, *n), "YEAR_MONTH long, code string") for m, n in {1: (70, 7), 2: (3, 0), 3: (4, 0)}.items()}
    path = str(tmp_path / "profiles")
    for part in parts.values():
        store_profiles(part, path)
    stored = read_profiles(spark, path)
    with pytest.raises(ValueError, match="code = S"):
        merged_profile(stored).collect()
    gone = parts[1].limit(0).unionAll(parts[2]).unionAll(parts[3])  # month 1 isn't needed
    found = {r.column_name: r for r in merged_profile(stored, gone).collect()}
    assert (found["code"].spike_value, found["code"].spike_rows, found["code"].n_rows) == ("S", 77, 300)
    store_profiles(spark.createDataFrame(month(2, 50, 0), "YEAR_MONTH long, code string"), path)  # a month that comes again
    found = {r.column_name: r for r in merged_profile(read_profiles(spark, path), gone).collect()}
    assert found["code"].spike_rows == 124 and found["YEAR_MONTH"].spike_value in ("1", "2", "3")
    with pytest.raises(ValueError, match="1/16"):
        merged_profile(stored, spike_share=0.01)


def test_profile_of_empty_constant_and_null_months(spark, tmp_path):
    from riskloom.operators.profiles import merged_profile, read_profiles, store_profiles

    kind = "YEAR_MONTH long, same double, split string, none string, part long"
    first = spark.createDataFrame([(1, 5.0, "a", None, None)] * 3, kind)
    second = spark.createDataFrame([(2, 5.0, "b", None, 7)] * 3 + [(None, None, "a", None, 7)], kind)
    path = str(tmp_path / "profiles")
    store_profiles(first, path)
    store_profiles(second, path)
    store_profiles(first.limit(0), path)
    both = first.unionAll(second)
    found = {r.column_name: r for r in merged_profile(read_profiles(spark, path), both).collect()}
    assert found == {r.column_name: r for r in column_profile(both).collect()}
    assert found["same"].is_constant and found["part"].is_constant and not found["none"].is_constant and not found["split"].is_constant
