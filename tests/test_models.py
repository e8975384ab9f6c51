from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.models.attribution import build_explainer, contributions
from riskloom.models.families import LinearFamily, TreeFamily, additivity, balance
from riskloom.operators.risk import geo_drivers, variable_risk
from riskloom.operators.scorecard import STAGE_COLUMNS, Scorecard, Weight, score_with

LISTS = {"AAA": ["age", "colour", "pay"], "BBB": ["age", "pay"]}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    out = []
    for i in range(900):
        age, pay, colour = float(rng.integers(20, 60)), float(np.round(rng.normal(), 2)), str(rng.choice(["red", "blue", "green"]))
        p = 1 / (1 + np.exp(-(0.08 * (age - 40) + pay + (1.0 if colour == "red" else -0.5))))
        out.append(
            (
                "AAA" if i % 3 else "BBB", f"E{i}", 202401 + i % 6, int(rng.random() < p),
                age if i % 11 else None, pay, colour if i % 13 else None,
            )
        )
    return spark.createDataFrame(out, "GEO string, EMP_ID string, YEAR_MONTH long, target long, age double, pay double, colour string")


@pytest.fixture(scope="module")
def history(rows):
    return rows.withColumn("is_eval", F.col("YEAR_MONTH") >= 202405)


@pytest.fixture(scope="module")
def trees(spark, history, tmp_path_factory):
    family = TreeFamily(str(tmp_path_factory.mktemp("trees")), rounds=6, depth=3, early_stop=False)
    family.fit(history, LISTS)
    assert family.errors == {}
    return family


@pytest.fixture(scope="module")
def linear(spark, history, tmp_path_factory):
    family = LinearFamily(str(tmp_path_factory.mktemp("linear")))
    family.fit(history, LISTS)
    assert family.errors == {}
    return family


def expected_margin(nodes, weights, x, known):
    """Mean margin of the trees when only the features in ``known`` are known."""

    def walk(node, by_id):
        if node["left"] < 0:
            return node["prediction"]
        left, right = by_id[node["left"]], by_id[node["right"]]
        if node["feature"] in known:
            value = x[node["feature"]]
            goes = value <= node["split"][0] if node["n_categories"] < 0 else value in node["split"]
            return walk(left if goes else right, by_id)
        return (left["cover"] * walk(left, by_id) + right["cover"] * walk(right, by_id)) / node["cover"]

    total = 0.0
    for tree in sorted({n["tree"] for n in nodes}):
        by_id = {n["id"]: n for n in nodes if n["tree"] == tree}
        total += 2 * weights[tree] * walk(by_id[0], by_id)
    return total


def test_contributions_are_shapley_values():
    def node(tree, i, left=-1, right=-1, feature=-1, split=(), n_categories=-1, prediction=0.0, cover=1.0):
        return dict(tree=tree, id=i, left=left, right=right, feature=feature, split=list(split), n_categories=n_categories, prediction=prediction, cover=cover)

    nodes = [
        node(0, 0, 1, 2, 0, [0.5], cover=10),
        node(0, 1, 3, 4, 1, [0.0, 2.0], 3, cover=6),
        node(0, 2, 5, 6, 0, [0.8], cover=4),
        node(0, 3, prediction=1.0, cover=4),
        node(0, 4, prediction=-0.5, cover=2),
        node(0, 5, prediction=0.3, cover=1),
        node(0, 6, prediction=-2.0, cover=3),
        node(1, 0, 1, 2, 2, [1.5], cover=10),
        node(1, 1, prediction=0.7, cover=7),
        node(1, 2, 3, 4, 0, [0.2], cover=3),
        node(1, 3, prediction=0.1, cover=2),
        node(1, 4, prediction=0.9, cover=1),
    ]
    weights = [1.0, 0.1]
    x = np.array([[a, b, c] for a in (0.1, 0.5, 0.7, 0.9) for b in (0.0, 1.0, 2.0) for c in (1.0, 2.0)])
    explainer = build_explainer(nodes, weights, 3)
    got = contributions(explainer, x)
    for row, parts in zip(x, got):
        for i in range(3):
            rest = [j for j in range(3) if j != i]
            want = 0.0
            for size in range(3):
                for s in combinations(rest, size):
                    share = factorial(size) * factorial(2 - size) / factorial(3)
                    want += share * (expected_margin(nodes, weights, row, {*s, i}) - expected_margin(nodes, weights, row, set(s)))
            assert parts[i] == pytest.approx(want, abs=1e-12)
        assert explainer["base"] + parts.sum() == pytest.approx(expected_margin(nodes, weights, row, {0, 1, 2}))


def test_tree_contributions_add_up(spark, trees, rows):
    stage = trees.explain(rows, None)
    assert stage.columns == STAGE_COLUMNS
    found = {r.geo: (r.n_rows, r.n_off) for r in additivity(stage, trees.bases(spark)).collect()}
    assert found == {"AAA": (600, 0), "BBB": (300, 0)}


def test_explain_and_score_agree(trees, rows):
    a = trees.explain(rows).select("EMP_ID", F.col("risk_score").alias("a"))
    assert a.join(trees.score(rows), "EMP_ID").filter(F.abs(F.col("a") - F.col("risk_score")) > 1e-9).count() == 0


def test_values_are_the_actual_ones(trees, rows):
    v = variable_risk(trees.explain(rows)).filter("geo = 'AAA'")
    pay = v.filter("feature = 'pay'").join(rows, "EMP_ID")
    assert pay.count() > 0
    assert pay.filter(F.abs(F.col("feature_value").cast("double") - F.col("pay")) > 1e-9).count() == 0
    colour = v.filter("feature = 'colour'").join(rows, "EMP_ID")
    assert colour.filter(~F.col("feature_value").eqNullSafe(F.col("colour"))).count() == 0
    assert v.filter("feature = 'age' and feature_value is null").count() == v.join(rows, "EMP_ID").filter("feature = 'age' and age is null").count()


def test_models_use_their_own_lists(trees, linear):
    assert trees.inputs() == {"btree_aaa": ["age", "colour", "pay"], "btree_bbb": ["age", "pay"]}
    assert linear.inputs() == {"logreg_aaa": ["age", "colour", "pay"], "logreg_bbb": ["age", "pay"]}


def test_training_curve_falls(trees, history):
    curve = trees.training_curve(history).filter("geo = 'AAA'").orderBy("iteration").collect()
    assert [r.iteration for r in curve] == list(range(1, 7))
    assert curve[-1].train_loss < curve[0].train_loss and curve[0].eval_loss is not None


def test_same_seed_same_scores(spark, history, rows, trees, tmp_path):
    again = TreeFamily(str(tmp_path), rounds=6, depth=3, early_stop=False)
    again.fit(history, LISTS)
    a = trees.score(rows).withColumnRenamed("risk_score", "a")
    assert a.join(again.score(rows), ["geo", "EMP_ID"]).filter(F.abs(F.col("a") - F.col("risk_score")) > 1e-12).count() == 0


def test_early_stop_keeps_fewer_rounds(spark, history, tmp_path):
    family = TreeFamily(str(tmp_path), rounds=30, depth=4)
    family.fit(history, {"AAA": LISTS["AAA"]})
    assert 1 <= family.models["AAA"].stages[-1].getNumTrees <= 30


def test_signal_is_found(spark, trees, linear, rows):
    from riskloom.operators.evaluate import evaluate

    for family in (trees, linear):
        scored = family.score(rows).withColumn("model_family", F.lit(family.prefix))
        assert evaluate(scored).filter("geo = 'AAA'").first().roc_auc > 0.7


def test_linear_contributions_add_up(spark, linear, rows):
    found = additivity(linear.explain(rows, None), linear.bases(spark)).agg(F.sum("n_off")).first()[0]
    assert found == 0
    a = linear.explain(rows).select("EMP_ID", F.col("risk_score").alias("a"))
    assert a.join(linear.score(rows), "EMP_ID").filter(F.abs(F.col("a") - F.col("risk_score")) > 1e-9).count() == 0


def test_linear_fit_is_at_its_optimum(linear, history):
    train = linear.score(history.filter("not is_eval"))
    assert {r.geo: r.balanced for r in balance(train, linear.facts).collect()} == {"AAA": True, "BBB": True}
    shifted = train.withColumn("risk_score", F.col("risk_score") * 0.9)
    assert not any(r.balanced for r in balance(shifted, linear.facts).collect())


def test_linear_weights(spark, linear):
    w = {(r.geo, r.feature): r.weight for r in linear.weights(spark).collect()}
    assert w[("AAA", "colour=red")] > 0 > w[("AAA", "colour=blue")]
    assert w[("AAA", "pay")] > 0 and len([k for k in w if k[0] == "BBB"]) == 2


def test_drivers_equal_the_mean_over_explained_rows(trees, linear, rows):
    for family in (trees, linear):
        want = {(r.geo, r.feature): r.attribution for r in geo_drivers(family.explain(rows, None)).collect()}
        got = {(r.geo, r.feature): r.attribution for r in family.drivers(rows).collect()}
        assert len(got) == 5 and got == pytest.approx(want)


def test_geo_without_both_classes_is_reported(spark, history, tmp_path):
    family = LinearFamily(str(tmp_path))
    family.fit(history.filter("GEO = 'AAA' or target = 1"), LISTS)
    assert list(family.errors) == ["BBB"] and list(family.models) == ["AAA"]


def test_rows_without_geo_reach_every_model(linear, rows):
    homeless = rows.withColumn("GEO", F.lit(None).cast("string"))
    assert {r.geo: r["count"] for r in linear.score(homeless).groupBy("geo").count().collect()} == {"AAA": 900, "BBB": 900}


def test_loaded_models_score_and_explain_alike(spark, trees, linear, rows):
    for family in (trees, linear):
        again = type(family)("unused")
        again.load(spark, {g: family.path for g in family.models})
        a = family.explain(rows).select("geo", "EMP_ID", F.col("risk_score").alias("a"), F.col("attributions").alias("b"))
        both = a.join(again.explain(rows), ["geo", "EMP_ID"])
        assert both.count() == 900
        assert both.filter((F.abs(F.col("a") - F.col("risk_score")) > 1e-12) | (F.col("b")["feature"] != F.col("attributions")["feature"])).count() == 0
        assert again.inputs() == family.inputs()


def test_names_with_the_suffix_of_inputs(spark, history, tmp_path):
    named = history.withColumnRenamed("colour", "a__x_b").withColumnRenamed("pay", "pay__x")
    lists = {"AAA": ["a__x_b", "age", "pay__x"]}
    for family in (LinearFamily(str(tmp_path / "l")), TreeFamily(str(tmp_path / "t"), rounds=2, depth=2, early_stop=False)):
        family.fit(named, lists)
        family.raise_errors()
        stage = family.explain(named.filter(F.col("GEO") == "AAA").limit(50), None)
        assert {d.feature for d in stage.first().attributions} == set(lists["AAA"])
        assert additivity(stage, family.bases(spark)).first().n_off == 0


def test_scorecard_of_many_hundred_features(spark):
    names = [f"f{k:03d}" for k in range(700)]
    df = spark.range(200).select(
        F.lit("AAA").alias("geo"), F.col("id").cast("string").alias("EMP_ID"), F.lit(202401).cast("long").alias("YEAR_MONTH"),
        F.lit(0).cast("long").alias("target"), *[((F.col("id") * (k + 1)) % 97).cast("double").alias(n) for k, n in enumerate(names)],
    )
    card = Scorecard("wide", -1.0, tuple(Weight(n, 0.001 * (k % 7 - 3), 48.0, 20.0) for k, n in enumerate(names)))
    for r in score_with(df, card).collect():
        parts = {n: 0.001 * (k % 7 - 3) * ((int(r.EMP_ID) * (k + 1)) % 97 - 48.0) / 20.0 for k, n in enumerate(names)}
        assert r.risk_score == pytest.approx(1 / (1 + np.exp(1.0 - sum(parts.values()))))
        assert [d.feature for d in r.attributions] == sorted(names, key=lambda n: (-abs(parts[n]), n))[:10]
        assert all(d.feature_value == str((int(r.EMP_ID) * (int(d.feature[1:]) + 1)) % 97) for d in r.attributions)


@pytest.fixture(scope="module")
def odd(rows):
    """NaN, empty and unseen inputs."""
    k = F.pmod(F.xxhash64("EMP_ID"), F.lit(4))
    return rows.withColumns(
        {
            "pay": F.when(k == 0, F.lit(float("nan"))).when(k == 1, F.lit(None)).otherwise(F.col("pay")),
            "colour": F.when(k == 2, "mauve").when(k == 1, F.lit(None)).otherwise(F.col("colour")),
        }
    )


def test_kernel_agrees_with_the_stored_pipelines(trees, linear, odd):
    for family in (trees, linear):
        keys = ["geo", "EMP_ID"]
        told = family.explain(odd).select(*keys, F.col("risk_score").alias("told"))
        other = family.pipeline_scores(odd).select(*keys, F.col("risk_score").alias("other"))
        met = family.score(odd).join(told, keys).join(other, keys)
        assert met.count() == 900
        close = (F.abs(F.col("risk_score") - F.col("told")) < 1e-9) & (F.abs(F.col("risk_score") - F.col("other")) < 1e-9)
        assert met.filter(~F.coalesce(close, F.lit(False))).count() == 0


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Scan ")


def test_all_geos_are_scored_in_one_scan(spark, trees, linear, rows, tmp_path):
    rows.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    for family in (trees, linear):
        for df in (family.score(stored), family.explain(stored), family.drivers(stored)):
            assert scans(df) == 1
        plan = family.explain(stored)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1 and "PushedFilters: [Or(IsNull(GEO),In(GEO, [AAA,BBB]))]" in plan
    assert scans(trees.staged_scores(stored, [1, 3])) == 1


def test_staged_scores_are_those_of_fewer_rounds(history, rows, trees, tmp_path):
    staged = trees.staged_scores(rows, [2, 6, 9])
    last = staged.join(trees.score(rows), ["geo", "EMP_ID"])
    assert last.filter((F.abs(F.col("risk_scores")[1] - F.col("risk_score")) > 1e-12) | (F.col("risk_scores")[2] != F.col("risk_scores")[1])).count() == 0
    short = TreeFamily(str(tmp_path), rounds=2, depth=3, early_stop=False)
    short.fit(history, LISTS)
    met = staged.join(short.score(rows), ["geo", "EMP_ID"])
    assert met.count() == 900 and met.filter(F.abs(F.col("risk_scores")[0] - F.col("risk_score")) > 1e-9).count() == 0


def test_texts_of_many_values_are_hashed(spark, history, tmp_path):
    from riskloom.models.prepare import HASH_BUCKETS

    coded = history.withColumn("colour", F.concat("colour", F.lit("-"), "EMP_ID"))  # as many codes as employees
    for family in (TreeFamily(str(tmp_path / "t"), rounds=3, depth=3, early_stop=False), LinearFamily(str(tmp_path / "l"))):
        family.fit(coded, {"AAA": LISTS["AAA"]})
        family.raise_errors()
        assert family.facts["AAA"].hashed == ["colour"] and family.labels("AAA") == {"colour": HASH_BUCKETS}
        labels = [ls for s in family.models["AAA"].stages if hasattr(s, "labelsArray") for ls in s.labelsArray]
        assert max(map(len, labels)) == HASH_BUCKETS  # nothing that grows with the codes
        odd = coded.withColumn("colour", F.when(F.col("EMP_ID") != "E1", F.concat("colour", F.lit("?")))).filter("GEO = 'AAA'")
        met = family.score(odd).join(family.pipeline_scores(odd).select("EMP_ID", F.col("risk_score").alias("other")), "EMP_ID")
        assert met.count() == 600 and met.filter(F.abs(F.col("risk_score") - F.col("other")) > 1e-9).count() == 0
        again = type(family)("unused")
        again.load(spark, {"AAA": family.path})
        assert again.score(odd).join(family.score(odd).select("EMP_ID", F.col("risk_score").alias("b")), "EMP_ID").filter(F.abs(F.col("b") - F.col("risk_score")) > 1e-12).count() == 0


def test_search_reads_fewer_rounds_from_the_same_trees(spark, tmp_path):
    from riskloom.plans.queries import inputs
    from riskloom.plans.tuning import search
    from dataclasses import replace

    given = inputs(spark, "/root/testdata/sf0.001")
    one = replace(given, geo_config=given.geo_config.filter("GEO = 'EUR'"))
    found = {r.params: (r.log_loss, r.roc_auc) for r in search(one, str(tmp_path / "a"), [{"depth": 2, "step": 0.3}], [2, 4], 199912, 200006).collect()}
    again = search(one, str(tmp_path / "b"), [{"depth": 2, "step": 0.3}], [2], 199912, 200006).first()
    assert len(found) == 2 and found[again.params] == pytest.approx((again.log_loss, again.roc_auc))


def test_fits_side_by_side_keep_their_own_properties(spark, tmp_path):
    """Spark keeps the running query's number there; fits that shared one copy took it from each other."""
    from threading import Barrier

    together, seen = Barrier(2, timeout=60), {}

    class Waiting(TreeFamily):
        def _fit_geo(self, history, geo):
            spark.sparkContext.setLocalProperty("riskloom.geo", geo)
            together.wait()
            seen[geo] = spark.sparkContext.getLocalProperty("riskloom.geo")
            together.wait()

    numbers = spark.createDataFrame([("AAA", 0, False, 1.0), ("BBB", 1, False, 2.0)], "GEO string, target long, is_eval boolean, pay double")
    family = Waiting(str(tmp_path))
    family.fit(numbers, {"AAA": ["pay"], "BBB": ["pay"]})
    assert family.errors == {} and seen == {"AAA": "AAA", "BBB": "BBB"}


def test_sets_of_a_search_share_the_encoded_rows(spark, tmp_path, monkeypatch):
    """A search read and encoded the training rows again for every set of parameters."""
    from dataclasses import replace

    from riskloom.models import families
    from riskloom.plans.queries import inputs
    from riskloom.plans.tuning import search

    made, real = [], families.encoder
    monkeypatch.setattr(families, "encoder", lambda *a: made.append(a) or real(*a))
    given = inputs(spark, "/root/testdata/sf0.001")
    one = replace(given, geo_config=given.geo_config.filter("GEO = 'EUR'"))
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    found = search(one, str(tmp_path), [{"depth": 1}, {"depth": 2}], [1], 199912, 200006)
    assert found.count() == 2 and len(made) == 1
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= held
