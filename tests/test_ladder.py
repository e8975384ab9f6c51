import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators.buckets import assign_bucket, calibrate, capture_report, target_cutoffs
from riskloom.operators.evaluate import choose_champion, evaluate, parity, roc_curve
from riskloom.operators.ladder import score_ladder, with_rank


def made(seed=3, n=4000):
    rng = np.random.default_rng(seed)
    # one geo holds most rows, and a third of its rows share one score
    score = np.round(rng.random(n), 3)
    score[: n // 3] = 0.5
    return pd.DataFrame(
        {
            "geo": np.where(rng.random(n) < 0.8, "AAA", "BBB"),
            "EMP_ID": [f"E{i}" for i in range(n)],
            "risk_score": score,
            "target": (rng.random(n) < score).astype("int64"),
            "model_family": "m",
        }
    )


@pytest.fixture(params=[0, 20_000], ids=["blocks", "one window"])
def small_rows(request, spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ladder_equals_brute_force(spark, small_rows):
    data = made()
    got = score_ladder(
        spark.createDataFrame(data), ["geo"], "risk_score", {"n": F.lit(1), "pos": F.col("target")}, small_rows
    ).toPandas()
    assert len(got) == len(data[["geo", "risk_score"]].drop_duplicates())
    for r in got.sample(200, random_state=1).itertuples():
        own = data[data.geo == r.geo]
        above = own[own.risk_score > r.risk_score]
        assert (r.n_above, r.pos_above) == (len(above), above.target.sum())
        assert (r.n_total, r.pos_total) == (len(own), own.target.sum())
        assert r.n == (own.risk_score == r.risk_score).sum()


def test_rank_with_ties(spark, small_rows):
    data = made()
    got = with_rank(spark.createDataFrame(data), ["geo"], "risk_score", "place", small_rows).toPandas()
    want = data.assign(want=data.groupby("geo").risk_score.rank(method="min", ascending=False).astype(int))
    both = got.merge(want, on="EMP_ID")
    assert len(both) == len(data)
    assert (both.place == both.want).all()


def rules(spark, *rows):
    return spark.createDataFrame(
        list(rows), "geo string, method string, red_top_pct long, amber_next_pct long, red_threshold double, amber_threshold double"
    )


def test_calibration_is_the_discrete_percentile(spark):
    data = made()
    cut = calibrate(
        spark.createDataFrame(data),
        rules(spark, ("AAA", "PERCENTILE", 10, 20, 0.7, 0.4), ("BBB", "FIXED", 10, 20, 0.61, 0.31), ("CCC", "PERCENTILE", 10, 20, 0.7, 0.4)),
    )
    found = {r.geo: r for r in cut.collect()}
    own = np.sort(data[data.geo == "AAA"].risk_score.to_numpy())
    assert found["AAA"].red_threshold == own[int(np.ceil(0.9 * len(own))) - 1]
    assert found["AAA"].amber_threshold == own[int(np.ceil(0.7 * len(own))) - 1]
    assert (found["BBB"].red_threshold, found["BBB"].amber_threshold) == (0.61, 0.31)
    assert (found["CCC"].red_threshold, found["CCC"].n_scores) == (0.7, 0)


def test_all_scores_equal_are_red(spark):
    df = spark.createDataFrame([("AAA", 0.5, 1)] * 7, "geo string, risk_score double, target long")
    cut = calibrate(df, rules(spark, ("AAA", "PERCENTILE", 10, 20, 0.7, 0.4)))
    assert {r.risk_bucket for r in assign_bucket(df, cut).collect()} == {"RED"}


def test_capture_without_events(spark):
    df = spark.createDataFrame([("AAA", 0.9, 0), ("AAA", 0.1, 0)], "geo string, risk_score double, target long")
    cut = spark.createDataFrame([("AAA", 0.8, 0.4)], "geo string, red_threshold double, amber_threshold double")
    rows = {r.bucket: r for r in capture_report(df, cut).collect()}
    assert rows["1-RED"].employees == 1 and rows["1-RED"].share_of_all_events is None


def test_auc_and_roc(spark):
    data = made()
    got = {r.geo: r for r in evaluate(spark.createDataFrame(data)).collect()}
    for geo, own in data.groupby("geo"):
        pos, neg = own[own.target == 1].risk_score.to_numpy(), own[own.target == 0].risk_score.to_numpy()
        wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
        assert got[geo].roc_auc == pytest.approx(wins / (len(pos) * len(neg)))
        assert got[geo].accuracy == pytest.approx(((own.risk_score >= 0.5) == (own.target == 1)).mean())
    curve = roc_curve(spark.createDataFrame(data)).filter("geo = 'AAA'").toPandas().sort_values("threshold")
    assert curve.recall.iloc[0] == 1.0 and curve.false_positive_rate.iloc[0] == 1.0
    assert (np.diff(curve.recall) <= 0).all()


def test_one_class_only(spark):
    df = spark.createDataFrame([("A", "m", 0.3, 1), ("A", "m", 0.6, 1)], "geo string, model_family string, risk_score double, target long")
    row = evaluate(df).first()
    assert row.roc_auc is None and row.recall == 0.5


def test_target_cutoffs(spark):
    df = spark.createDataFrame(
        [("A", s, t) for s, t in [(0.9, 1), (0.8, 1), (0.7, 0), (0.6, 1), (0.5, 0)]], "geo string, risk_score double, target long"
    )
    row = target_cutoffs(df, 0.75, 0.6).first()
    assert (row.precision_cutoff, row.recall_cutoff) == (0.6, 0.8)


def test_champion_and_parity(spark):
    m = spark.createDataFrame(
        [("A", "old", 0.60), ("A", "new", 0.61), ("B", "old", 0.60), ("B", "new", 0.70), ("C", "old", 0.6), ("C", "new", 0.6)],
        "geo string, model_family string, roc_auc double",
    )
    chosen = {r.geo: r.approved_family for r in choose_champion(m, "old", 0.02).collect()}
    assert chosen == {"A": "old", "B": "new", "C": "old"}
    verdict = {r.geo: r.verdict for r in parity(m.filter("model_family='old'"), m.filter("model_family='new'")).collect()}
    assert verdict == {"A": "EQUAL", "B": "BETTER", "C": "EQUAL"}
