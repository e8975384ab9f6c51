from datetime import date

import pytest
from pyspark.sql import functions as F

from riskloom.functions.dates import (
    days_before,
    month_end,
    month_index,
    month_plus,
    previous_month,
    shift_month,
    text_to_date,
)
from riskloom.functions.drivers import (
    DRIVER_TYPE,
    driver_names,
    driver_sentence,
    number_text,
    raising,
    raw_values,
    readable,
    strongest,
)
from riskloom.operators.feed import ews_feed
from riskloom.plans.backtest import top_drivers


@pytest.mark.parametrize(
    "text, expected",
    [
        ("1/5/2024 0:00", date(2024, 1, 5)),
        ("01/15/2024 13:05", date(2024, 1, 15)),
        ("2024-01-05T10:00", date(2024, 1, 5)),
        ("2024-01-05", date(2024, 1, 5)),
        ("2024", None),
        ("1/5/2024", None),
        ("13/45/2024 0:00", None),
        ("2024-02-31", None),
        ("junk", None),
        (None, None),
    ],
)
def test_text_to_date(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(text_to_date(F.col("s"))).first()[0] == expected


def test_months_cross_the_year(spark):
    assert month_plus(202401, -3) == 202310
    assert month_plus(202312, 1) == 202401
    assert month_plus(200104, -3) == 200101
    assert previous_month(date(2026, 1, 3)) == 202512
    df = spark.createDataFrame([(202401,), (202312,)], "ym long")
    rows = df.select(shift_month(F.col("ym"), -3).alias("s"), month_index(F.col("ym")).alias("i"), month_end(F.col("ym")).alias("e")).collect()
    assert [r.s for r in rows] == [202310, 202309]
    assert rows[0].i - rows[1].i == 1
    assert rows[0].e == date(2024, 1, 31)


def test_days_before_is_negative_after_the_snapshot(spark):
    df = spark.createDataFrame([(date(2024, 2, 2),)], "d date")
    end = F.lit(date(2024, 1, 31))
    assert df.select(days_before(end, F.col("d"))).first()[0] == -2


@pytest.mark.parametrize("value, text", [(58.0, "58"), (58.1, "58.1"), (0.0, "0"), (100.0, "100"), (-2.5, "-2.5"), (None, None)])
def test_number_text(spark, value, text):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(number_text(F.col("x"))).first()[0] == text


def drivers(spark, entries):
    return spark.createDataFrame([(entries,)], f"d {DRIVER_TYPE}")


def test_drivers_cut_by_size_before_the_sign(spark):
    df = drivers(spark, [("a", "1", 0.1), ("b", "2", -0.9), ("c", "3", 0.5)])
    top = df.select(strongest(F.col("d"), 2).alias("d"))
    assert [x.feature for x in top.first().d] == ["b", "c"]
    ranked = top.select(raising(F.col("d")).alias("r")).first().r
    assert [(x.driver_rank, x.feature) for x in ranked] == [(1, "c")]


def test_tied_drivers_share_a_rank(spark):
    df = drivers(spark, [("z", "1", 0.5), ("a", None, 0.5), ("m", "3", 0.1)])
    row = df.select(raising(F.col("d")).alias("r"))
    assert [(x.driver_rank, x.feature) for x in row.first().r] == [(1, "a"), (1, "z"), (3, "m")]
    assert row.select(driver_names(F.col("r"), 2)).first()[0] == "a, z"
    text = row.select(driver_sentence(F.col("r"))).first()[0]
    assert text == "1. a = NULL (+0.500)  |  1. z = 1 (+0.500)  |  3. m = 3 (+0.100)"


def test_no_positive_driver(spark):
    row = drivers(spark, [("a", "1", -0.5), ("b", "1", 0.0)]).select(raising(F.col("d")).alias("r"))
    assert row.first().r == []
    assert row.select(driver_names(F.col("r"), 3)).first()[0] is None


def test_values_are_written_alike_for_every_family(spark):
    df = spark.createDataFrame([(5e-7, -0.0, 0.1234565, 1e25, True, "007", None, 2**60)], "a double, b double, c double, d double, e boolean, f string, g double, h long")
    names = df.columns
    rows = F.transform(raw_values(df, names), lambda v, i: F.struct(F.get(F.lit(names), i).alias("feature"), v.alias("feature_value"), F.lit(1.0).alias("contribution")))
    shown = df.select(readable(rows.cast(DRIVER_TYPE), df, names).alias("d")).first().d
    plain = df.select(*[F.col(c) if c == "f" else number_text(F.col(c)).alias(c) for c in names]).first()
    assert [x.feature_value for x in shown] == list(plain)


def test_alert_without_drivers_stays_in_the_feed(spark):
    employee = spark.createDataFrame([("A", "E1", 202401, 0.9, "RED"), ("A", "E2", 202401, 0.8, "AMBER"), ("A", "E3", 202401, 0.1, "GREEN")], "geo string, EMP_ID string, YEAR_MONTH long, risk_score double, risk_bucket string")
    variable = spark.createDataFrame([("A", "E1", 202401, 1, "age", "40", 0.25)], "geo string, EMP_ID string, YEAR_MONTH long, driver_rank long, feature string, feature_value string, risk_contribution double")
    rows = {r.EMP_ID: [d.feature for d in r.top_variable_risks] for r in ews_feed(employee, variable).collect()}
    assert rows == {"E1": ["age"], "E2": []}


def test_reports_show_every_geo(spark):
    drivers = spark.createDataFrame([(g, f"f{k:02d}", float(k)) for g in "AB" for k in range(20)], "geo string, feature string, attribution double")
    kept = {(r.geo, r.feature) for r in top_drivers(drivers).collect()}
    assert kept == {(g, f"f{k:02d}") for g in "AB" for k in range(5, 20)}
