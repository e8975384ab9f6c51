import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskloom.errors import ConfigError
from riskloom.operators import features as X
from riskloom.operators.routing import (
    backtest_rows,
    calibration_rows,
    class_weights,
    eval_start,
    history_rows,
    matured_rows,
    route_to_geos,
)
from riskloom.sources.files import column_table, load_csv, schema_from_json, schema_from_text
from riskloom.sources.scratch import local_table

CONFIG = {"MODEL_FEATURES": ["target", "EMP_ID", "A", "B", "C", "GONE"], "ONE": [1, 1, 1, 0, None, 1], "TWO": [1, 1, 1, 1, 1, 1]}


def config(spark):
    return local_table(
        spark,
        {"MODEL_FEATURES": pa.array(CONFIG["MODEL_FEATURES"]), "ONE": pa.array(CONFIG["ONE"], pa.int64()), "TWO": pa.array(CONFIG["TWO"], pa.int64())},
    )


def geos(spark, *names):
    return local_table(spark, {"GEO": pa.array(list(names), pa.string())})


def data(spark):
    return spark.createDataFrame([("E1", 202401, 1, 1.0, 2.0, "x", None)], "EMP_ID string, YEAR_MONTH long, target long, A double, B double, C string, GEO string")


def selected(spark, wide, names):
    exclusions = X.feature_exclusions(spark, [("target", "Label"), ("EMP_ID", "Identifier")])
    return X.selected_features(X.feature_flags(wide, names), data(spark), exclusions)


def test_empty_flags_are_dropped(spark):
    assert X.feature_flags(config(spark), ["ONE", "TWO"]).count() == 11


def test_lists_hold_flagged_present_and_allowed_columns(spark):
    assert X.feature_lists(selected(spark, config(spark), ["ONE", "TWO"])) == {"ONE": ["A"], "TWO": ["A", "B", "C"]}


def test_geo_without_column(spark):
    with pytest.raises(ConfigError, match="THREE"):
        X.feature_flags(config(spark), ["ONE", "THREE"])


@pytest.mark.parametrize("bad", ["AAA", "ZZZ"])
def test_guard_names_the_geo_wherever_it_sorts(spark, bad):
    wide = X.add_geo_column(config(spark), bad)
    names = geos(spark, "ONE", "TWO", bad)
    chosen = selected(spark, wide, ["ONE", "TWO", bad])
    with pytest.raises(ConfigError, match=f"No features resolved for geo {bad}"):
        X.config_guard(names, chosen, X.bucket_config(names))


def test_guard_wants_a_bucket_rule(spark):
    with pytest.raises(ConfigError, match="No bucket rule for geo TWO"):
        X.config_guard(geos(spark, "ONE", "TWO"), selected(spark, config(spark), ["ONE", "TWO"]), X.bucket_config(geos(spark, "ONE")))


def test_config_edits(spark):
    wide = X.set_flag(config(spark), "A", "ONE", 0)
    assert "ONE" not in X.feature_lists(selected(spark, wide, ["ONE", "TWO"]))
    wide = X.add_geo_column(config(spark), "IND", "TWO")
    assert X.feature_lists(selected(spark, wide, ["IND", "TWO"]))["IND"] == ["A", "B", "C"]
    assert X.drop_geo_column(wide, "IND").columns == config(spark).columns
    rows = X.delete_rows(X.insert_rows(geos(spark, "A", "B"), {"GEO": pa.array(["C"])}), F.col("GEO") == "A")
    assert sorted(r.GEO for r in rows.collect()) == ["B", "C"]
    rules = X.bucket_config(geos(spark, "A", "B"))
    change = spark.createDataFrame([("B", 0.9)], "geo string, red_threshold double")
    assert {r.geo: r.red_threshold for r in X.update_by_key(rules, change, "geo").collect()} == {"A": 0.7, "B": 0.9}


def test_dates_become_days_and_geo_is_ensured(spark):
    df = spark.createDataFrame([(202401, "1/30/2024 0:00"), (202401, "2024-02-02")], "YEAR_MONTH long, D string")
    out = X.model_features(df, ["D"])
    assert [r.D for r in out.collect()] == [1, -2]
    assert dict(out.dtypes)["D"] == "bigint" and dict(out.dtypes)["GEO"] == "string"
    dictionary = spark.createDataFrame([("D", "date"), ("A", "numeric")], "feature string, role string")
    assert X.date_columns_of(dictionary) == ["D"]


def test_guard_list_of_the_hr_store(spark):
    assert X.feature_exclusions(spark).count() == 21 and len(X.HR_DATE_COLUMNS) == 10


def test_routing(spark):
    df = spark.createDataFrame([("E1", "A"), ("E2", None), ("E3", "X")], "EMP_ID string, GEO string")
    got = sorted((r.EMP_ID, r.geo) for r in route_to_geos(df, ["A", "B"]).collect())
    assert got == [("E1", "A"), ("E2", "A"), ("E2", "B")]


def test_windows_cross_january(spark):
    months = [202309, 202310, 202311, 202312, 202401]
    df = spark.createDataFrame([(m, 1 if m != 202311 else None) for m in months], "YEAR_MONTH long, target long")
    assert eval_start(202401) == 202310
    assert [(r.YEAR_MONTH, r.is_eval) for r in history_rows(df, 202401).orderBy("YEAR_MONTH").collect()] == [
        (202309, False), (202310, True), (202312, True),
    ]
    assert [r.YEAR_MONTH for r in calibration_rows(df, 202401).orderBy("YEAR_MONTH").collect()] == [202310, 202312]
    assert [r.is_eval for r in backtest_rows(df, 202310, 202312).orderBy("YEAR_MONTH").collect()] == [False, False, True]
    assert matured_rows(df, 202401, 3).count() == 2


def test_class_weights(spark):
    df = spark.createDataFrame([("A", 1)] * 3 + [("A", 0)] + [("B", 1)], "geo string, target long")
    got = {(r.geo, r.target): r.weight for r in class_weights(df).collect()}
    assert got == {("A", 1): 4 / 6, ("A", 0): 2.0, ("B", 1): 1.0}


def test_csv_with_declared_schema(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps([{"name": "GEO", "type": "STRING"}, {"name": "N", "type": "INT64"}, {"name": "X", "type": "FLOAT64"}]))
    (tmp_path / "s.txt").write_text("GEO:STRING,N:INT64,X:FLOAT64")
    schema = schema_from_json(str(tmp_path / "s.json"))
    assert schema == schema_from_text(str(tmp_path / "s.txt"))
    (tmp_path / "d.csv").write_bytes(b"GEO,N,X\r\nULK,1,2.5\r\nKAS,2,\r\n")
    rows = load_csv(spark, str(tmp_path / "d.csv"), schema).collect()
    assert [(r.GEO, r.N, r.X) for r in rows] == [("ULK", 1, 2.5), ("KAS", 2, None)]
    (tmp_path / "bad.csv").write_text("GEO,N,X\nULK,one,2.5\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        load_csv(spark, str(tmp_path / "bad.csv"), schema).collect()
    (tmp_path / "order.csv").write_text("N,GEO,X\n1,ULK,2.5\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_csv(spark, str(tmp_path / "order.csv"), schema).collect()


def test_column_table(spark):
    rows = column_table(data(spark), "t").orderBy("position").collect()
    assert [(r.column_name, r.data_type) for r in rows][:3] == [("EMP_ID", "string"), ("YEAR_MONTH", "bigint"), ("target", "bigint")]
