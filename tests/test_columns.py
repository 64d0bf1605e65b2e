import math

import pytest
from pyspark.sql import functions as F

from tabfold.functions import columns as C
from tabfold.sources import schema as S


def col(df, expr, key="id"):
    return {r[0]: r[1] for r in df.select(key, expr).collect()}


def test_sanitize_and_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`Basic_Demos-Age` int, `a b!c` int")
    assert C.sanitize_columns(df).columns == ["Basic_Demos_Age", "a_b_c"]
    bad = spark.createDataFrame([(1, 2)], "`a-b` int, `a b` int")
    with pytest.raises(ValueError):
        C.sanitize_columns(bad)


def test_seasons(spark):
    rows = [(1, "Spring"), (2, "Summer"), (3, "Fall"), (4, "Winter"), (5, ""), (6, None), (7, "Autumn")]
    df = spark.createDataFrame(rows, "id long, a_Season string")
    out = col(C.encode_seasons(df), "a_Season")
    assert out == {1: 0, 2: 1, 3: 2, 4: 3, 5: -1, 6: -1, 7: -1}


def test_ratios_null_on_zero(spark):
    rows = [(1, 6.0, 3.0), (2, None, 1.0), (3, 1.0, 0.0), (4, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    r = col(C.feature_ratios(df, {"r": ("a", "b")}), "r")
    p = col(C.feature_products(df, {"p": ("a", "b")}), "p")
    assert r == {1: 2.0, 2: None, 3: None, 4: None}
    assert p == {1: 18.0, 2: None, 3: 0.0, 4: 0.0}


def test_left_closed_bins(spark):
    rows = [(1, 29.999), (2, 30.0), (3, 49.999), (4, 50.0), (5, 79.999), (6, 80.0), (7, -3.0), (8, None)]
    df = spark.createDataFrame(rows, "id long, score double")
    assert col(df, C.scaled_class("score", 1.0)) == {1: 0, 2: 1, 3: 1, 4: 2, 5: 2, 6: 3, 7: 0, 8: None}


def test_right_closed_inner_bins(spark):
    rows = [(1, 4.0), (2, 5.0), (3, 12.0), (4, 12.5), (5, 18.0), (6, 22.0), (7, 23.0)]
    df = spark.createDataFrame(rows, "id long, age double")
    out = col(df, C.ordinal_bin("age", [4, 12, 18, 22], right=True, open_ends=False))
    assert out == {1: None, 2: 0, 3: 0, 4: 1, 5: 1, 6: 2, 7: None}


def test_items_row_sum_and_certain_class(spark):
    items = [f"q{i:02d}" for i in range(1, 21)]
    complete = [1] + [5] * 6 + [0] * 14               # total 30 -> class 0
    near = [2] + [5] * 6 + [None] + [0] * 13          # total 30, one missing -> max 35 -> uncertain
    allnull = [3] + [None] * 20
    df = spark.createDataFrame([tuple(complete), tuple(near), tuple(allnull)],
                               "id long, " + ", ".join(f"{c} int" for c in items))
    nm = C.row_null_count(items)
    out = df.select("id", C.row_sum(items).alias("t"), nm.alias("nm"),
                    C.keep_if_complete(C.row_sum(items), items).alias("tc"),
                    C.certain_class(C.row_sum(items), nm).alias("cls")).orderBy("id").collect()
    assert [(r.t, r.nm, r.tc, r.cls) for r in out] == [(30.0, 0, 30.0, 0), (30.0, 1, None, None),
                                                       (0.0, 20, None, None)]


def test_round_half_even(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 1.5), (3, 2.5), (4, -0.5)], "id long, x double")
    assert col(df, C.round_half_even("x")) == {1: 0.0, 2: 2.0, 3: 2.0, 4: -0.0}


def test_round6_matches_python_half_up_away_from_ties(spark):
    df = spark.createDataFrame([(1, 1.23456749), (2, 2.0000005000001), (3, -1.5)], "id long, x double")
    got = col(df, C.round6("x"))
    assert got[1] == 1.234567 and got[2] == 2.000001 and got[3] == -1.5


def test_label_map_and_order(spark):
    df = spark.createDataFrame([(1, 0), (2, 3), (3, None)], "id long, c int")
    assert col(df, C.label_map("c", {0: "None", 3: "Severe"})) == {1: "None", 2: "Severe", 3: "Missing"}


def test_dtype_map():
    from pyspark.sql import types as T
    assert S.map_dtype(T.LongType()) == "int"
    assert S.map_dtype(T.DoubleType()) == "float"
    assert S.map_dtype(T.StringType()) == "str"
    assert S.map_dtype(T.BooleanType()) == "str"


def test_enforce_rejects(spark):
    df = spark.createDataFrame([("1", "2.5"), ("x", "3"), (None, "1")], "a string, b string")
    ok, bad = S.split_rejects(df, {"fields": {"a": "int", "b": "float"}})
    assert ok.count() == 1 and bad.count() == 2


def test_weighted_average(spark):
    df = spark.createDataFrame([(1, 1.0, 3.0)], "id long, a double, b double")
    assert col(df, C.weighted_average(["a", "b"], [1.0, 3.0])) == {1: 2.5}
    with pytest.raises(ValueError):
        C.weighted_average(["a"], [0.0])
