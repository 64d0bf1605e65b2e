import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from tabfold.operators.quantiles import exact_medians, exact_quantile, to_long
from tabfold.sources.tables import read_table


@pytest.mark.parametrize("band", [50, 1000, 10**9])
def test_band_narrowing_matches_numpy(spark, band):
    li = read_table(spark, SF01, "lineitem")
    cols = ["l_extendedprice", "l_quantity", "l_discount"]
    got = {r["column"]: r["value"] for r in exact_medians(li, cols, max_band=band, small=0).collect()}
    pdf = li.select(*cols).toPandas()
    for c in cols:
        assert got[c] == pytest.approx(float(np.median(pdf[c].to_numpy())), abs=1e-9)


def test_grouped_quantiles_and_even_odd(spark):
    rows = [(g, float(v)) for g, vals in {0: [1, 2, 4, 10], 1: [5, 1, 3], 2: [7]}.items() for v in vals]
    rows += [(3, None)]
    df = spark.createDataFrame(rows, "g int, x double")
    out = {r["g"]: r["value"] for r in exact_medians(df, ["x"], by=["g"], max_band=1, small=0).collect()}
    assert out == {0: 3.0, 1: 3.0, 2: 7.0}      # all-null group absent


def test_quantile_interpolation(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "x double")
    q = exact_quantile(to_long(df, ["x"]), 0.25, max_band=2, small=0).first()["value"]
    assert q == pytest.approx(2.5)


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),)], "x double")
    assert exact_medians(df, ["x"]).first()["value"] == pytest.approx(1.5)


def test_heavy_ties(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.lit(7.0))
                                  .otherwise(F.col("id").cast("double")).alias("x"))
    pdf = df.toPandas()
    got = exact_medians(df, ["x"], max_band=10, small=0).first()["value"]
    assert got == pytest.approx(float(np.median(pdf["x"])))


@pytest.mark.parametrize("band", [20, 500, 10**9])
def test_complement_quantile_matches_brute_force(spark, band):
    from tabfold.operators.folds import kfold
    from tabfold.operators.quantiles import complement_quantile
    li = kfold(read_table(spark, SF01, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 4)
    cols = ["l_extendedprice", "l_quantity"]
    pdf = li.select("fold", *cols).toPandas()
    got = {(r.train_fold, r.column): r.value
           for r in complement_quantile(to_long(li, cols, ["fold"]), 4, max_band=band).collect()}
    for t in range(4):
        for c in cols:
            want = float(np.median(pdf.loc[pdf.fold != t, c].to_numpy()))
            assert got[(t, c)] == pytest.approx(want, abs=1e-9), (t, c, band)


TIES = {"coin": lambda r: r.integers(0, 2, 6001), "fifty": lambda r: r.integers(1, 51, 6000),
        "half": lambda r: np.repeat([3.0, 8.0], 3000), "third": lambda r: np.where(np.arange(6000) % 3 == 0, 7.0, np.arange(6000)),
        "wide": lambda r: np.concatenate([r.normal(size=3000) * 1e9, np.zeros(3001)])}


@pytest.mark.parametrize("band", [1, 5, 2000])
@pytest.mark.parametrize("kind", sorted(TIES))
def test_ties_never_stop_the_search(spark, kind, band):
    from tabfold.operators.quantiles import complement_quantile
    x = np.asarray(TIES[kind](np.random.default_rng(2)), float)
    df = spark.createDataFrame([(i % 3, float(v)) for i, v in enumerate(x)], "fold int, x double")
    assert exact_medians(df, ["x"], max_band=band, small=0).first()["value"] == pytest.approx(float(np.median(x)))
    got = {r.train_fold: r.value for r in complement_quantile(to_long(df, ["x"], ["fold"]), 3, max_band=band).collect()}
    for t in range(3):
        assert got[t] == pytest.approx(float(np.median(x[np.arange(len(x)) % 3 != t])))


def test_null_groups_and_mixed_sizes(spark):
    rows = [(None, float(v)) for v in range(9)] + [("a", 1.0), ("a", 4.0)] + [("b", float(v)) for v in range(50)]
    out = {r["g"]: r["value"] for r in exact_medians(spark.createDataFrame(rows, "g string, x double"), ["x"], by=["g"], max_band=2, small=5).collect()}
    assert out == {None: 4.0, "a": 2.5, "b": 24.5}
