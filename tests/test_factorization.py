"""Factorization machines from sums: Spark's own coefficients, one pass over the rows."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import FMRegressor
from pyspark.sql import functions as F

from tabfold.plans import factorization as FM
from tabfold.plans import learners as L

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(5)
    x = np.column_stack([r.uniform(1, 300, 300), r.integers(1, 8, 300), r.uniform(0, 0.1, 300)])
    y = 0.2 * x[:, 0] + 0.01 * x[:, 0] * x[:, 1] + r.normal(size=300)
    return spark.createDataFrame([(*map(float, v), float(t)) for v, t in zip(x, y)], "a double, b double, c double, y double").repartition(3).cache()


@pytest.mark.parametrize("params", [{"maxIter": 25}, {"regParam": 0.01, "factorSize": 3, "maxIter": 12}, {"fitLinear": False, "stepSize": 0.1, "maxIter": 12},
                                    {"fitIntercept": False, "stepSize": 0.01, "tol": 0.01}, {"solver": "gd", "stepSize": 1e-9, "regParam": 0.1, "maxIter": 8}])
def test_same_coefficients_as_spark(rows, params, monkeypatch):
    """Through ``fit``, with Spark's own fit out of reach: it runs a job over all rows an iteration."""
    want = FMRegressor(labelCol="y", seed=4, **params).fit(VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows))
    monkeypatch.setattr(FMRegressor, "fit", None)
    monkeypatch.setattr(FMRegressor, "_fit", None)
    got = L.fit(L.Learner("fm_regressor", params, seed=4), rows, NAMES, "y").model.stages[-1]
    assert np.allclose(got.factors.toArray(), want.factors.toArray(), rtol=1e-9, atol=1e-12)
    assert np.allclose(got.linear.toArray(), want.linear.toArray(), rtol=1e-9, atol=1e-12)
    assert got.intercept == pytest.approx(want.intercept, rel=1e-9, abs=1e-12) and got.getFactorSize() == want.getFactorSize()


def test_odd_rows(rows, spark, tmp_path):
    lrn = L.Learner("fm_regressor", {"maxIter": 3})
    for bad in (rows.withColumn("y", F.when(F.col("b") > 3, F.col("y"))), rows.withColumn("y", F.when(F.col("b") > 3, F.col("y")).otherwise(float("inf"))),
                rows.withColumn("a", F.when(F.col("b") > 3, F.col("a")).otherwise(float("-inf")))):
        with pytest.raises(Exception, match="infinite"):
            L.fit(lrn, bad, NAMES, "y")
    vectors = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows.where("false"))
    own = FMRegressor(labelCol="y", seed=1, maxIter=3)
    assert np.allclose(FM.fit(own, vectors, 3).factors.toArray(), own.fit(vectors).factors.toArray())          # the start
    one = L.fit(lrn, rows.withColumn("b", F.when(F.col("b") > 3, F.col("b"))), ["a", "b"], "y").model           # a missing feature is filled
    one.write().overwrite().save(str(tmp_path / "m"))
    a, b = ([r["prediction"] for r in m.transform(rows.limit(5)).collect()] for m in (one, PipelineModel.load(str(tmp_path / "m"))))
    assert a == b and np.isfinite(a).all()


def test_samples_of_rows_and_many_features_are_left_to_spark():
    assert FM.by_sums(FMRegressor(), 31) and not FM.by_sums(FMRegressor(), 32) and not FM.by_sums(FMRegressor(miniBatchFraction=0.5), 3)
