import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from tabfold.operators import impute as I
from tabfold.operators import profile as P
from tabfold.plans import ensemble as E
from tabfold.plans import learners as L
from tabfold.plans import linear
from tabfold.plans import validate as V
from tabfold.plans.q_learn import FEATS, order_table
from tabfold.plans.scoring import Scorer, train_job
from tabfold.session import scratch_path
from tabfold.sources import csv as CSV
from tabfold.streaming.score_stream import score_stream


@pytest.fixture(scope="module")
def orders(spark):
    return order_table(spark, SF001).cache()


def test_param_mapping_and_refusal():
    assert L.spark_params({"learning_rate": 0.1, "max_depth": 3.0, "colsample_bytree": 0.8}) == \
        {"stepSize": 0.1, "maxDepth": 3, "featureSubsetStrategy": "0.8"}
    with pytest.raises(ValueError):
        L.spark_params({"reg_lambda": 1.0})


def test_patience_rule():
    assert L.patience_best([5, 4, 3, 3.5, 3.6, 3.7], 3) == (3, True)
    assert L.patience_best([5, 4, 3, 2], 3) == (4, False)
    assert L.patience_best([1, 2], 1) == (1, True)


def test_early_stopping_and_contract(spark, orders):
    lrn = L.Learner("gbt_regressor", {"maxDepth": 2, "stepSize": 0.5}, early_stopping_rounds=2)
    cv = V.cross_validate(orders, lrn, FEATS, "y", "id", "rmse", k=2, start_rounds=4)
    assert cv.score >= 0 and cv.rounds >= 1
    assert cv.oof.count() == orders.count()
    assert cv.oof.select("id").distinct().count() == orders.count()
    fitted = L.fit(lrn, orders, FEATS, "y", rounds=3)
    assert fitted.model.stages[-1].getNumTrees == 3
    imp = L.feature_importance(fitted.model, FEATS)
    assert sum(r.importance for r in imp.collect()) == pytest.approx(100.0)


def test_linear_fold_fit_matches_direct_fit(spark, orders):
    folded = V.assign_folds(orders, "id", 3)
    fit = linear.fit_folds(folded, ["qty", "n_lines"], "y", "fold")
    for f in range(3):
        direct = linear.fit_all(folded.where(F.col("fold") != f), ["qty", "n_lines"], "y")
        a = fit.table.where(F.col("fold") == f).first()
        b = direct.table.first()
        assert a["_intercept"] == pytest.approx(b["_intercept"], rel=1e-9)
        assert a["_b0"] == pytest.approx(b["_b0"], rel=1e-9)


def test_ridge_matches_spark_linear_regression(spark, orders):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    alpha = 5.0
    ours = linear.fit_all(orders, ["qty", "n_lines"], "y", alpha).table.first()
    n = orders.count()
    sd = orders.agg(F.stddev_pop("y")).first()[0]
    v = VectorAssembler(inputCols=["qty", "n_lines"], outputCol="f").transform(orders)
    lr = LinearRegression(featuresCol="f", labelCol="y", regParam=alpha / n * sd, elasticNetParam=0.0,
                          standardization=False, solver="normal").fit(v)
    assert ours["_b0"] == pytest.approx(lr.coefficients[0], rel=1e-6)
    assert ours["_intercept"] == pytest.approx(lr.intercept, rel=1e-6)


def test_simplex_weights():
    import numpy as np
    E_ = np.array([[1.0, 0.2], [0.2, 4.0]])
    v = E.simplex_least_squares(E_, np.zeros(2))
    assert v.sum() == pytest.approx(1.0) and (v >= 0).all()
    t = (4.0 - 0.2) / (1.0 + 4.0 - 0.4)
    assert v[0] == pytest.approx(t)


def test_identity_and_drop_sparse_roundtrip(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    df = spark.createDataFrame([(1, None, 1.0), (2, None, None), (3, 5.0, 2.0)], "id long, a double, b double")
    assert Pipeline(stages=[]).fit(df).transform(df).collect() == df.collect()
    pm = Pipeline(stages=[P.DropSparse(maxNullPct=60.0), I.MedianImputer(inputCols=["b"])]).fit(df)
    out = pm.transform(df)
    assert out.columns == ["id", "b"] and [r.b for r in out.orderBy("id").collect()] == [1.0, 1.5, 2.0]
    path = str(tmp_path / "pm")
    pm.write().overwrite().save(path)
    again = PipelineModel.load(path).transform(df)
    assert again.collect() == out.collect()


def test_batch_equals_stream(spark, orders):
    run = scratch_path(spark, f"t-{os.getpid()}-{id(orders)}")
    train_job(spark, orders, "id", FEATS, "y", "y_class", L.default_learner("linear"), f"{run}/m", k=2)
    batch = Scorer.load(spark, f"{run}/m").score(orders)
    orders.select("id", *FEATS).write.mode("overwrite").parquet(f"{run}/in")
    stream = score_stream(spark, f"{run}/in", f"{run}/m", f"{run}/out", f"{run}/ck")
    assert batch.exceptAll(stream).count() == 0 and stream.exceptAll(batch).count() == 0


def test_csv_load_names_and_na_tokens(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("Id,Basic Demos-Age,MasVnrType,SalePrice\n1,12,None,100\n2,NA,Stone,\n3,7,,300\n")
    df = CSV.load_labelled(spark, str(p), "SalePrice", key="Id")
    assert df.columns == ["Id", "Basic_Demos_Age", "MasVnrType", "SalePrice"]
    rows = {r.Id: r for r in df.collect()}
    assert set(rows) == {1, 3}
    assert rows[1].MasVnrType is None and rows[3].Basic_Demos_Age == 7


def test_survey_preprocessor_fit_transform_roundtrip(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    from tabfold.operators.preprocess import SurveyPreprocessor
    rows = [(1, "Spring", 10.0, None, 2.0, 4.0), (2, "", 20.0, None, 0.0, 5.0), (3, None, 30.0, 1.0, 3.0, 6.0)]
    df = spark.createDataFrame(rows, "id long, A_Season string, PCIAT_x double, Sparse double, a double, b double")
    pre = SurveyPreprocessor(products={"ab": ("a", "b")}, ratios={"a_b": ("a", "b"), "s_b": ("Sparse", "b")},
                             protect=["id"])
    pm = Pipeline(stages=[pre]).fit(df)
    out = pm.transform(df).orderBy("id")
    assert out.columns == ["id", "A_Season", "a", "b", "ab", "a_b"]
    assert [r.A_Season for r in out.collect()] == [0, -1, -1]
    assert pm.stages[0].skipped(df.columns) == ["s_b"]
    pm.write().overwrite().save(str(tmp_path / "pre"))
    assert PipelineModel.load(str(tmp_path / "pre")).transform(df).orderBy("id").collect() == out.collect()


def test_cached_folds_guard(spark, orders):
    cache = V.CachedFolds(orders, "id", "y", FEATS, k=2)
    cache.check(orders)
    with pytest.raises(ValueError):
        cache.check(orders.limit(5))


@pytest.mark.parametrize("kind", ["rf_classifier", "mlp_classifier", "gbt_multiclass", "gbt_classifier"])
def test_classification_learners(spark, kind):
    from tabfold.plans.q_learn import doc_table
    df = doc_table(spark, SF001).cache()
    lrn = L.default_learner(kind)
    feats = ["wpc", "n_chars", "n_sent"]
    res = L.fit(lrn, df, feats, "quality", rounds=5 if kind == "gbt_classifier" else None)
    pred = L.predict(res.model, df)
    assert pred.count() == df.count()
    assert set(r[0] for r in pred.select("prediction").distinct().collect()) <= {0.0, 1.0}


def test_multiclass_gbt_on_severity(spark, orders):
    lrn = L.default_learner("gbt_multiclass").with_params(maxIter=3)
    res = L.fit(lrn, orders, FEATS, "y_class")
    classes = {r[0] for r in L.predict(res.model, orders).select("prediction").distinct().collect()}
    assert classes <= {0.0, 1.0, 2.0, 3.0} and len(classes) >= 2


def test_copula_marginals_and_categories(spark):
    from tabfold.operators import synth as SY
    o = spark.read.parquet(f"{SF01}/orders.parquet").select("o_totalprice", "o_orderstatus")
    cop = SY.fit_copula(o, ["o_totalprice", "o_orderstatus"])
    syn = SY.sample(spark, cop, 20_000, seed=3)
    real = o.groupBy("o_orderstatus").count().toPandas().set_index("o_orderstatus")["count"]
    fake = syn.groupBy("o_orderstatus").count().toPandas().set_index("o_orderstatus")["count"]
    assert set(fake.index) <= set(real.index)
    for k in real.index:
        assert abs(fake.get(k, 0) / 20_000 - real[k] / real.sum()) < 0.03
    qs = syn.approxQuantile("o_totalprice", [0.25, 0.5, 0.75], 0.001)
    rq = o.approxQuantile("o_totalprice", [0.25, 0.5, 0.75], 0.001)
    for a, b in zip(qs, rq):
        assert abs(a - b) / b < 0.05
