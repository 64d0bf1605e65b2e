"""Contract suites in the reference's style: every learner through every
trainer, optimisers and ensembles on tiny data (k=2, patience 1)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tabfold.plans import ensemble as E
from tabfold.plans import learners as L
from tabfold.plans import tuning as T
from tabfold.plans import validate as V
from tabfold.plans.q_learn import FEATS, doc_table, order_table

REG = ["gbt_regressor", "rf_regressor", "linear", "fm_regressor"]
CLF = ["gbt_classifier", "rf_classifier", "mlp_classifier"]
DOC_FEATS = ["wpc", "n_chars", "n_sent"]


@pytest.fixture(scope="module")
def reg_data(spark):
    return order_table(spark, SF001).withColumn("_group", F.col("id") % 7).cache()


@pytest.fixture(scope="module")
def clf_data(spark):
    return doc_table(spark, SF001).withColumn("_group", F.col("doc_id") % 5).cache()


def _learner(kind):
    lrn = L.default_learner(kind)
    lrn.early_stopping_rounds = 1
    if kind.startswith("rf"):
        lrn = lrn.with_params(numTrees=5, maxDepth=3)
    if kind == "fm_regressor":
        lrn = lrn.with_params(maxIter=5)
    return lrn


@pytest.mark.parametrize("trainer", ["holdout", "cv", "cached", "grouped"])
@pytest.mark.parametrize("kind", REG + CLF)
def test_trainer_contract(spark, reg_data, clf_data, kind, trainer):
    clf = kind in CLF
    df, feats, label, key = (clf_data, DOC_FEATS, "quality", "doc_id") if clf else (reg_data, FEATS, "y", "id")
    metric = "auc" if kind == "gbt_classifier" else ("accuracy" if clf else "rmse")
    lrn = _learner(kind)
    if trainer == "holdout":
        score, rounds, comp = V.validate_holdout(df, lrn, feats, label, key, metric)
        assert score >= 0 and rounds >= 0 and comp.count() > 0
        return
    if trainer == "cached":
        cv = V.CachedFolds(df, key, label, feats, k=2).cross_validate(lrn, metric, df=df)
    else:
        cv = V.cross_validate(df, lrn, feats, label, key, metric, k=2, start_rounds=4,
                              groups="_group" if trainer == "grouped" else None)
    assert cv.score >= 0 and cv.rounds >= 0 and cv.oof.count() == df.count()
    fitted = L.fit(lrn, df, feats, label, rounds=10 if lrn.boosted else None)
    assert L.predict(fitted.model, df).count() == df.count()


@pytest.mark.parametrize("kind", ["gbt_regressor", "rf_regressor"])
def test_optimisers_contract(spark, reg_data, kind):
    cache = V.CachedFolds(reg_data, "id", "y", FEATS, k=2)
    lrn = _learner(kind)
    first = {n: vals[:1] for n, vals in lrn.grid.items()}       # truncated grid, as in the reference tests
    res = T.tune_grid(spark, cache, lrn, "rmse", [first])
    assert res.params is not None and res.trials.count() == 1
    rs = T.random_search(spark, cache, lrn, "rmse", {"maxDepth": T.IntStep(2, 3)}, trials=2)
    assert rs.params is not None and rs.trials.count() == 2
    folded = V.assign_folds(reg_data, "id", 2)
    _, metrics = T.tune_grid_cv(folded, lrn, FEATS, "y", "rmse", {"maxDepth": [2, 3]})
    assert len(metrics) == 2


@pytest.mark.parametrize("pair", [("linear", "rf_regressor"), ("gbt_regressor", "linear")])
def test_ensembles_contract(spark, reg_data, pair):
    oofs, models = {}, {}
    for kind in pair:
        lrn = _learner(kind)
        cv = V.cross_validate(reg_data, lrn, FEATS, "y", "id", "rmse", k=2, start_rounds=4)
        oofs[kind] = cv.oof.select("id", "prediction")
        models[kind] = L.fit(lrn, reg_data, FEATS, "y", rounds=max(cv.rounds, 1) if lrn.boosted else None).model
    wide = E.widen_oof(oofs, key="id", label="y", label_df=reg_data)
    ens = E.fit_weighted(wide, list(pair), "y")
    assert abs(sum(ens.weights / ens.weights.sum()) - 1) < 1e-9
    stack = E.fit_stacked(wide, list(pair), "y", 0.1)
    full = E.member_predictions(reg_data, models, "id")
    blended = full.select("id", ens.predict_col().alias("p"))
    stacked = stack.predict(full, fold_col=None, out="p")
    assert blended.where("p is null").count() == 0 and stacked.count() == reg_data.count()


def test_random_search_halving(spark, reg_data):
    cache = V.CachedFolds(reg_data, "id", "y", FEATS, k=4)
    lrn = _learner("rf_regressor")
    res = T.random_search(spark, cache, lrn, "rmse", {"maxDepth": T.IntStep(2, 5)}, trials=4, halving=True)
    steps = dict(res.trials.groupBy("step").count().collect())
    assert steps == {0: 4, 1: 2} and res.params is not None


def test_memoised_leaderboard(spark, reg_data, tmp_path):
    calls = []

    def compute():
        calls.append(1)
        lb = spark.createDataFrame([("a", 1.0, 0)], "member string, rmse double, rounds bigint")
        return lb, reg_data.select("id", F.col("y").alias("a"))
    p = str(tmp_path / "lb")
    a = E.memoised_leaderboard(spark, p, compute)
    b = E.memoised_leaderboard(spark, p, compute)
    assert len(calls) == 1 and a[0].collect() == b[0].collect() and b[1].count() == reg_data.count()
