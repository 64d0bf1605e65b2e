"""Boosting in blocks: Spark's own trees, prefixes, patience, several classes."""

import gc

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from tabfold.plans import boosting as B
from tabfold.plans import learners as L
from tabfold.plans import tuning as T
from tabfold.plans import validate as V


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(400, 3))
    y = 2 * x[:, 0] - x[:, 1] ** 2 + 0.2 * r.normal(size=400)
    cls = np.digitize(x[:, 0] + x[:, 1], [-0.7, 0.7])
    df = spark.createDataFrame([(i, *map(float, v), float(t), float(t > 0), float(c)) for i, (v, t, c) in enumerate(zip(x, y, cls))],
                               "id long, a double, b double, c double, y double, flag double, cls double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).cache()


@pytest.mark.parametrize("loss, label, kind", [("squared", "y", GBTRegressor), ("absolute", "y", GBTRegressor), ("logistic", "flag", GBTClassifier)])
def test_same_trees_as_spark_in_any_blocks(rows, loss, label, kind):
    """With all rows in every tree: the same margins as Spark's own boosting, whatever the length of a block."""
    params = {"maxDepth": 3, "stepSize": 0.2}
    own = kind(featuresCol="features", labelCol=label, maxIter=7, seed=0, **params)
    want = own.setLossType(loss).fit(rows).transform(rows) if kind is GBTRegressor else own.fit(rows).transform(rows)
    shown = "prediction" if kind is GBTRegressor else "rawPrediction"
    want = {r["id"]: r[shown] for r in want.select("id", shown).collect()}
    train, val = rows.where("id % 4 > 0"), rows.where("id % 4 = 0")
    curves = []
    for block in (3, 7):
        made = B.grow(rows, val, loss, params, 0, 100, block, 7, label)
        model = B.gbt_model(made.trees, made.weights, 3, kind is GBTClassifier)
        got = {r["id"]: r[shown] for r in model.transform(rows).select("id", shown).collect()}
        assert all(np.allclose(got[i], want[i], atol=1e-9) for i in want)
        curves.append(made.curve)
    assert np.allclose(*curves) and len(curves[0]) == 7
    told = model.evaluateEachIteration(val.withColumnRenamed(label, "label"), loss) \
        if kind is GBTRegressor else model.evaluateEachIteration(val.withColumnRenamed(label, "label"))
    assert np.allclose(curves[0], told)
    assert train.count() + val.count() == 400


def test_patience_keeps_a_prefix_and_saves(rows, tmp_path, spark):
    lrn = L.Learner("gbt_regressor", {"maxDepth": 3, "stepSize": 0.5, "subsamplingRate": 0.8}, early_stopping_rounds=2)
    raw = rows.drop("features")
    res = L.train_until_optimal(lrn, raw.where("id % 3 > 0"), raw.where("id % 3 = 0"), ["a", "b", "c"], "y", start=3)
    assert res.rounds == len(res.curve) == res.model.stages[-1].getNumTrees and res.curve[-1] == min(res.curve)
    res.model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    a, b = (sorted((r["id"], r["prediction"]) for r in m.transform(raw).collect()) for m in (res.model, again))
    assert a == b
    assert L.feature_importance(again, ["a", "b", "c"]).agg(F.sum("importance")).first()[0] == pytest.approx(100)


def test_several_classes_share_their_margins(rows, spark, tmp_path):
    lrn = L.default_learner("gbt_multiclass").with_params(maxDepth=3, stepSize=0.3)
    raw = rows.drop("features")
    res = L.fit(lrn, raw, ["a", "b", "c"], "cls", rounds=5)
    assert len(res.curve) == 5 and all(b < a for a, b in zip(res.curve, res.curve[1:]))           # log-loss falls each round
    res.model.write().overwrite().save(str(tmp_path / "m"))
    out = PipelineModel.load(str(tmp_path / "m")).transform(raw).select("cls", "probability", "prediction").collect()
    assert all(len(r["probability"]) == 3 and sum(r["probability"]) == pytest.approx(1) for r in out)
    assert all(r["prediction"] == int(np.argmax(r["probability"])) for r in out)
    assert np.mean([r["prediction"] == r["cls"] for r in out]) > 0.8
    stop = L.train_until_optimal(L.Learner("gbt_multiclass", {"maxDepth": 3, "stepSize": 0.5}, early_stopping_rounds=2),
                                 raw.where("id % 3 > 0"), raw.where("id % 3 = 0"), ["a", "b", "c"], "cls", start=3, max_rounds=9)
    assert stop.rounds == len(stop.curve) and stop.curve[-1] == min(stop.curve)


def test_softmax_against_numpy(spark):
    m = [0.5, -700.0, 3.0]
    got = spark.range(1).select(*[c.alias(f"p{i}") for i, c in enumerate(B.softmax([F.lit(v) for v in m]))]).first()
    e = np.exp(np.array(m) - 3.0)
    assert np.allclose(list(got), e / e.sum())


@pytest.mark.parametrize("loss, label, kind", [("squared", "y", GBTRegressor), ("logistic", "flag", GBTClassifier)])
def test_fixed_rounds_are_spark_s_own_and_their_sums_may_be_added_by_spark(rows, loss, label, kind, monkeypatch):
    """Without validation rows all rounds are kept; many sums are added before they reach the driver."""
    params = {"maxDepth": 4, "stepSize": 0.3, "minInstancesPerNode": 5}
    want = kind(featuresCol="features", labelCol=label, maxIter=4, **params).fit(rows)
    monkeypatch.setattr(B, "SUM_BYTES", 0)
    monkeypatch.setattr(B, "TASK_ROWS", 50)
    made = B.grow(rows, None, loss, params, 0, None, 3, 4, label)
    assert len(made.trees) == made.best == 4 and made.curve == []
    model = B.gbt_model(made.trees, made.weights, 3, kind is GBTClassifier)
    shown = "prediction" if kind is GBTRegressor else "rawPrediction"
    a, b = ({r["id"]: r[shown] for r in m.transform(rows).select("id", shown).collect()} for m in (model, want))
    assert all(np.allclose(a[i], b[i], atol=1e-9) for i in b)
    assert np.allclose(model.featureImportances.toArray(), want.featureImportances.toArray())


def test_fit_refuses_labels_and_leaves_other_parameters_to_spark(rows):
    raw = rows.drop("features")
    with pytest.raises(Exception, match="neither 0 nor 1"):
        L.fit(L.Learner("gbt_classifier", {"maxDepth": 2}), raw, ["a", "b"], "cls", rounds=1)
    with pytest.raises(Exception, match="no label"):
        L.fit(L.Learner("gbt_regressor", {"maxDepth": 2}), raw.withColumn("y", F.when(F.col("id") > 5, F.col("y"))), ["a", "b"], "y", rounds=1)
    left = L.fit(L.Learner("gbt_regressor", {"maxDepth": 2, "impurity": "variance"}), raw, ["a", "b"], "y", rounds=2)
    assert left.model.stages[-1].getNumTrees == 2


def test_each_task_keeps_its_share_of_the_rows(rows):
    """A tree of sampled rows has about that share of them, and the same again."""
    params = {"maxDepth": 2, "subsamplingRate": 0.5}
    one, two = (B.grow(rows, None, "squared", params, 3, None, 5, 3, "y") for _ in range(2))
    assert all(120 < t.stats[0][0] < 280 for t in one.trees) and len({t.stats[0][0] for t in one.trees}) > 1
    assert all(np.allclose(a.values(), b.values()) for a, b in zip(one.trees, two.trees))


def test_forest_against_spark(rows, monkeypatch):
    """All rows in one tree: Spark's own tree; many trees of drawn rows: near its forest, in any number of jobs and tasks."""
    monkeypatch.setattr(B, "TASK_ROWS", 100)
    one = {"numTrees": 1, "bootstrap": False, "maxDepth": 4}
    a, b = B.forest_model(B.forest(rows, one, 0, "y"), 3), RandomForestRegressor(labelCol="y", **one).fit(rows)
    got, want = ([r["prediction"] for r in m.transform(rows).orderBy("id").collect()] for m in (a, b))
    assert np.allclose(got, want, atol=1e-9)
    many = {"numTrees": 30, "maxDepth": 5, "subsamplingRate": 0.8}
    grown = B.forest(rows, many, 0, "y")
    assert len({t.stats[0][0] for t in grown}) > 5 and abs(np.mean([t.stats[0][0] for t in grown]) / 400 - 0.8) < 0.05
    monkeypatch.setattr(B, "LEVEL_BYTES", 1 << 14)
    again = B.forest(rows, many, 0, "y")
    assert all(np.allclose(s.values(), t.values()) for s, t in zip(grown, again, strict=True))
    true = np.array([r["y"] for r in rows.orderBy("id").collect()])
    own, spark_s = (np.sqrt(np.mean((np.array([r["prediction"] for r in m.transform(rows).orderBy("id").collect()]) - true) ** 2))
                    for m in (B.forest_model(grown, 3), RandomForestRegressor(labelCol="y", seed=1, **many).fit(rows)))
    assert abs(own / spark_s - 1) < 0.1


def test_poisson_numbers():
    """Their law, and the rare numbers that more than 16 bits decide."""
    rng, n = np.random.default_rng(1), 400_000
    for rate in (0.05, 0.6, 1.0):
        got = B._poisson(rng, rate, n)
        assert abs(got.mean() - rate) < 5 * np.sqrt(rate / n) and abs(got.var() - rate) < 0.02
        law = np.exp(-rate) * rate ** np.arange(4) / np.array([1, 1, 2, 6])
        assert np.allclose(np.bincount(got, minlength=4)[:4] / n, law, atol=0.004)
        table, upto = B._poisson_table(rate)
        assert (table == 255).sum() < 20 and set(np.flatnonzero(table == 255)) == {int(u * 65536) for u in upto if u < 1 - 1e-12 and u * 65536 % 1}


@pytest.fixture(scope="module")
def tied(spark):
    """Few values a feature, one cell with most rows, labels that come twice."""
    r = np.random.default_rng(7)
    x = np.column_stack([r.integers(0, 4, 3000) * (r.random(3000) < 0.4), r.integers(0, 3, 3000) * (r.random(3000) < 0.4)])
    y = x[:, 0] + 2 * x[:, 1] + r.integers(0, 5, 3000) / 5
    return spark.createDataFrame([(*map(float, v), float(t)) for v, t in zip(x, y)], "a double, b double, y double").repartition(3).cache()


def test_rows_are_added_up_by_cell_and_a_large_cell_is_dealt_to_several_tasks(tied, monkeypatch):
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(tied)
    monkeypatch.setattr(B, "TASK_ROWS", 500)
    cols = B._columns(rows, "y")
    by = B._binning(cols, {}, 0)
    assert by.tasks == 6 and max(by.busy.values()) >= 3
    blocks = B._blocks(cols, by, 1, True).collect()
    assert sum(len(b[3]) for b in blocks) == 3000 and sum(len(b[1]) for b in blocks) < 60 and max(len(b[3]) for b in blocks) < 1200
    want = {}
    for r in tied.collect():
        want.setdefault(bytes(by.bins(np.array([[r["a"], r["b"]]]))), []).append(r["y"])
    got = {}
    for _, cells, starts, y, _, _ in blocks:
        for cell, labels in zip(cells, np.split(y, starts[1:])):
            got.setdefault(bytes(cell), []).extend(labels)
    assert {c: sorted(v) for c, v in got.items()} == {c: sorted(v) for c, v in want.items()}
    params = {"maxDepth": 3, "stepSize": 0.3}
    made = B.gbt_model(*(lambda m: (m.trees, m.weights))(B.grow(rows, None, "squared", params, 0, None, 3, 5, "y")), 2, False)
    a, b = ([r["prediction"] for r in m.transform(rows).orderBy("a", "b").collect()] for m in (made, GBTRegressor(labelCol="y", maxIter=5, **params).fit(rows)))
    assert np.allclose(a, b, atol=1e-9)


def test_a_forest_grows_over_sums_by_cell_or_draws_again(tied, monkeypatch):
    """The same trees either way, with few and with many tasks' worth of rows; the blocks are made once for one owner."""
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(tied)
    monkeypatch.setattr(B, "TASK_ROWS", 800)
    params, kept = {"numTrees": 4, "maxDepth": 3, "subsamplingRate": 0.7}, {}
    one = B.forest(rows, params, 0, "y", kept)
    (_, blocks, n_cells), = kept.values()
    assert n_cells < 100 and blocks.is_cached
    monkeypatch.setattr(B, "_blocks", None)                       # not made again
    monkeypatch.setattr(B, "KEPT_BYTES", 0)
    two = B.forest(rows, params, 0, "y", kept)
    assert all(np.allclose(s.stats, t.stats) and s.cut == t.cut for s, t in zip(one, two, strict=True))
    blocks.unpersist()


def test_trials_of_a_search_share_the_blocks_of_a_fold(tied, spark, monkeypatch):
    made = []
    monkeypatch.setattr(B, "_blocks", lambda *a, own=B._blocks, **b: made.append(1) or own(*a, **b))
    cache = V.CachedFolds(tied.withColumn("id", F.monotonically_increasing_id()), "id", "y", ["a", "b"], k=2)
    space = {"maxDepth": T.IntStep(2, 4), "subsamplingRate": T.Uniform(0.6, 1.0)}
    found = T.random_search(spark, cache, L.Learner("rf_regressor", {"numTrees": 3}), "rmse", space, trials=3).trials.collect()
    assert len(made) == 2 and len({r["score"] for r in found}) == 3          # 6 before: two folds a trial
    cache.only(["a"]).cross_validate(L.Learner("rf_regressor", {"numTrees": 3}))
    assert len(made) == 4                                                    # other features, other bins
    held, blocks = cache.binned, [kept[1] for v in cache.binned.values() for kept in v.values()]
    del cache
    gc.collect()
    assert not held and not any(b.is_cached for b in blocks)
