"""Rows, classes and values that must not get lost; one test for each repaired case."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabfold.operators import folds as K
from tabfold.operators import metrics as M
from tabfold.operators import permutation as PI
from tabfold.operators import profile as P
from tabfold.operators import sweep as W
from tabfold.operators.impute import MedianImputer
from tabfold.operators.preprocess import SurveyPreprocessor
from tabfold.plans import ensemble as E
from tabfold.plans import learners as L
from tabfold.plans import tuning as TU
from tabfold.plans import validate as V
from tabfold.plans.scoring import Scorer, train_job
from tabfold.session import scratch_path
from tabfold.sources import csv as S


@pytest.fixture(scope="module")
def rows(spark):
    """60 rows: half of the groups and some keys null, one feature with NaN, one without any value."""
    rng = np.random.default_rng(0)
    data = [(None if i == 7 else i, None if i % 2 else i % 6, float(i % 3), float(i), float("nan") if i % 5 == 0 else float(rng.normal()),
             None, 2.0 * i + float(rng.normal())) for i in range(60)]
    return spark.createDataFrame(data, "id long, grp int, cls double, x double, z double, empty double, y double").cache()


@pytest.mark.parametrize("groups,stratify", [(None, None), ("grp", None), (None, "cls"), ("grp", "cls"), (["grp", "cls"], "cls"), (["grp"], None)])
def test_every_row_gets_a_fold(rows, groups, stratify):
    out = V.assign_folds(rows, "id", 3, groups=groups, stratify=stratify)
    assert out.count() == 60 and out.where("fold IS NULL").count() == 0 and set(out.columns) == {*rows.columns, "fold"}
    if groups:
        g = [groups] if isinstance(groups, str) else groups
        assert out.groupBy(*g).agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0


def test_balanced_groups_and_holdout_keep_nulls(rows):
    assert K.group_kfold(rows, "grp", 3, balanced=True).where("fold IS NOT NULL").count() == 60
    assert K.holdout(rows, "id").where("is_valid IS NULL").count() == 0


@pytest.mark.parametrize("groups,stratify", [("grp", None), (["grp"], "cls"), (None, "cls")])
def test_out_of_fold_rows_are_all_rows(rows, groups, stratify):
    cv = V.cross_validate(rows, L.default_learner("linear"), ["x", "z", "empty"], "y", "id", "rmse", 3, groups=groups, stratify=stratify)
    assert cv.oof.count() == 60 and cv.oof.where("prediction IS NULL OR isnan(prediction)").count() == 0


def test_imputer_fills_nan(rows):
    model = MedianImputer(inputCols=["z"]).fit(rows)
    want = float(np.median([r.z for r in rows.collect() if r.z == r.z]))
    got = [r.z for r in model.transform(rows).orderBy("x").collect()]
    assert not any(v != v for v in got) and got[0] == pytest.approx(want)


def test_many_classes(spark):
    n = 20_000
    df = spark.range(n).select(F.col("id").alias("a"), F.when(F.col("id") % 10 == 0, (F.col("id") + 1) % n).otherwise(F.col("id")).alias("b"))
    x, y = np.arange(n), np.where(np.arange(n) % 10 == 0, (np.arange(n) + 1) % n, np.arange(n))
    o, e = ((x - y) ** 2).sum(), ((x ** 2).sum() + (y ** 2).sum() - 2.0 * x.sum() * y.sum() / n)
    assert M.qwk(df, "a", "b").first()[0] == pytest.approx(1 - o / e)
    assert M.kappa_from_confusion(M.confusion(df, "a", "b"), "unweighted").first()[0] == pytest.approx(0.9, abs=1e-3)
    curve = W.sweep(df.select("a", (F.col("a") % 90).cast("double").alias("s")), "a", "s", lo_milli=900, hi_milli=905)
    assert curve.count() == 6 and curve.where("isnan(kappa)").count() == 0


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "q.csv").write_text('id,text,label\n1,"he said ""hi"", ok",a\n2,"two\nlines",b\n3,plain,c\n')
    got = {r.id: (r.text, r.label) for r in S.read_csv(spark, str(tmp_path / "q.csv")).collect()}
    assert got == {1: ('he said "hi", ok', "a"), 2: ("two\nlines", "b"), 3: ("plain", "c")}
    df = spark.createDataFrame([(1, 'a "b", c'), (2, "x\ny"), (3, "back\\slash")], "id long, text string")
    S.write_csv(df, str(tmp_path / "out"))
    assert sorted(map(tuple, S.read_csv(spark, str(tmp_path / "out")).collect())) == sorted(map(tuple, df.collect()))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("label", T.StringType())])
    (tmp_path / "bad.csv").write_text("id,text,label\n1,a,b\nx,c,d\n")
    bad = S.read_csv(spark, str(tmp_path / "bad.csv"), schema, multi_line=False, corrupt="_corrupt").cache()
    assert [r._corrupt for r in bad.where("_corrupt IS NOT NULL").collect()] == ["x,c,d"]


def test_aliases_are_one_parameter():
    assert L.merge_params({"learning_rate": 0.1}, {"stepSize": 0.03}) == {"stepSize": 0.03}
    with pytest.raises(ValueError):
        L.merge_params({"eta": 0.1, "learning_rate": 0.2})


@pytest.mark.parametrize("metric", ["accuracy", "auc", "qwk"])
def test_grid_search_scores_any_metric(spark, metric):
    df = spark.range(80).select(F.col("id"), (F.col("id") % 2).cast("double").alias("y"), (F.col("id") % 2 + F.rand(1)).alias("x"),
                                (F.floor(F.col("id") / 2) % 2).cast("int").alias("fold"))
    _, scores = TU.tune_grid_cv(df, L.Learner("rf_classifier", {"numTrees": 3}), ["x"], "y", metric, {"maxDepth": [1, 2]})
    assert len(scores) == 2 and all(0.0 <= s <= 1.0 for _, s in scores)


def test_duplicates_and_histogram(spark):
    df = spark.createDataFrame([(["a, b"],), (["a", "b"],), (["a", "b"],)], "x array<string>")
    assert P.duplicate_count(df, ["x"]).first()["n_duplicates"] == 1
    h = P.histogram(spark.createDataFrame([(0.0,), (1.0,), (20.0,)], "v double"), "v", 20).collect()
    assert len(h) == 20 and sum(r.n for r in h) == 3 and sum(r.n == 0 for r in h) == 17


def test_scoring_tells_rejects(spark, rows):
    d = scratch_path(spark, "repairs-model")
    train_job(spark, rows.where("id IS NOT NULL"), "id", ["x"], "y", None, L.default_learner("linear"), d, k=3)
    raw = spark.createDataFrame([("1", "2.0"), (None, "1"), ("k", "1"), ("2", "bad"), ("3", None)], "id string, x string")
    scorer = Scorer.load(spark, d)
    ok, rejects = scorer.split(raw)
    assert scorer.score(raw).count() == 2 == ok.count()
    assert sorted(r.reason for r in rejects.collect()) == ["missing:id", "uncastable:id", "uncastable:x"]


def test_published_pipeline_takes_raw_rows(spark):
    df = spark.createDataFrame([(i, "Winter" if i % 2 else "Fall", float(i), None, 3.0 * i + (i % 2)) for i in range(40)],
                               "id long, Basic_Season string, x double, sparse double, y double")
    d = scratch_path(spark, "repairs-survey")
    pre = SurveyPreprocessor(products={"xx": ("x", "x")}, ratios={}, protect=["id", "y"])
    pub = train_job(spark, df, "id", None, "y", None, L.default_learner("linear"), d, k=3, preprocessor=pre,
                    grid=[{"regParam": [0.0, 50.0]}], sized=True)
    out = Scorer.load(spark, d).score(df.drop("y"))
    assert out.count() == 40 and pub.cv_score < 1.0
    assert out.join(df, "id").where("abs(score - y) > 1").count() == 0


def test_classifiers_are_stratified_unasked(spark):
    df = spark.range(90).select(F.col("id"), (F.col("id") % 9 == 0).cast("double").alias("y"), F.rand(3).alias("x"))
    d = scratch_path(spark, "repairs-strat")
    pub = train_job(spark, df, "id", ["x"], "y", None, L.Learner("rf_classifier", {"numTrees": 3}), d, k=5, metric="accuracy")
    assert pub.cv_score > 0.5


def test_permutation_moves_one_column(spark, rows):
    df = rows.where("id IS NOT NULL").select("id", "x", "cls")
    got = PI.permute_column(df, "id", "x", 3, buckets=2).collect()
    assert sorted(r.x for r in got) == sorted(r.x for r in df.collect()) and sum(r.x != r.id for r in got) > 50
    assert {r.id: r.cls for r in got} == {r.id: r.cls for r in df.collect()}


def test_simplex_solver_and_lattice():
    rng = np.random.default_rng(0)
    for k in (1, 2, 5, 12):
        A = rng.normal(size=(60, k))
        t = A @ rng.random(k) + rng.normal(size=60)
        G, b = A.T @ A, A.T @ t
        v = E.simplex_least_squares(G, b)
        f = lambda u: u @ G @ u - 2 * b @ u
        assert v.sum() == pytest.approx(1) and (v >= 0).all()
        others = rng.dirichlet(np.ones(k), 3000)
        assert f(v) <= min(f(u) for u in others) + 1e-9 and f(v) <= min(f(u) for u in np.eye(k)) + 1e-9
    assert E.simplex_lattice(2, 2) == [(0.0, 1.0), (0.5, 0.5), (1.0, 0.0)] and len(E.simplex_lattice(3, 10)) == 66


@pytest.mark.parametrize("kind,metric", [("weighted", "mae"), ("stacked", "rmse")])
def test_ensemble_job(spark, rows, kind, metric):
    df = rows.where("id IS NOT NULL")
    d = scratch_path(spark, f"repairs-ens-{kind}")
    learners = {"lin": L.default_learner("linear"), "rf": L.Learner("rf_regressor", {"numTrees": 3})}
    meta = E.train_ensemble_job(df, learners, ["x", "z"], "y", "id", d, metric, k=3, kind=kind, grids={"rf": [{"maxDepth": [1, 3]}]})
    out = E.score_ensemble(spark, d, df)
    assert out.count() == 59 and out.where("prediction IS NULL").count() == 0
    if kind == "weighted":
        assert meta["ensemble"] <= meta["member_mean"] and meta["weights"][0] == 1.0


def test_sweep_and_auc_use_no_fixed_buckets(spark):
    df = spark.range(3000).select((F.col("id") % 3 == 0).cast("int").alias("y"), F.col("id").cast("double").alias("s"))
    want = M.auc(df, "y", "s").first()[0]
    assert M.auc(df, "y", "s", by_bucket=50).first()[0] == pytest.approx(want, abs=1e-12)
