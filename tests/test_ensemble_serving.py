"""Ensembles published and served: every row, probabilities, schema, preprocessor, callback; stream rejects."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabfold.functions.columns import SEVERITY_CUTS
from tabfold.operators import permutation as PI
from tabfold.operators.preprocess import SurveyPreprocessor
from tabfold.plans import ensemble as E
from tabfold.plans import learners as L
from tabfold.plans.scoring import train_job
from tabfold.streaming.score_stream import rejects_of, score_stream

EXACT = L.Learner("linear", {"solver": "normal"})


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(4)
    out = []
    for i in range(240):
        x, z = map(float, r.normal(size=2))
        key = None if i % 20 == 0 else i // 2 if i % 3 == 0 else i            # null and repeated keys
        out.append((key, x, z, 40 + 15 * x + 4 * z + float(r.normal()), float(x + 0.3 * z + 0.5 * r.normal() > 0)))
    return spark.createDataFrame(out, "id long, x double, z double, y double, flag double").cache()


def test_every_row_is_scored(spark, rows, tmp_path):
    seen = []
    meta = E.train_ensemble_job(rows, {"a": EXACT, "b": EXACT}, {"a": ["x"], "b": ["z"]}, "y", "id", str(tmp_path / "m"), k=3,
                                callback=lambda board, wide: seen.append((board.count(), wide.count())))
    assert meta["n_rows"] == 240 and seen == [(2, 240)]
    out = E.score_ensemble(spark, str(tmp_path / "m"), rows)
    assert out.count() == 240 and out.where("id IS NULL").count() == 12
    w = np.array(meta["weights"])
    fits = {n: np.polyfit([r[f] for r in rows.collect()], [r["y"] for r in rows.collect()], 1) for n, f in (("a", "x"), ("b", "z"))}
    want = sorted(float((w[0] * np.polyval(fits["a"], r["x"]) + w[1] * np.polyval(fits["b"], r["z"])) / w.sum()) for r in rows.collect())
    assert np.allclose(sorted(r["prediction"] for r in out.collect()), want)


def test_auc_blends_probabilities(spark, rows, tmp_path):
    learners = {"t": L.Learner("gbt_classifier", {"maxDepth": 2, "maxIter": 3}, early_stopping_rounds=1), "f": L.Learner("rf_classifier", {"numTrees": 3, "maxDepth": 3})}
    meta = E.train_ensemble_job(rows, learners, ["x", "z"], "flag", "id", str(tmp_path / "m"), "auc", 2, steps=4)
    out = E.score_ensemble(spark, str(tmp_path / "m"), rows).collect()
    assert meta["proba"] and len(out) == 240 and meta["ensemble"] >= max(0.5, meta["member_mean"] - 1e-9)
    for n in ("t", "f", "prediction"):
        assert len({round(r[n], 6) for r in out}) > 5 and all(0 <= r[n] <= 1 for r in out)


def test_raw_rows_through_preprocessor_schema_and_classes(spark, rows, tmp_path):
    season = F.element_at(F.array(*map(F.lit, ["Spring", "Summer", "Fall", "Winter"])), (F.abs(F.hash("x")) % 4 + 1).cast("int"))
    raw = rows.withColumn("Basic_Season", season).withColumn("cls", F.when(F.col("y") < 30, 0).when(F.col("y") < 50, 1).when(F.col("y") < 80, 2).otherwise(3)).drop("flag")
    E.train_ensemble_job(raw, {"a": EXACT, "s": L.Learner("rf_regressor", {"numTrees": 3})}, None, "y", "id", str(tmp_path / "m"), k=2,
                         preprocessor=SurveyPreprocessor(), class_col="cls")
    scorer = E.EnsembleScorer.load(spark, str(tmp_path / "m"))
    assert scorer.meta["cuts"] == list(SEVERITY_CUTS) and {"x", "z", "Basic_Season"} <= set(scorer.meta["features"]["a"])
    text = raw.select(F.col("id").cast("string"), F.when(F.col("x") > 1.5, F.lit("??")).otherwise(F.col("x").cast("string")).alias("x"), F.col("z").cast("string"), "Basic_Season")
    good, bad = scorer.split(text)
    scored = scorer.score(text)
    assert good.count() + bad.count() == 240 and scored.count() == good.count() and 0 < bad.count() < 60
    assert {r["reason"] for r in bad.collect()} == {"uncastable:x"}
    assert {r["class"] for r in scored.collect()} <= {0, 1, 2, 3}


def test_weight_is_tuned_on_rows_without_keys_too(spark, rows, tmp_path):
    with_class = rows.withColumn("cls", F.when(F.col("y") < 30, 0).when(F.col("y") < 50, 1).when(F.col("y") < 80, 2).otherwise(3))
    keyed = with_class.withColumn("id", F.monotonically_increasing_id())
    a = train_job(spark, with_class, "id", ["x", "z"], "y", "cls", EXACT, str(tmp_path / "a"), k=2)
    assert 0.8 <= a.weight <= 1.5 and train_job(spark, keyed, "id", ["x", "z"], "y", "cls", EXACT, str(tmp_path / "b"), k=2).weight > 0


def test_stream_rejects_and_a_run_batch(spark, rows, tmp_path):
    train_job(spark, rows.where("id IS NOT NULL"), "id", ["x", "z"], "y", None, EXACT, str(tmp_path / "m"), k=2, tune_weight=False)
    text = rows.select("id", F.when(F.col("x") > 1, F.lit("bad")).otherwise(F.col("x").cast("string")).alias("x"), "z")
    text.where("z > 0").write.parquet(str(tmp_path / "in"))
    args = [str(tmp_path / n) for n in ("in", "m", "out", "ckpt")]
    n1 = score_stream(spark, *args).count()
    text.where("z <= 0").write.mode("append").parquet(str(tmp_path / "in"))
    scored = score_stream(spark, *args)
    rejects = spark.read.parquet(rejects_of(args[2]))
    assert 0 < n1 < scored.count() and scored.count() + rejects.count() == 240
    assert {r["reason"] for r in rejects.collect()} <= {"missing:id", "uncastable:x", "missing:id;uncastable:x"}


def test_permutation_of_many_features(spark):
    """The plan's size does not grow with features times repeats; only features that matter score."""
    r = np.random.default_rng(0)
    names = [f"f{i}" for i in range(40)]
    x = r.normal(size=(500, 40))
    df = spark.createDataFrame([(i, *map(float, v), float(3 * v[7] - 2 * v[20])) for i, v in enumerate(x)],
                               "id long, " + ", ".join(f"{n} double" for n in names) + ", y double").cache()
    model = L.fit(EXACT, df, names, "y").model
    got = PI.permutation_importance(model, df, "id", names, "y", "rmse", repeats=3).collect()
    assert len(got) == 120
    mean = {}
    for row in got:
        mean[row["feature"]] = mean.get(row["feature"], 0) + row["delta"] / 3
    assert sorted(mean, key=mean.get)[-2:] == ["f20", "f7"] and all(abs(v) < 1e-6 for n, v in mean.items() if n not in ("f7", "f20"))
    # against a plain computation from the same permutation
    p = PI.permute_column(df, "id", "f7", 0)
    want = model.transform(p).select(F.sqrt(F.avg((F.col("prediction") - F.col("y")) ** 2))).first()[0]
    first = next(row for row in got if row["feature"] == "f7" and row["repeat"] == 0)
    assert first["permuted"] == pytest.approx(want)


@pytest.mark.parametrize("metric", ["mae"])
def test_weights_of_eight_members(spark, metric):
    """No worse than a lattice of tenths over the three best, and than any member."""
    r = np.random.default_rng(5)
    y = r.normal(size=600)
    label = (y > 0.2).astype(float) if metric == "auc" else y
    p = np.c_[[y + s * r.normal(size=600) + (0.6 * np.sin(3 * y) if s > 1 else 0) for s in (0.6, 0.7, 0.9, 1.1, 1.3, 1.6, 2.0, 3.0)]].T
    names = [f"m{i}" for i in range(8)]
    df = spark.createDataFrame([(float(t), *map(float, row)) for t, row in zip(label, p)], "y double, " + ", ".join(f"{n} double" for n in names)).cache()
    v, score = E.search_weights(df, names, "y", metric)
    assert v.sum() == pytest.approx(1) and (v >= 0).all()
    lattice = E.blend_lattice(df, names[:3], "y", metric, 10).agg(F.max(metric) if metric == "auc" else F.min(metric)).first()[0]
    better = (lambda a, b: a >= b - 1e-9) if metric == "auc" else (lambda a, b: a <= b + 1e-9)
    assert better(score, lattice) and all(better(score, s) for s in E.scored_blends(df, names, "y", metric, np.eye(8)))
    assert E.scored_blends(df, names, "y", metric, [v])[0] == pytest.approx(score)
    ens = E.fit_weighted_metric(df, names, "y", metric)
    assert np.allclose(ens.weights / ens.weights.sum(), v, atol=1e-9)


def test_gram_sums_against_numpy(spark):
    from tabfold.operators import profile as P
    r = np.random.default_rng(6)
    x = 1e6 + r.normal(size=(300, 40)) @ r.normal(size=(40, 40))
    x[r.random(x.shape) < 0.15] = np.nan
    x[:, 39] = 5.0
    names = [f"c{i}" for i in range(40)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in row) for row in x], ", ".join(f"{n} double" for n in names)).repartition(5)
    got = {(row["a"], row["b"]): row["corr"] for row in P.correlation_matrix(df, names).collect()}
    assert len(got) == 780
    for i in range(40):
        for j in range(i + 1, 40):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if j == 39:
                assert got[names[i], names[j]] is None
            else:
                assert got[names[i], names[j]] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)
    assert all(row["corr"] is None for row in P.correlation_matrix(df.where("false"), names).collect())


def test_tasks_of_the_permutation_grow_with_the_rows(spark, monkeypatch):
    """A task holds some rows of each repeat, however many there are."""
    monkeypatch.setattr(PI, "ROWS_PER_BUCKET", 10)
    df = spark.range(2000).withColumn("x", F.col("id") * 2.0)
    got = PI.with_permuted(df, "id", ["x"], 2)
    assert got.rdd.getNumPartitions() == 100
    rows = got.collect()
    for r in range(2):
        assert sorted(row[f"_p{r}"]["x"] for row in rows) == [2.0 * i for i in range(2000)]


def test_moments_far_from_zero_in_one_pass(spark):
    """Sorted values far from zero, nulls, NaN and a constant: moments as numpy has them."""
    from tabfold.operators import profile as P
    n, names = 3000, ["a", "b", "c", "d"]
    df = spark.range(n).select((F.lit(1e9) + F.col("id")).alias("a"), F.when(F.col("id") % 3 > 0, F.lit(1e9) + (F.col("id") * 7) % 11).alias("b"),
                               F.lit(0.1).alias("c"), F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).otherwise(F.col("id") * 1.0).alias("d")).repartitionByRange(7, "a")
    got = {r["i"]: r for r in P.gram_sums(df, names).collect()}
    i = np.arange(n)
    x = np.stack([1e9 + i, np.where(i % 3 > 0, 1e9 + (i * 7) % 11, np.nan), np.full(n, 0.1), np.where(i % 2 == 0, np.nan, i)])
    for a in range(4):
        for b in range(4):
            both = ~np.isnan(x[a]) & ~np.isnan(x[b])
            u, v = x[a][both], x[b][both]
            assert got[a]["n"][b] == both.sum()
            assert np.allclose([got[a]["mx"][b], got[a]["my"][b]], [u.mean(), v.mean()])
            assert np.isclose(got[a]["cxy"][b], ((u - u.mean()) * (v - v.mean())).sum(), rtol=1e-6, atol=1e-3)
    assert got[2]["vx"] == [0.0] * 4
