"""Learner, validation, tuning, scoring, streaming and synthesis queries.

Closed-form learners have full oracles.  Iterative ones (trees, sampled
searches, synthesis) run as whole jobs too; their rows carry what SQL can
derive: keys, folds, labels, counts, and whether their error is below the
label's own deviation.
"""

from __future__ import annotations

import random
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfold.functions import columns as C
from tabfold.functions import text as X
from tabfold.operators import permutation as PI
from tabfold.operators import synth as SY
from tabfold.plans import learners as L
from tabfold.plans import tuning as T
from tabfold.plans import validate as V
from tabfold.plans.q_flagship import Y_SQL, class_sql, order_label
from tabfold.plans.registry import query
from tabfold.plans.sqlfrag import fold_sql, r6, unit_sql
from tabfold.plans.scoring import Scorer, train_job
from tabfold.session import cut_lineage, scratch_path
from tabfold.sources.tables import read_table
from tabfold.streaming.score_stream import rejects_of, score_stream

FEATS = ["qty", "n_lines", "avg_disc", "avg_tax"]

#: per-order features, label and folds as SQL; ``o`` has the columns of ``order_table``
ORDERS_SQL = f"""o AS (SELECT l_orderkey AS id, sum(l_quantity) AS qty, CAST(count(*) AS DOUBLE) AS n_lines,
  avg(l_discount) AS avg_disc, avg(l_tax) AS avg_tax, {Y_SQL} AS y FROM lineitem GROUP BY l_orderkey)"""


def order_table(spark: SparkSession, sf: str) -> DataFrame:
    """Per-order features, regression label y and its severity class."""
    li = read_table(spark, sf, "lineitem")
    po = li.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).cast("double").alias("n_lines"),
        F.avg("l_discount").alias("avg_disc"), F.avg("l_tax").alias("avg_tax"),
        order_label().alias("y"))
    return po.withColumn("y_class", C.ordinal_bin("y", C.SEVERITY_CUTS))


#: least squares by the normal equations, so that SQL gives the same numbers
EXACT_LINEAR = L.Learner("linear", {"solver": "normal"})


def small_gbt() -> L.Learner:
    return L.Learner("gbt_regressor", {"maxDepth": 3, "stepSize": 0.3, "subsamplingRate": 0.8},
                     early_stopping_rounds=3)


@query("q_gbt_oof", sql=f"""
WITH {ORDERS_SQL}
SELECT id, {fold_sql('id', 5)} AS fold, {r6('y')} AS y, true AS has_prediction, true AS better_than_mean FROM o""")
def q_gbt_oof(spark: SparkSession, sf: str) -> DataFrame:
    """5-fold GBT with patience early stopping; a finite out-of-fold prediction for
    every order, and whether their error is below that of the mean."""
    cv = V.cross_validate(order_table(spark, sf), small_gbt(), FEATS, "y", "id", "rmse", 5,
                          start_rounds=8)
    worse = cv.oof.agg(F.stddev_pop("y")).first()[0]
    return cv.oof.select("id", "fold", C.round6("y").alias("y"),
                         (F.col("prediction").isNotNull() & ~F.isnan("prediction")).alias("has_prediction"),
                         F.lit(bool(cv.score < worse)).alias("better_than_mean"))


@query("q_gbt_cv", sql=f"""
WITH {ORDERS_SQL}, f AS (SELECT *, {fold_sql('id', 5)} AS fold FROM o),
k AS (SELECT CAST(range AS INTEGER) AS k FROM range(5))
SELECT f.fold, count(*) AS n, {r6('sum(y)', 4)} AS y_sum, true AS better_than_mean, true AS curve_ends_at_rounds
FROM f GROUP BY f.fold""")
def q_gbt_cv(spark: SparkSession, sf: str) -> DataFrame:
    """Per fold, rows, label sum, whether the error is below the label's deviation, and
    whether the loss curve has a value for each kept round."""
    cv = V.cross_validate(order_table(spark, sf), small_gbt(), FEATS, "y", "id", "rmse", 5, start_rounds=8)
    curves = L.loss_frame(spark, cv.curves, "squared").groupBy("fold").agg(F.max("iteration").alias("_last"))
    rows = cv.oof.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("y").cast("decimal(30,10)")).cast("double").alias("_y"), F.stddev_pop("y").alias("_d"))
    return (rows.join(cv.per_fold, "fold").join(curves, "fold")
            .select("fold", "n", C.round6("_y", 4).alias("y_sum"), (F.col("rmse") < F.col("_d")).alias("better_than_mean"),
                    (F.col("_last") == F.col("rounds")).alias("curve_ends_at_rounds")))


@query("q_gbt_importance", sql="""
SELECT unnest(['qty', 'n_lines', 'avg_disc', 'avg_tax']) AS feature, true AS in_range, 100.0::DOUBLE AS total,
  (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS n_rows""")
def q_gbt_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Fixed-round fit on all rows; importance percent, top 50."""
    df = order_table(spark, sf)
    imp = L.feature_importance(L.fit(small_gbt(), df, FEATS, "y", rounds=10).model, FEATS)
    total = imp.agg(F.sum("importance")).first()[0]
    return imp.select("feature", F.col("importance").between(0, 100).alias("in_range"), C.round6(F.lit(float(total))).alias("total"),
                      F.lit(df.count()).cast("long").alias("n_rows"))


def doc_table(spark: SparkSession, sf: str) -> DataFrame:
    d = read_table(spark, sf, "documents").select("doc_id", "text", "n_chars")
    lab = read_table(spark, sf, "labels").select("doc_id", "quality")
    t = lab.join(d, "doc_id")
    return t.select("doc_id", F.col("quality").cast("double").alias("quality"),
                    (X.n_words("text") / F.length("text")).alias("wpc"),
                    F.col("n_chars").cast("double").alias("n_chars"),
                    X.n_sentences("text").cast("double").alias("n_sent"))


@query("q_gbt_classifier", sql="""
WITH t AS (SELECT l.doc_id, l.quality FROM labels l JOIN documents d USING (doc_id)),
f AS (SELECT *, CAST((row_number() OVER (PARTITION BY quality ORDER BY md5('0:' || doc_id), doc_id) - 1) % 5 AS INTEGER) AS fold FROM t)
SELECT fold, count(*) AS n, CAST(sum(quality) AS BIGINT) AS positives, true AS ranks_better_than_chance FROM f GROUP BY fold""")
def q_gbt_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """5 folds stratified by label, GBT classifier, positive-class probability, AUC per fold."""
    lrn = L.Learner("gbt_classifier", {"maxDepth": 2, "stepSize": 0.3}, early_stopping_rounds=3)
    cv = V.cross_validate(doc_table(spark, sf), lrn, ["wpc", "n_chars", "n_sent"], "quality", "doc_id",
                          "auc", 5, stratify="quality", start_rounds=8)
    rows = cv.oof.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("quality").cast("long").alias("positives"))
    return rows.join(cv.per_fold, "fold").select("fold", "n", "positives", F.lit(bool(cv.score > 0.5)).alias("ranks_better_than_chance"))


@query("q_gbt_multiclass", sql=f"""
WITH {ORDERS_SQL}, c AS (SELECT id, {class_sql('y')} AS y_class FROM o)
SELECT CAST(y_class AS INTEGER) AS y_class, count(*) AS n, true AS sums_to_one, true AS loss_falls, true AS better_than_largest_class FROM c GROUP BY 1""")
def q_gbt_multiclass(spark: SparkSession, sf: str) -> DataFrame:
    """Several classes boosted together: probabilities sum to one, the log-loss falls in each round, and
    more rows are right than by the largest class."""
    df = cut_lineage(order_table(spark, sf))
    res = L.fit(L.default_learner("gbt_multiclass").with_params(maxDepth=3, stepSize=0.3), df, FEATS, "y_class", rounds=4)
    out = cut_lineage(res.model.transform(df).select("y_class", "prediction", F.aggregate("probability", F.lit(0.0), lambda a, p: a + p).alias("_all")))
    classes = out.groupBy("y_class").agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("_all") - 1)).alias("_off"), F.count_if(F.col("prediction") == F.col("y_class")).alias("_right"))
    largest, right = classes.agg(F.max("n"), F.sum("_right")).first()
    falls = all(b < a for a, b in zip(res.curve, res.curve[1:]))
    return classes.select(F.col("y_class").cast("int").alias("y_class"), "n", (F.col("_off") < 1e-9).alias("sums_to_one"), F.lit(falls).alias("loss_falls"),
                          F.lit(bool(right >= largest)).alias("better_than_largest_class"))


@query("q_holdout_eval", sql=f"""
WITH {ORDERS_SQL},
c AS (SELECT regr_slope(y, qty) AS b, regr_intercept(y, qty) AS a FROM o WHERE NOT {unit_sql('id')} < 0.25),
v AS (SELECT id, y, a + b * qty AS p FROM o, c WHERE {unit_sql('id')} < 0.25)
SELECT id, {r6('y', 4)} AS real_values, {r6('p', 4)} AS predictions,
  {r6('(SELECT sqrt(avg((y - p) * (y - p))) FROM v)', 4)} AS holdout_rmse FROM v""")
def q_holdout_eval(spark: SparkSession, sf: str) -> DataFrame:
    """V1/V4: hash hold-out with a least-squares learner; comparison frame."""
    score, rounds, comp = V.validate_holdout(order_table(spark, sf), EXACT_LINEAR, ["qty"], "y", "id", "rmse")
    return comp.select("id", C.round6("real_values", 4).alias("real_values"), C.round6("predictions", 4).alias("predictions"),
                       C.round6(F.lit(score), 4).alias("holdout_rmse"))


@query("q_learners", sql="""
SELECT learner, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS n_scored, true AS finite
FROM (SELECT unnest(['linear', 'rf_regressor', 'fm_regressor', 'gbt_regressor']) AS learner)""")
def q_learners(spark: SparkSession, sf: str) -> DataFrame:
    """Every regression learner family with its default parameters through one contract, 5-fold CV."""
    df = cut_lineage(V.assign_folds(order_table(spark, sf), "id", 5))
    rows = []
    for kind in ("linear", "rf_regressor", "fm_regressor", "gbt_regressor"):
        cv = V.cross_validate(None, L.Learner(kind, {}), FEATS, "y", "id", "rmse", 5,
                              iterations=20 if kind == "gbt_regressor" else None, folded=df)
        rows.append((kind, cv.oof.where(F.col("prediction").isNotNull()).count(), cv.score == cv.score))
    return spark.createDataFrame(rows, "learner string, n_scored long, finite boolean")


@query("q_tune_grid", sql="""
SELECT * FROM (VALUES (0, 0, 2), (0, 1, 3)) t(step, trial, max_depth)
UNION ALL SELECT 1, 2 + i, NULL FROM range(2) r(i)""")
def q_tune_grid(spark: SparkSession, sf: str) -> DataFrame:
    """H1/H6/H7: coordinate grid (two steps) on cached folds; trials frame."""
    cache = V.CachedFolds(order_table(spark, sf), "id", "y", FEATS, k=5)
    lrn = L.Learner("gbt_regressor", {"maxDepth": 3, "stepSize": 0.3}, early_stopping_rounds=3)
    steps = [{"max_depth": [2, 3]}, {"learning_rate": [0.1, 0.3]}]
    trials = T.tune_grid(spark, cache, lrn, "rmse", steps).trials
    depth = F.when(F.col("step") == 0, F.get_json_object("params", "$.maxDepth").cast("int"))
    return trials.where(F.col("score").isNotNull()).select("step", F.col("trial").cast("long").alias("trial"), depth.alias("max_depth"))


@query("q_tune_cv", sql=f"""
WITH {ORDERS_SQL}, f AS (SELECT *, {fold_sql('id', 5)} AS fold FROM o),
k AS (SELECT CAST(range AS INTEGER) AS k FROM range(5)), lam AS (SELECT unnest([0.0, 0.1, 1.0]) AS lam),
-- ridge on the standardised feature: the slope shrinks by var / (var + lam) in units of the deviations
m AS (SELECT k.k AS fold, avg(qty) AS mx, avg(y) AS my, covar_samp(qty, y) AS cxy, var_samp(qty) AS vx,
        count(*) AS n, stddev_samp(y) AS sy FROM f JOIN k ON f.fold <> k.k GROUP BY k.k),
c AS (SELECT fold, lam, mx, my, cxy / vx * ((n - 1.0) / n) / ((n - 1.0) / n + lam / sy) AS b FROM m, lam),
e AS (SELECT lam, f.fold, sqrt(avg(power(y - (my + b * (qty - mx)), 2))) AS rmse FROM f JOIN c USING (fold) GROUP BY 1, 2)
SELECT CAST(lam AS DOUBLE) AS reg_param, {r6('avg(rmse)', 4)} AS rmse FROM e GROUP BY lam""")
def q_tune_cv(spark: SparkSession, sf: str) -> DataFrame:
    """H2: Spark CrossValidator with the fold column and a parameter grid."""
    folded = cut_lineage(V.assign_folds(order_table(spark, sf), "id", 5))
    _, metrics = T.tune_grid_cv(folded, EXACT_LINEAR, ["qty"], "y", "rmse", {"regParam": [0.0, 0.1, 1.0]})
    rows = [(float(p["regParam"]), float(m)) for p, m in metrics]
    return spark.createDataFrame(rows, "reg_param double, rmse double").select("reg_param", C.round6("rmse", 4).alias("rmse"))


@query("q_random_search", sql="SELECT 0 AS step, CAST(i AS INTEGER) AS trial, true AS in_space FROM range(10) t(i)")
def q_random_search(spark: SparkSession, sf: str) -> DataFrame:
    """H3/H5: seeded random search over typed spaces, 10 trials of 5 folds (forests of 10 trees)."""
    cache = V.CachedFolds(order_table(spark, sf), "id", "y", FEATS, k=5)
    lrn = L.Learner("rf_regressor", {"numTrees": 10})
    space = {"maxDepth": T.IntStep(2, 6), "subsamplingRate": T.Uniform(0.6, 1.0)}
    trials = T.random_search(spark, cache, lrn, "rmse", space, trials=10).trials
    p = lambda n: F.get_json_object("params", f"$.{n}").cast("double")
    return trials.select("step", "trial", (p("maxDepth").between(2, 6) & p("subsamplingRate").between(0.6, 1.0) & F.col("score").isNotNull()).alias("in_space"))


SEARCH_SPACE = {"regParam": T.LogUniform(0.01, 100.0), "aggregationDepth": T.Choice((2, 3))}
SEARCH_TRIALS = 25


def sampled_trials() -> list[tuple[int, float]]:
    """(trial, regParam) that the search below draws, from the same generator."""
    rng = random.Random(0)
    return [(t, {k: v.sample(rng) for k, v in SEARCH_SPACE.items()}["regParam"]) for t in range(SEARCH_TRIALS)]


@query("q_search_ridge", sql=f"""
WITH {ORDERS_SQL}, f AS (SELECT *, {fold_sql('id', 5)} AS fold FROM o),
k AS (SELECT CAST(range AS INTEGER) AS k FROM range(5)),
lam AS (SELECT * FROM (VALUES {", ".join(f"({t}, CAST({v!r} AS DOUBLE))" for t, v in sampled_trials())}) v(trial, lam)),
m AS (SELECT k.k AS fold, avg(qty) AS mx, avg(y) AS my, covar_pop(qty, y) AS cxy, var_pop(qty) AS vx,
        stddev_pop(y) AS sy FROM f JOIN k ON f.fold <> k.k GROUP BY k.k),
c AS (SELECT fold, trial, mx, my, cxy / vx / (1 + lam / sy) AS b FROM m, lam),
e AS (SELECT trial, f.fold, sqrt(avg(power(y - (my + b * (qty - mx)), 2))) AS rmse FROM f JOIN c USING (fold) GROUP BY 1, 2),
s AS (SELECT trial, avg(rmse) AS rmse FROM e GROUP BY trial)
SELECT CAST(trial AS INTEGER) AS trial, {r6('rmse', 4)} AS rmse, trial = (SELECT arg_min(trial, rmse) FROM s) AS chosen FROM s""")
def q_search_ridge(spark: SparkSession, sf: str) -> DataFrame:
    """H3/H5: seeded search over logarithmic and discrete spaces with a closed-form learner: every score, and the choice."""
    cache = V.CachedFolds(order_table(spark, sf), "id", "y", ["qty"], k=5)
    found = T.random_search(spark, cache, EXACT_LINEAR, "rmse", SEARCH_SPACE, trials=SEARCH_TRIALS)
    chosen = F.abs(F.get_json_object("params", "$.regParam").cast("double") - F.lit(float(found.params["regParam"]))) < 1e-12
    return found.trials.select("trial", C.round6("score", 4).alias("rmse"), chosen.alias("chosen"))


_SCORE_SQL = f"""
WITH {ORDERS_SQL},
c AS (SELECT regr_slope(y, qty) AS b, regr_intercept(y, qty) AS a FROM o),
p AS (SELECT id, a + b * qty AS score FROM o, c)
SELECT id, {r6('score', 4)} AS score, {class_sql('score * 1.2525')} AS class FROM p"""


def _rounded(scored: DataFrame) -> DataFrame:
    return scored.select("id", C.round6("score", 4).alias("score"), F.col("class").cast("int").alias("class"))


@query("q_score_batch", sql=_SCORE_SQL)
def q_score_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Train (5 folds) and publish, reload, score every order (score + class)."""
    df = order_table(spark, sf)
    model_dir = scratch_path(spark, f"model-{uuid.uuid4().hex}")
    train_job(spark, df, "id", ["qty"], "y", "y_class", EXACT_LINEAR, model_dir, tune_weight=False)
    return _rounded(Scorer.load(spark, model_dir).score(df))


@query("q_score_stream", sql=_SCORE_SQL)
def q_score_stream(spark: SparkSession, sf: str) -> DataFrame:
    """ST1: the saved pipeline applied to a file stream (availableNow), output read back."""
    df = order_table(spark, sf)
    run = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    train_job(spark, df, "id", ["qty"], "y", "y_class", EXACT_LINEAR, f"{run}/model", tune_weight=False)
    df.select("id", "qty").write.parquet(f"{run}/in")
    return _rounded(score_stream(spark, f"{run}/in", f"{run}/model", f"{run}/out", f"{run}/ckpt"))


@query("q_score_tuned", sql=f"""
WITH {ORDERS_SQL} SELECT id, true AS scored, true AS class_in_range FROM o""")
def q_score_tuned(spark: SparkSession, sf: str) -> DataFrame:
    """W3 with the weight tuned on out-of-fold classes, on all features: every order gets a score and a class."""
    df = order_table(spark, sf)
    model_dir = scratch_path(spark, f"model-{uuid.uuid4().hex}")
    train_job(spark, df, "id", FEATS, "y", "y_class", L.default_learner("linear"), model_dir)
    scored = Scorer.load(spark, model_dir).score(df)
    return scored.select("id", F.col("score").isNotNull().alias("scored"), F.col("class").between(0, 3).alias("class_in_range"))


@query("q_score_rejects", sql=f"""
WITH {ORDERS_SQL}, raw AS (
  SELECT CASE WHEN id % 7 = 0 THEN NULL WHEN id % 7 = 1 THEN 'x' || id ELSE CAST(id AS VARCHAR) END AS id,
         CASE WHEN id % 5 = 0 THEN 'n/k' ELSE CAST(CAST(qty AS BIGINT) AS VARCHAR) END AS qty FROM o),
told AS (SELECT CASE WHEN id IS NULL THEN 'missing:id' WHEN TRY_CAST(id AS BIGINT) IS NULL THEN 'uncastable:id' END AS a,
                CASE WHEN qty = 'n/k' THEN 'uncastable:qty' END AS b FROM raw)
SELECT coalesce(nullif(concat_ws(';', a, b), ''), 'scored') AS outcome, count(*) AS n FROM told GROUP BY 1""")
def q_score_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Raw text rows against the published schema: scored, or rejected with the reason."""
    df = order_table(spark, sf)
    model_dir = scratch_path(spark, f"model-{uuid.uuid4().hex}")
    train_job(spark, df, "id", ["qty"], "y", "y_class", EXACT_LINEAR, model_dir, tune_weight=False)
    i = F.col("id")
    raw = df.select(F.when(i % 7 == 0, F.lit(None)).when(i % 7 == 1, F.concat(F.lit("x"), i.cast("string"))).otherwise(i.cast("string")).alias("id"),
                    F.when(i % 5 == 0, F.lit("n/k")).otherwise(F.col("qty").cast("bigint").cast("string")).alias("qty"))
    scorer = Scorer.load(spark, model_dir)
    rejects = scorer.split(raw)[1].groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    scored = scorer.score(raw).agg(F.count("score").alias("n")).select(F.lit("scored").alias("outcome"), "n")
    return scored.unionByName(rejects)


@query("q_stream_rejects", sql=f"""
WITH {ORDERS_SQL}, raw AS (
  SELECT CASE WHEN id % 7 = 0 THEN NULL ELSE id END AS id, CASE WHEN id % 5 = 0 THEN 'n/k' ELSE CAST(CAST(qty AS BIGINT) AS VARCHAR) END AS qty, qty AS q FROM o),
c AS (SELECT regr_slope(y, qty) AS b, regr_intercept(y, qty) AS a FROM o),
told AS (SELECT nullif(concat_ws(';', CASE WHEN id IS NULL THEN 'missing:id' END, CASE WHEN qty = 'n/k' THEN 'uncastable:qty' END), '') AS reason, id, q FROM raw)
SELECT coalesce(reason, 'scored') AS outcome, count(*) AS n, sum(id) AS ids, {r6('sum(CASE WHEN reason IS NULL THEN a + b * q END)', 2)} AS score FROM told, c GROUP BY 1""")
def q_stream_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """ST1/A7: a stream of raw rows: scores and rejects with reasons, together the input; a second run adds nothing."""
    df = order_table(spark, sf)
    run = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    train_job(spark, df, "id", ["qty"], "y", "y_class", EXACT_LINEAR, f"{run}/model", tune_weight=False)
    raw = df.select(F.when(F.col("id") % 7 != 0, F.col("id")).alias("id"),
                    F.when(F.col("id") % 5 == 0, F.lit("n/k")).otherwise(F.col("qty").cast("bigint").cast("string")).alias("qty"))
    raw.repartition(4).write.parquet(f"{run}/in")
    for _ in range(2):
        scored = score_stream(spark, f"{run}/in", f"{run}/model", f"{run}/out", f"{run}/ckpt")
    rejects = spark.read.parquet(rejects_of(f"{run}/out"))
    both = scored.select(F.lit("scored").alias("outcome"), "id", "score").unionByName(rejects.select(F.col("reason").alias("outcome"), "id", F.lit(None).cast("double").alias("score")))
    return both.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"), F.sum("score").alias("_s")) \
        .select("outcome", "n", "ids", C.round6("_s", 2).alias("score"))


@query("q_synth", sql=f"""
WITH {ORDERS_SQL}
SELECT c AS "column", (SELECT count(*) FROM o) AS n, true AS mean_close, true AS spread_close
FROM (SELECT unnest(['qty', 'n_lines', 'y']) AS c)""")
def q_synth(spark: SparkSession, sf: str) -> DataFrame:
    """K9: Gaussian-copula synthetic orders, as many as there are real ones; means and deviations within 5 % of the
    deviation (what the knots may cost) and four standard errors (what drawing ``n`` rows may)."""
    cols = ["qty", "n_lines", "y"]
    df = order_table(spark, sf).select(*cols)
    made = SY.sample(spark, SY.fit_copula(df, cols), df.count(), seed=0)
    real = df.agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("m", F.avg), ("s", F.stddev))]).first()
    fake = made.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("m", F.avg), ("s", F.stddev))]).first()
    def near(c: str, what: str) -> bool:
        return abs(real[f"{what}_{c}"] - fake[f"{what}_{c}"]) < (0.05 + 4 / fake["n"] ** 0.5) * real[f"s_{c}"]
    rows = [(c, fake["n"], near(c, "m"), near(c, "s")) for c in cols]
    return spark.createDataFrame(rows, "column string, n long, mean_close boolean, spread_close boolean")


@query("q_perm_importance", sql="""
SELECT f AS feature, CAST(r AS INTEGER) AS repeat, CASE WHEN f = 'qty' THEN true END AS qty_helps
FROM (SELECT unnest(['qty', 'n_lines', 'avg_disc', 'avg_tax']) AS f), range(10) t(r)""")
def q_perm_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Permutation importance of a fitted pipeline, 10 repeats of every feature in one pass."""
    df = cut_lineage(order_table(spark, sf))
    res = L.fit(L.default_learner("linear"), df, FEATS, "y")
    imp = PI.permutation_importance(res.model, df, "id", FEATS, "y", "rmse")
    return imp.select("feature", "repeat", F.when(F.col("feature") == "qty", F.col("delta") > 0).alias("qty_helps"))


@query("q_synth_orders", sql="""
SELECT o_orderstatus AS status, true AS share_close, (SELECT count(*) FROM orders) AS n FROM orders GROUP BY 1""")
def q_synth_orders(spark: SparkSession, sf: str) -> DataFrame:
    """K9 with mixed types: price (numeric) with status and priority (categorical), n = row count;
    shares of each status within one percent of the rows and four standard errors."""
    o = read_table(spark, sf, "orders").select("o_totalprice", "o_orderstatus", "o_orderpriority")
    n = o.count()
    made = SY.sample(spark, SY.fit_copula(o, ["o_totalprice", "o_orderstatus", "o_orderpriority"]), n, seed=1)
    real = o.groupBy(F.col("o_orderstatus").alias("status")).agg((F.count(F.lit(1)) / n).alias("a"))
    fake = made.groupBy(F.col("o_orderstatus").alias("status")).agg((F.count(F.lit(1)) / n).alias("b"))
    return real.join(fake, "status").select("status", (F.abs(F.col("a") - F.col("b")) < 0.01 + 4 * F.sqrt(F.col("a") * (1 - F.col("a")) / n)).alias("share_close"),
                                            F.lit(made.count()).cast("long").alias("n"))
