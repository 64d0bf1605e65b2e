"""Queries over OOF predictions of two closed-form members: widening, leaderboard,
blend lattice, simplex weights, ridge stacking, score-weight sweep."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfold.functions import columns as C
from tabfold.operators import metrics as M
from tabfold.operators import sweep as W
from tabfold.operators.folds import NULL_KEY, kfold
from tabfold.plans import ensemble as E
from tabfold.plans import linear
from tabfold.plans.q_flagship import PER_ORDER_SQL, oof_linear, with_classes, Y_SQL, order_label
from tabfold.plans.registry import query
from tabfold.plans.sqlfrag import fold_sql, r6
from tabfold.session import cut_lineage, scratch_path
from tabfold.sources.tables import read_table

K = 5
MEMBERS = {"ls_qty": "qty", "ls_lines": "n_lines"}


def member_oofs(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Per member (id, fold, prediction) out-of-fold frames on one folded per-order table."""
    li = read_table(spark, sf, "lineitem")
    po = li.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).cast("double").alias("n_lines"),
        order_label().alias("y"))
    folded = cut_lineage(kfold(po, "id", K))
    out = {}
    for name, feat in MEMBERS.items():
        fit = linear.fit_folds(folded, [feat], "y", "fold")
        out[name] = fit.predict(folded).select("id", "fold", "y", "prediction")
    return out


def oof_wide(spark: SparkSession, sf: str) -> DataFrame:
    oofs = member_oofs(spark, sf)
    labels = oofs["ls_qty"].select("id", "y")
    return E.widen_oof({n: d.select("id", "prediction") for n, d in oofs.items()},
                       key="id", label="y", label_df=labels)


TWO_SQL = f"""po AS (SELECT l_orderkey AS id, sum(l_quantity) AS qty, CAST(count(*) AS DOUBLE) AS n_lines,
       {Y_SQL} AS y FROM lineitem GROUP BY l_orderkey),
f AS (SELECT *, {fold_sql('id', K)} AS fold FROM po),
ks AS (SELECT CAST(range AS INTEGER) AS k FROM range({K})),
ca AS (SELECT ks.k AS fold, regr_slope(f.y, f.qty) AS b, regr_intercept(f.y, f.qty) AS a
       FROM f JOIN ks ON f.fold <> ks.k GROUP BY ks.k),
cb AS (SELECT ks.k AS fold, regr_slope(f.y, f.n_lines) AS b, regr_intercept(f.y, f.n_lines) AS a
       FROM f JOIN ks ON f.fold <> ks.k GROUP BY ks.k),
w AS (SELECT f.id, f.fold, f.y, ca.a + ca.b * f.qty AS ls_qty, cb.a + cb.b * f.n_lines AS ls_lines
      FROM f JOIN ca USING (fold) JOIN cb USING (fold))"""


@query("q_oof_wide", sql=f"""
WITH {TWO_SQL}
SELECT id, {r6('y')} AS y, {r6('ls_qty')} AS ls_qty, {r6('ls_lines')} AS ls_lines FROM w""")
def q_oof_wide(spark: SparkSession, sf: str) -> DataFrame:
    """One wide OOF frame keyed by id (union + pivot, label joined by key)."""
    w = oof_wide(spark, sf)
    return w.select("id", *[C.round6(c).alias(c) for c in ("y", "ls_qty", "ls_lines")])


@query("q_leaderboard", sql=f"""
WITH {TWO_SQL},
pf AS (SELECT fold, sqrt(avg((ls_qty - y) * (ls_qty - y))) AS ra, sqrt(avg((ls_lines - y) * (ls_lines - y))) AS rb
       FROM w GROUP BY fold),
lb AS (SELECT 'ls_qty' AS member, avg(ra) AS rmse FROM pf UNION ALL SELECT 'ls_lines', avg(rb) FROM pf)
SELECT member, {r6('rmse')} AS rmse, CAST(0 AS BIGINT) AS rounds,
       CAST(row_number() OVER (ORDER BY rmse, member) AS INTEGER) AS position FROM lb""")
def q_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    """Per member macro CV RMSE and rounds, ordered by metric direction."""
    oofs = member_oofs(spark, sf)
    rows = []
    for name, d in oofs.items():
        per_fold = M.regression_metrics(d, "y", "prediction", by=["fold"])
        r = per_fold.agg(F.avg("rmse")).first()[0]
        rows.append((name, float(r), 0))
    lb = E.leaderboard(spark.createDataFrame(rows, "member string, rmse double, rounds bigint"), "rmse")
    ordered = lb.collect()          # one row per member
    return spark.createDataFrame([(r["member"], r["rmse"], r["rounds"], i + 1) for i, r in enumerate(ordered)],
                                 "member string, rmse double, rounds bigint, position int") \
        .select("member", C.round6("rmse").alias("rmse"), "rounds", "position")


@query("q_blend_lattice", sql=f"""
WITH {TWO_SQL},
ts AS (SELECT CAST(range AS INTEGER) AS i, CAST(range AS DOUBLE) / 100 AS t FROM range(101))
SELECT i, t, {r6('sqrt(avg((t * ls_qty + (1 - t) * ls_lines - y) * (t * ls_qty + (1 - t) * ls_lines - y)))')} AS rmse
FROM w JOIN ts ON true GROUP BY i, t""")
def q_blend_lattice(spark: SparkSession, sf: str) -> DataFrame:
    """E2 (lattice form): RMSE of every blend on a 101-point grid from one Gram pass."""
    lat = E.blend_lattice_rmse(oof_wide(spark, sf), "ls_qty", "ls_lines", "y", 100)
    return lat.select("i", "t", C.round6("rmse").alias("rmse"))


@query("q_blend_weights", sql=f"""
WITH {TWO_SQL},
s AS (SELECT greatest(0.0, least(1.0, sum((y - ls_lines) * (ls_qty - ls_lines)) /
                                  sum((ls_qty - ls_lines) * (ls_qty - ls_lines)))) AS t FROM w)
SELECT 'ls_qty' AS member, {r6('t')} AS share FROM s UNION ALL SELECT 'ls_lines', {r6('1 - t')} FROM s""")
def q_blend_weights(spark: SparkSession, sf: str) -> DataFrame:
    """Exact simplex weights minimising the blend's MSE."""
    ens = E.fit_weighted(oof_wide(spark, sf), list(MEMBERS), "y")
    return ens.frame(spark).select("member", C.round6("share").alias("share"))


@query("q_ridge2", sql=f"""
WITH {TWO_SQL},
m AS (SELECT count(*) AS n, avg(ls_qty) AS m1, avg(ls_lines) AS m2, avg(y) AS my,
             covar_pop(ls_qty, ls_qty) * count(*) + 0.1 AS a11, covar_pop(ls_lines, ls_lines) * count(*) + 0.1 AS a22,
             covar_pop(ls_qty, ls_lines) * count(*) AS a12,
             covar_pop(ls_qty, y) * count(*) AS b1, covar_pop(ls_lines, y) * count(*) AS b2 FROM w),
c AS (SELECT (b1 * a22 - a12 * b2) / (a11 * a22 - a12 * a12) AS w1,
             (a11 * b2 - a12 * b1) / (a11 * a22 - a12 * a12) AS w2, m1, m2, my FROM m)
SELECT 'intercept' AS term, {r6('my - w1 * m1 - w2 * m2')} AS value FROM c
UNION ALL SELECT 'ls_qty', {r6('w1')} FROM c UNION ALL SELECT 'ls_lines', {r6('w2')} FROM c""")
def q_ridge2(spark: SparkSession, sf: str) -> DataFrame:
    """Ridge stacking (alpha 0.1, free intercept) on member OOF columns."""
    fit = E.fit_stacked(oof_wide(spark, sf), list(MEMBERS), "y", 0.1)
    return linear.coefficients(fit).select("term", C.round6("value").alias("value"))


@query("q_stack_predict", sql=f"""
WITH {TWO_SQL},
m AS (SELECT avg(ls_qty) AS m1, avg(ls_lines) AS m2, avg(y) AS my,
             covar_pop(ls_qty, ls_qty) * count(*) + 0.1 AS a11, covar_pop(ls_lines, ls_lines) * count(*) + 0.1 AS a22,
             covar_pop(ls_qty, ls_lines) * count(*) AS a12,
             covar_pop(ls_qty, y) * count(*) AS b1, covar_pop(ls_lines, y) * count(*) AS b2 FROM w),
c AS (SELECT (b1 * a22 - a12 * b2) / (a11 * a22 - a12 * a12) AS w1,
             (a11 * b2 - a12 * b1) / (a11 * a22 - a12 * a12) AS w2, m1, m2, my FROM m)
SELECT {r6('sqrt(avg(((c.my - c.w1 * c.m1 - c.w2 * c.m2) + c.w1 * w.ls_qty + c.w2 * w.ls_lines - w.y) * '
           '((c.my - c.w1 * c.m1 - c.w2 * c.m2) + c.w1 * w.ls_qty + c.w2 * w.ls_lines - w.y)))')} AS rmse,
       CAST(count(*) AS BIGINT) AS n
FROM w JOIN c ON true""")
def q_stack_predict(spark: SparkSession, sf: str) -> DataFrame:
    """E5: stacked predictions (column arithmetic) and their RMSE."""
    wide = oof_wide(spark, sf)
    fit = E.fit_stacked(wide, list(MEMBERS), "y", 0.1)
    pred = fit.predict(wide, fold_col=None, out="stacked")
    m = M.regression_metrics(pred, "y", "stacked")
    return m.select(C.round6("rmse").alias("rmse"), F.col("n").cast("bigint").alias("n"))


SWEEP_SQL = f"""WITH {PER_ORDER_SQL},
c AS (SELECT id, CASE WHEN y < 30 THEN 0 WHEN y < 50 THEN 1 WHEN y < 80 THEN 2 ELSE 3 END AS real, p FROM oof),
js AS (SELECT CAST(range AS INTEGER) AS j, CAST(800 + range AS DOUBLE) / CAST(1000 AS DOUBLE) AS w FROM range(701)),
pr AS (SELECT js.j, c.real, CASE WHEN c.p * js.w < 30 THEN 0 WHEN c.p * js.w < 50 THEN 1
                                 WHEN c.p * js.w < 80 THEN 2 ELSE 3 END AS pred FROM c JOIN js ON true),
cells AS (SELECT j, real, pred, count(*) AS n FROM pr GROUP BY ALL),
labs AS (SELECT j, real AS v FROM cells UNION SELECT j, pred FROM cells),
rk AS (SELECT j, v, CAST(rank() OVER (PARTITION BY j ORDER BY v) - 1 AS DOUBLE) AS r FROM labs),
x AS (SELECT cells.j, cells.n, a.r AS ri, b.r AS rj FROM cells
      JOIN rk a ON a.j = cells.j AND a.v = cells.real JOIN rk b ON b.j = cells.j AND b.v = cells.pred),
k AS (SELECT j, 1 - sum(n * (ri - rj) * (ri - rj)) /
                (sum(n * ri * ri) + sum(n * rj * rj) - 2 * sum(n * ri) * sum(n * rj) / sum(n)) AS kappa
      FROM x GROUP BY j)"""


@query("q_weight_sweep", sql=f"""
{SWEEP_SQL}
SELECT k.j, js.w AS weight, {r6('kappa')} AS kappa FROM k JOIN js USING (j)""")
def q_weight_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """QWK of bin(prediction * w) for every w = 0.800..1.500 step 0.001 (delta sweep)."""
    cls = with_classes(oof_linear(spark, sf))
    curve = W.sweep(cls, "real_class", "prediction")
    return curve.select("j", "weight", C.round6("kappa").alias("kappa"))


@query("q_weight_best", sql=f"""
{SWEEP_SQL}
SELECT js.w AS weight, {r6('kappa')} AS kappa FROM k JOIN js USING (j)
ORDER BY kappa DESC, k.j LIMIT 1""")
def q_weight_best(spark: SparkSession, sf: str) -> DataFrame:
    """The best weight (first of the best on ties)."""
    cls = with_classes(oof_linear(spark, sf))
    best = W.best_weight(W.sweep(cls, "real_class", "prediction"))
    return best.select("weight", C.round6("kappa").alias("kappa"))


@query("q_weighted_predict", sql=f"""
WITH {TWO_SQL},
s AS (SELECT greatest(0.0, least(1.0, sum((y - ls_lines) * (ls_qty - ls_lines)) /
                                  sum((ls_qty - ls_lines) * (ls_qty - ls_lines)))) AS t FROM w),
fa AS (SELECT regr_slope(y, qty) AS b, regr_intercept(y, qty) AS a FROM po),
fb AS (SELECT regr_slope(y, n_lines) AS b, regr_intercept(y, n_lines) AS a FROM po)
SELECT po.id, {r6('s.t * (fa.a + fa.b * po.qty) + (1 - s.t) * (fb.a + fb.b * po.n_lines)')} AS blend
FROM po JOIN s ON true JOIN fa ON true JOIN fb ON true""")
def q_weighted_predict(spark: SparkSession, sf: str) -> DataFrame:
    """Weights from OOF, members refit on all rows, weighted average of their predictions."""
    oofs = member_oofs(spark, sf)
    wide = E.widen_oof({n: d.select("id", "prediction") for n, d in oofs.items()}, key="id", label="y",
                       label_df=oofs["ls_qty"].select("id", "y"))
    ens = E.fit_weighted(wide, list(MEMBERS), "y")
    li = read_table(spark, sf, "lineitem")
    po = li.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).cast("double").alias("n_lines"),
        order_label().alias("y"))
    scored = po
    for name, feat in MEMBERS.items():
        full = linear.fit_all(po, [feat], "y")
        scored = full.predict(scored, fold_col=None, out=name)
    return scored.select("id", C.round6(ens.predict_col()).alias("blend"))


@query("q_stack_coef_order", sql=f"""
WITH {TWO_SQL},
m AS (SELECT covar_pop(ls_qty, ls_qty) * count(*) + 0.1 AS a11, covar_pop(ls_lines, ls_lines) * count(*) + 0.1 AS a22,
             covar_pop(ls_qty, ls_lines) * count(*) AS a12,
             covar_pop(ls_qty, y) * count(*) AS b1, covar_pop(ls_lines, y) * count(*) AS b2 FROM w),
c AS (SELECT (b1 * a22 - a12 * b2) / (a11 * a22 - a12 * a12) AS w1,
             (a11 * b2 - a12 * b1) / (a11 * a22 - a12 * a12) AS w2 FROM m),
l AS (SELECT 'ls_qty' AS term, w1 AS value FROM c UNION ALL SELECT 'ls_lines', w2 FROM c)
SELECT term, {r6('value')} AS value, CAST(row_number() OVER (ORDER BY value DESC, term) AS INTEGER) AS position FROM l""")
def q_stack_coef_order(spark: SparkSession, sf: str) -> DataFrame:
    """Stacked meta-learner coefficients ordered largest first."""
    fit = E.fit_stacked(oof_wide(spark, sf), list(MEMBERS), "y", 0.1)
    rows = E.stacked_coefficients(fit).collect()          # one row per member
    return spark.createDataFrame([(r["term"], float(r["value"]), i + 1) for i, r in enumerate(rows)],
                                 "term string, value double, position int") \
        .select("term", C.round6("value").alias("value"), "position")


@query("q_blend_mae", sql=f"""
WITH {TWO_SQL}
SELECT CAST(t AS INTEGER) AS point, {r6('avg(abs((t / 20.0) * ls_qty + ((20 - t) / 20.0) * ls_lines - y))', 4)} AS mae
FROM w, range(21) r(t) GROUP BY t""")
def q_blend_mae(spark: SparkSession, sf: str) -> DataFrame:
    """Mean absolute error of every lattice blend of two members, in one aggregation."""
    b = E.blend_lattice(oof_wide(spark, sf), ["ls_qty", "ls_lines"], "y", "mae", steps=20)
    return b.select("point", C.round6("mae", 4).alias("mae"))


@query("q_ensemble_score", sql=f"""
WITH {TWO_SQL}, s AS (
  SELECT avg(abs(ls_qty - y)) AS a, avg(abs(ls_lines - y)) AS b, avg(abs(0.75 * ls_qty + 0.25 * ls_lines - y)) AS e FROM w)
SELECT {r6('(a + b) / 2', 4)} AS member_mean, {r6('e', 4)} AS ensemble FROM s""")
def q_ensemble_score(spark: SparkSession, sf: str) -> DataFrame:
    """Mean of the members' scores and the blend's own score (weights 3 : 1)."""
    import numpy as np
    ens = E.WeightedEnsemble(["ls_qty", "ls_lines"], np.array([1.0, 1.0 / 3.0]))
    s = E.ensemble_score(oof_wide(spark, sf), ens, "y", "mae")
    return s.select(C.round6("member_mean", 4).alias("member_mean"), C.round6("ensemble", 4).alias("ensemble"))


_NULL_FOLD = int(hashlib.md5(f"0:{NULL_KEY}".encode()).hexdigest()[:8], 16) % K


@query("q_ensemble_publish", sql=f"""
WITH po AS (SELECT l_orderkey AS id, sum(l_quantity) AS qty, CAST(count(*) AS DOUBLE) AS n_lines, {Y_SQL} AS y FROM lineitem GROUP BY l_orderkey),
t AS (SELECT CASE WHEN id % 11 = 0 THEN NULL ELSE id END AS id, qty, n_lines, y FROM po
      UNION ALL SELECT id, qty, n_lines, y FROM po WHERE id % 10 = 0),
f AS (SELECT *, CASE WHEN id IS NULL THEN {_NULL_FOLD} ELSE {fold_sql('id', K)} END AS fold FROM t),
ks AS (SELECT CAST(range AS INTEGER) AS k FROM range({K})),
ca AS (SELECT k AS fold, regr_slope(y, qty) AS b, regr_intercept(y, qty) AS a FROM f JOIN ks ON fold <> k GROUP BY k),
cb AS (SELECT k AS fold, regr_slope(y, n_lines) AS b, regr_intercept(y, n_lines) AS a FROM f JOIN ks ON fold <> k GROUP BY k),
w AS (SELECT f.y, ca.a + ca.b * f.qty AS p, cb.a + cb.b * f.n_lines AS q FROM f JOIN ca USING (fold) JOIN cb USING (fold)),
s AS (SELECT greatest(0.0, least(1.0, sum((y - q) * (p - q)) / sum((p - q) * (p - q)))) AS t FROM w),
fa AS (SELECT regr_slope(y, qty) AS b, regr_intercept(y, qty) AS a FROM t),
fb AS (SELECT regr_slope(y, n_lines) AS b, regr_intercept(y, n_lines) AS a FROM t),
r AS (SELECT t.id, CASE WHEN qty % 5 = 0 THEN 'uncastable:qty' END AS reason,
        s.t * (fa.a + fa.b * qty) + (1 - s.t) * (fb.a + fb.b * n_lines) AS blend FROM t JOIN s ON true JOIN fa ON true JOIN fb ON true)
SELECT id, CASE WHEN reason IS NULL THEN {r6('blend', 4)} END AS blend, coalesce(reason, 'scored') AS outcome FROM r""")
def q_ensemble_publish(spark: SparkSession, sf: str) -> DataFrame:
    """An ensemble of two members validated, weighted, refitted, published and served on raw text rows:
    every row (null keys, repeated keys) is scored or rejected with the reason."""
    from tabfold.plans.q_learn import EXACT_LINEAR, order_table
    po = order_table(spark, sf).select("id", "qty", "n_lines", "y")
    rows = po.withColumn("id", F.when(F.col("id") % 11 != 0, F.col("id"))).unionByName(po.where("id % 10 = 0"))
    model_dir = scratch_path(spark, f"ensemble-{uuid.uuid4().hex}")
    E.train_ensemble_job(rows, {n: EXACT_LINEAR for n in MEMBERS}, {n: [f] for n, f in MEMBERS.items()}, "y", "id", model_dir)
    qty = F.col("qty")
    raw = rows.select(F.col("id").cast("string"), F.when(qty % 5 == 0, F.lit("n/k")).otherwise(qty.cast("string")).alias("qty"),
                      F.col("n_lines").cast("string"))
    scorer = E.EnsembleScorer.load(spark, model_dir)
    scored = scorer.score(raw).select("id", C.round6("prediction", 4).alias("blend"), F.lit("scored").alias("outcome"))
    return scored.unionByName(scorer.split(raw)[1].select("id", F.lit(None).cast("double").alias("blend"), F.col("reason").alias("outcome")))
