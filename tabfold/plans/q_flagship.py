"""Flagship: cross-validated least squares on per-order sums, RMSE and QWK.

load -> per-order features -> hash K-fold -> closed-form fit per fold
complement -> out-of-fold predictions -> per-fold RMSE (macro mean) ->
severity classes of label and prediction -> quadratic weighted kappa.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfold.functions import columns as C
from tabfold.functions.columns import SEVERITY_CUTS, ordinal_bin
from tabfold.operators import metrics
from tabfold.operators.folds import kfold
from tabfold.plans import linear
from tabfold.plans.registry import query
from tabfold.session import cut_lineage
from tabfold.sources.tables import read_table

K = 5
SEED = 0

# the per-order label: total price / 4000.  Prices carry two decimals, so the
# sum is taken exactly as DECIMAL(18,2) and converted once: every engine gets
# the same double, whatever its summation order.
Y_SQL = "CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / 4000"


def order_label():
    return F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double") / F.lit(4000.0)

# ---------------------------------------------------------------- shared SQL fragments
FOLD_SQL = "CAST(('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT) % {k}"

PER_ORDER_SQL = """
po AS (SELECT l_orderkey AS id, sum(l_quantity) AS x, %s AS y
       FROM lineitem GROUP BY l_orderkey),
f AS (SELECT *, CAST(%s AS INTEGER) AS fold FROM po),
ks AS (SELECT CAST(range AS INTEGER) AS k FROM range(%d)),
coef AS (SELECT ks.k AS fold, regr_slope(f.y, f.x) AS b, regr_intercept(f.y, f.x) AS a
         FROM f JOIN ks ON f.fold <> ks.k GROUP BY ks.k),
oof AS (SELECT f.id, f.fold, f.x, f.y, c.a + c.b * f.x AS p FROM f JOIN coef c USING (fold))
""" % (Y_SQL, FOLD_SQL.format(seed=SEED, key="id", k=K), K)


def class_sql(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL THEN NULL WHEN {c} < 30 THEN 0 WHEN {c} < 50 THEN 1 "
            f"WHEN {c} < 80 THEN 2 ELSE 3 END")


def qwk_sql(table: str, real: str, pred: str, by: str = "") -> str:
    """QWK of ``table(real, pred)`` with classes ranked in the sorted union (a subquery)."""
    sel_by = f"t.{by}, " if by else ""
    grp = f"GROUP BY t.{by}" if by else ""
    out_by = f"{by}, " if by else ""
    return f"""
    (WITH labs AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS DOUBLE) AS r
                   FROM (SELECT {real} AS v FROM {table} UNION SELECT {pred} FROM {table}) u WHERE v IS NOT NULL),
          rr AS (SELECT {sel_by}a.r AS ri, b.r AS rj FROM {table} t
                 JOIN labs a ON a.v = t.{real} JOIN labs b ON b.v = t.{pred})
     SELECT {out_by}1 - sum((ri - rj) * (ri - rj)) /
            (sum(ri * ri) + sum(rj * rj) - 2 * sum(ri) * sum(rj) / count(*)) AS qwk
     FROM rr {grp.replace('t.', '')})"""


# ---------------------------------------------------------------- Spark side

def per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: x = total quantity, y = total price / 4000."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.sum("l_quantity").alias("x"), order_label().alias("y"))


def oof_linear(spark: SparkSession, sf_dir: str, k: int = K, seed: int = SEED) -> DataFrame:
    """(id, fold, x, y, prediction): out-of-fold predictions of the closed-form fit."""
    folded = cut_lineage(kfold(per_order(spark, sf_dir), "id", k, seed))
    fit = linear.fit_folds(folded, ["x"], "y", "fold")
    return fit.predict(folded)


def with_classes(oof: DataFrame, label: str = "y", pred: str = "prediction") -> DataFrame:
    return oof.withColumns({"real_class": ordinal_bin(label, SEVERITY_CUTS),
                            "pred_class": ordinal_bin(pred, SEVERITY_CUTS)})


@query("q_cv_kappa", sql=f"""
WITH {PER_ORDER_SQL},
per_fold AS (SELECT fold, count(*) AS n, sqrt(avg((y - p) * (y - p))) AS rmse FROM oof GROUP BY fold),
cls AS (SELECT {class_sql('y')} AS real_class, {class_sql('p')} AS pred_class FROM oof)
SELECT CAST((SELECT sum(n) FROM per_fold) AS BIGINT) AS n_rows,
       CAST(floor(((SELECT avg(rmse) FROM per_fold)) * 1000000.0 + 0.5) / 1000000.0 AS DOUBLE) AS cv_rmse,
       CAST(floor(((SELECT qwk FROM {qwk_sql('cls', 'real_class', 'pred_class')})) * 1000000.0 + 0.5) / 1000000.0 AS DOUBLE) AS qwk
""")
def q_cv_kappa(spark: SparkSession, sf_dir: str) -> DataFrame:
    oof = oof_linear(spark, sf_dir)
    per_fold = metrics.regression_metrics(oof, "y", "prediction", by=["fold"])
    cv = per_fold.agg(F.sum("n").cast("bigint").alias("n_rows"),
                      C.round6(F.avg("rmse")).alias("cv_rmse")).withColumn("_k", F.lit(1))
    kappa = metrics.qwk(with_classes(oof), "real_class", "pred_class") \
        .select(C.round6("qwk").alias("qwk")).withColumn("_k", F.lit(1))
    return cv.join(kappa, "_k").drop("_k")


@query("q_fold_rmse", sql=f"""
WITH {PER_ORDER_SQL}
SELECT fold, CAST(count(*) AS BIGINT) AS n, CAST(floor((avg(abs(y - p))) * 1000000.0 + 0.5) / 1000000.0 AS DOUBLE) AS mae,
       CAST(floor((avg((y - p) * (y - p))) * 1000000.0 + 0.5) / 1000000.0 AS DOUBLE) AS mse, CAST(floor((sqrt(avg((y - p) * (y - p)))) * 1000000.0 + 0.5) / 1000000.0 AS DOUBLE) AS rmse
FROM oof GROUP BY fold
""")
def q_fold_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    oof = oof_linear(spark, sf_dir)
    m = metrics.regression_metrics(oof, "y", "prediction", by=["fold"])
    return m.select("fold", F.col("n").cast("bigint").alias("n"),
                    *[C.round6(c).alias(c) for c in ("mae", "mse", "rmse")])


@query("q_linear_coef", sql=f"""
WITH {PER_ORDER_SQL}
SELECT fold, 'intercept' AS term, CAST(floor((a) * 1000000.0 + 0.5) / 1000000.0 AS DOUBLE) AS value FROM coef
UNION ALL SELECT fold, 'x' AS term, CAST(floor((b) * 1000000.0 + 0.5) / 1000000.0 AS DOUBLE) AS value FROM coef
""")
def q_linear_coef(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-fold-complement least-squares coefficients (long form)."""
    folded = cut_lineage(kfold(per_order(spark, sf_dir), "id", K, SEED))
    fit = linear.fit_folds(folded, ["x"], "y", "fold")
    return linear.coefficients(fit).select("fold", "term", C.round6("value").alias("value"))
