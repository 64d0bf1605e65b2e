"""Metric queries on the flagship out-of-fold predictions and on labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfold.functions import columns as C
from tabfold.functions import text as X
from tabfold.operators import metrics as M
from tabfold.plans.q_flagship import PER_ORDER_SQL, class_sql, oof_linear, qwk_sql, with_classes
from tabfold.plans.registry import query
from tabfold.plans.sqlfrag import r6
from tabfold.sources.tables import read_table

OOF_CLS_SQL = f"""WITH {PER_ORDER_SQL},
cls AS (SELECT id, fold, y, p, {class_sql('y')} AS real_class, {class_sql('p')} AS pred_class FROM oof)"""


@query("q_error_metrics", sql=f"""
WITH {PER_ORDER_SQL}
SELECT CAST(count(*) AS BIGINT) AS n, {r6('avg(abs(y - p))')} AS mae, {r6('avg((y - p) * (y - p))')} AS mse,
       {r6('sqrt(avg((y - p) * (y - p)))')} AS rmse FROM oof""")
def q_error_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Pooled MAE, MSE, RMSE of the out-of-fold predictions."""
    m = M.regression_metrics(oof_linear(spark, sf), "y", "prediction")
    return m.select(F.col("n").cast("bigint").alias("n"),
                    *[C.round6(c).alias(c) for c in ("mae", "mse", "rmse")])


@query("q_accuracy", sql=f"""
{OOF_CLS_SQL}
SELECT {r6('avg(CASE WHEN real_class = pred_class THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM cls""")
def q_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """Share of exact class matches."""
    a = M.accuracy(with_classes(oof_linear(spark, sf)), "real_class", "pred_class")
    return a.select(C.round6("accuracy").alias("accuracy"))


@query("q_qwk", sql=f"""
{OOF_CLS_SQL},
q AS {qwk_sql('cls', 'real_class', 'pred_class', by='fold')}
SELECT fold, {r6('qwk')} AS qwk FROM q""")
def q_qwk(spark: SparkSession, sf: str) -> DataFrame:
    """G16 grouped: quadratic weighted kappa per fold (classes ranked in the pooled union)."""
    cls = with_classes(oof_linear(spark, sf))
    conf = M.confusion(cls, "real_class", "pred_class", by=["fold"])
    q = M.kappa_from_confusion(conf, "quadratic", by=["fold"])
    return q.select("fold", C.round6("qwk").alias("qwk"))


@query("q_kappa", sql=f"""
{OOF_CLS_SQL},
r AS (SELECT real_class AS c, count(*) AS nr FROM cls GROUP BY 1),
p AS (SELECT pred_class AS c, count(*) AS np FROM cls GROUP BY 1),
t AS (SELECT count(*) AS n, sum(CASE WHEN real_class = pred_class THEN 1 ELSE 0 END) AS d FROM cls)
SELECT {r6('1 - (t.n - t.d) / (t.n - (SELECT sum(nr * np) FROM r JOIN p USING (c)) / t.n)')} AS kappa FROM t""")
def q_kappa(spark: SparkSession, sf: str) -> DataFrame:
    """Unweighted Cohen's kappa."""
    cls = with_classes(oof_linear(spark, sf))
    k = M.kappa_from_confusion(M.confusion(cls, "real_class", "pred_class"), "unweighted")
    return k.select(C.round6("kappa").alias("kappa"))


@query("q_confusion", sql=f"""
{OOF_CLS_SQL}
SELECT real_class AS real, pred_class AS pred, CAST(count(*) AS BIGINT) AS n FROM cls GROUP BY 1, 2""")
def q_confusion(spark: SparkSession, sf: str) -> DataFrame:
    """Long confusion table."""
    cls = with_classes(oof_linear(spark, sf))
    return M.confusion(cls, "real_class", "pred_class")


def doc_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with a words-per-character score."""
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    lab = read_table(spark, sf, "labels").select("doc_id", "quality")
    return (lab.join(d, "doc_id")
               .select("doc_id", "quality",
                       (X.n_words("text").cast("double") / F.length("text").cast("double")).alias("score")))


_SCORE_SQL = ("CAST(len(regexp_split_to_array(d.text, '[ \\n.?!,]')) AS DOUBLE) / "
              "CAST(length(d.text) AS DOUBLE)")


@query("q_auc", sql=f"""
WITH x AS (SELECT l.quality AS label, {_SCORE_SQL} AS score FROM labels l JOIN documents d USING (doc_id)),
s AS (SELECT score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
             sum(CASE WHEN label <> 1 THEN 1 ELSE 0 END) AS neg FROM x GROUP BY score),
c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             AS below FROM s)
SELECT {r6('sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg))')} AS auc FROM c""")
def q_auc(spark: SparkSession, sf: str) -> DataFrame:
    """Exact ROC AUC (ties one half) of quality against words per character."""
    a = M.auc(doc_scores(spark, sf), "quality", "score")
    return a.select(C.round6("auc").alias("auc"))


@query("q_auc_by", sql=f"""
WITH x AS (
  SELECT 'status ' || l_linestatus AS grp, l_extendedprice AS score, l_returnflag = 'R' AS hit FROM lineitem
  UNION ALL SELECT 'supplier ' || l_suppkey, l_extendedprice, l_returnflag = 'R' FROM lineitem),
s AS (SELECT grp, score, count(*) FILTER (WHERE hit) AS pos, count(*) FILTER (WHERE NOT hit) AS neg FROM x GROUP BY grp, score),
c AS (SELECT grp, pos, neg, coalesce(sum(neg) OVER (PARTITION BY grp ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
SELECT grp, {r6("sum(pos * (below + neg / 2.0)) / nullif(CAST(sum(pos) AS DOUBLE) * sum(neg), 0)")} AS auc FROM c GROUP BY grp""")
def q_auc_by(spark: SparkSession, sf: str) -> DataFrame:
    """Exact AUC of returns against price, of the two statuses (all rows) and of every supplier, in one plan."""
    li = read_table(spark, sf, "lineitem").select("l_extendedprice", (F.col("l_returnflag") == "R").cast("int").alias("hit"), F.explode(F.array(
        F.concat(F.lit("status "), "l_linestatus"), F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string")))).alias("grp"))
    scored = M.evaluate(li, "auc", "hit", "l_extendedprice", by=["grp"])
    return scored.select("grp", C.round6("auc").alias("auc"))


@query("q_cv_summary", sql=f"""
WITH {PER_ORDER_SQL},
pf AS (SELECT fold, sqrt(avg((y - p) * (y - p))) AS rmse, CAST(NULL AS BIGINT) AS rounds FROM oof GROUP BY fold)
SELECT {r6('avg(rmse)')} AS cv_rmse, CAST(floor(avg(coalesce(rounds, 0))) AS BIGINT) AS cv_rounds FROM pf""")
def q_cv_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Macro mean of per-fold RMSE; rounds = floor(mean), missing rounds count 0."""
    per_fold = M.regression_metrics(oof_linear(spark, sf), "y", "prediction", by=["fold"]) \
        .withColumn("rounds", F.lit(None).cast("bigint"))
    s = M.cv_summary(per_fold, "rmse", "rounds")
    return s.select(C.round6("cv_rmse").alias("cv_rmse"), "cv_rounds")
