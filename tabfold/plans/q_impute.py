"""Exact median, median imputation and fold-safe imputation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfold.functions import columns as C
from tabfold.operators import impute as I
from tabfold.operators.folds import kfold
from tabfold.operators.quantiles import exact_medians
from tabfold.plans.q_profile import LI_INJ_SQL, lineitem_injected
from tabfold.plans.registry import query
from tabfold.plans.sqlfrag import fold_sql, r6
from tabfold.sources.tables import read_table

MED_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query("q_median", sql=f"""
WITH {LI_INJ_SQL}
{" UNION ALL ".join(f"SELECT '{c}' AS \"column\", {r6(f'median(CAST({c} AS DOUBLE))')} AS value FROM li"
                    for c in MED_COLS)}""")
def q_median(spark: SparkSession, sf: str) -> DataFrame:
    """Exact interpolated median of every column, nulls ignored."""
    m = exact_medians(lineitem_injected(spark, sf), MED_COLS)
    return m.select("column", C.round6("value").alias("value"))


_TIE_COLS = {"quantity": "l_quantity", "coin": "CAST(l_linenumber % 2 AS DOUBLE)", "half": "CASE WHEN l_orderkey % 2 = 0 THEN 3.0 ELSE 8.0 END"}


@query("q_median_ties", sql=" UNION ALL ".join(
    f"SELECT '{n}' AS \"column\", {r6(f'median(CAST({e} AS DOUBLE))')} AS value FROM lineitem" for n, e in _TIE_COLS.items()))
def q_median_ties(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of few values, searched down to single values (no interval may hold more than 5)."""
    li = read_table(spark, sf, "lineitem").select(*[F.expr(e).cast("double").alias(n) for n, e in _TIE_COLS.items()])
    return exact_medians(li, list(_TIE_COLS), max_band=5, small=0).select("column", C.round6("value").alias("value"))


def _part_injected(spark, sf):
    p = read_table(spark, sf, "part")
    return p.select("p_partkey",
                    F.when(F.col("p_partkey") % 3 != 0, F.col("p_size")).alias("p_size"),
                    F.when(F.col("p_partkey") % 5 != 0, F.col("p_retailprice")).alias("p_retailprice"))


@query("q_impute_apply", sql=f"""
WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN p_size END AS p_size,
                  CASE WHEN p_partkey % 5 <> 0 THEN p_retailprice END AS p_retailprice FROM part)
SELECT p_partkey, {r6('coalesce(CAST(p_size AS DOUBLE), (SELECT median(CAST(p_size AS DOUBLE)) FROM p))')} AS p_size,
       {r6('coalesce(p_retailprice, (SELECT median(p_retailprice) FROM p))')} AS p_retailprice
FROM p""")
def q_impute_apply(spark: SparkSession, sf: str) -> DataFrame:
    """Fit medians on all rows, fill every null (Estimator/Model)."""
    p = _part_injected(spark, sf)
    model = I.MedianImputer(inputCols=["p_size", "p_retailprice"]).fit(p)
    out = model.transform(p)
    return out.select("p_partkey", C.round6("p_size").alias("p_size"),
                      C.round6("p_retailprice").alias("p_retailprice"))


def _order_feats_injected(spark, sf):
    li = read_table(spark, sf, "lineitem")
    po = li.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("qty"), F.avg("l_discount").alias("avg_disc"))
    po = po.withColumns({"qty": F.when(F.col("l_orderkey") % 6 != 0, F.col("qty")),
                         "avg_disc": F.when(F.col("l_orderkey") % 4 != 0, F.col("avg_disc"))})
    return kfold(po, "l_orderkey", 5)


_PO_INJ_SQL = f"""po AS (SELECT l_orderkey, CASE WHEN l_orderkey % 6 <> 0 THEN sum(l_quantity) END AS qty,
  CASE WHEN l_orderkey % 4 <> 0 THEN avg(l_discount) END AS avg_disc FROM lineitem GROUP BY l_orderkey),
f AS (SELECT *, {fold_sql('l_orderkey', 5)} AS fold FROM po),
ks AS (SELECT CAST(range AS INTEGER) AS k FROM range(5))"""


@query("q_impute_fold", sql=f"""
WITH {_PO_INJ_SQL}
SELECT ks.k AS train_fold, 'qty' AS "column", {r6('median(f.qty)')} AS value FROM f JOIN ks ON f.fold <> ks.k GROUP BY ks.k
UNION ALL
SELECT ks.k AS train_fold, 'avg_disc' AS "column", {r6('median(f.avg_disc)')} AS value FROM f JOIN ks ON f.fold <> ks.k GROUP BY ks.k
""")
def q_impute_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Medians fitted per fold on the other folds' rows only."""
    m = I.fold_medians(_order_feats_injected(spark, sf), ["qty", "avg_disc"], 5)
    return m.select(F.col("train_fold").cast("int").alias("train_fold"), "column", C.round6("value").alias("value"))


@query("q_impute_fold_apply", sql=f"""
WITH {_PO_INJ_SQL},
m AS (SELECT ks.k AS fold, median(f.qty) AS mq, median(f.avg_disc) AS md FROM f JOIN ks ON f.fold <> ks.k GROUP BY ks.k)
SELECT f.l_orderkey, f.fold, {r6('coalesce(f.qty, m.mq)')} AS qty, {r6('coalesce(f.avg_disc, m.md)')} AS avg_disc
FROM f JOIN m USING (fold)""")
def q_impute_fold_apply(spark: SparkSession, sf: str) -> DataFrame:
    """G7 applied: each row filled with medians that never saw its fold."""
    out = I.impute_by_fold(_order_feats_injected(spark, sf), ["qty", "avg_disc"], 5)
    return out.select("l_orderkey", "fold", C.round6("qty").alias("qty"), C.round6("avg_disc").alias("avg_disc"))


@query("q_median_by_group", sql=f"""
SELECT event_type, 'value' AS "column", {r6('median(value)')} AS value FROM events GROUP BY event_type
UNION ALL
SELECT event_type, 'user_id' AS "column", {r6('median(CAST(user_id AS DOUBLE))')} AS value FROM events GROUP BY event_type""")
def q_median_by_group(spark: SparkSession, sf: str) -> DataFrame:
    """G5 grouped: exact medians per (group, column) in one set of passes."""
    e = read_table(spark, sf, "events")
    m = exact_medians(e, ["value", "user_id"], by=["event_type"])
    return m.select("event_type", "column", C.round6("value").alias("value"))
