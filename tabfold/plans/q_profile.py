"""Profiling queries: null profile, sparse drop, duplicates, value counts,
histogram, target correlations, null rows, conditional shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfold.functions import columns as C
from tabfold.operators import profile as P
from tabfold.plans.q_flagship import Y_SQL, order_label
from tabfold.plans.registry import query
from tabfold.plans.sqlfrag import r6
from tabfold.sources.tables import read_table

LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def lineitem_injected(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem with deterministic missing values (the driver tables have none)."""
    li = read_table(spark, sf, "lineitem")
    return li.withColumns({
        "l_quantity": F.when(F.col("l_orderkey") % 10 >= 7, F.col("l_quantity")),
        "l_discount": F.when(F.col("l_partkey") % 3 != 0, F.col("l_discount")),
        "l_tax": F.when(F.col("l_suppkey") % 4 != 0, F.col("l_tax")),
        "l_shipdate": F.when(F.col("l_linenumber") != 7, F.col("l_shipdate")),
    })


LI_INJ_SQL = """li AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE WHEN l_orderkey % 10 >= 7 THEN l_quantity END AS l_quantity, l_extendedprice,
  CASE WHEN l_partkey % 3 <> 0 THEN l_discount END AS l_discount,
  CASE WHEN l_suppkey % 4 <> 0 THEN l_tax END AS l_tax, l_returnflag, l_linestatus,
  CASE WHEN l_linenumber <> 7 THEN l_shipdate END AS l_shipdate FROM lineitem)"""

_NULL_UNION = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_null, count(*) AS n_rows FROM li"
    for c in LI_COLS)


@query("q_missing_profile", sql=f"""
WITH {LI_INJ_SQL}, p AS ({_NULL_UNION})
SELECT "column", CAST(n_null AS BIGINT) AS n_null, {r6('n_null * 100.0 / n_rows')} AS null_pct FROM p""")
def q_missing_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Null count and share per column in one pass."""
    prof = P.null_profile(lineitem_injected(spark, sf), LI_COLS)
    return prof.select("column", "n_null", C.round6("null_pct").alias("null_pct"))


@query("q_drop_sparse", sql=f"""
WITH {LI_INJ_SQL}, p AS ({_NULL_UNION})
SELECT "column" FROM p WHERE NOT (n_null * 100.0 / n_rows > 60)""")
def q_drop_sparse(spark: SparkSession, sf: str) -> DataFrame:
    """Fitted drop of columns more than 60 % null; returns surviving columns."""
    df = lineitem_injected(spark, sf)
    model = P.DropSparse(maxNullPct=60.0).fit(df)
    kept = model.transform(df).columns
    return spark.createDataFrame([(c,) for c in kept], "column string")


@query("q_duplicates", sql="""
SELECT CAST(sum(c) AS BIGINT) AS n_rows, CAST(sum(c - 1) AS BIGINT) AS n_duplicates
FROM (SELECT count(*) AS c FROM documents GROUP BY text, lang, source)""")
def q_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Rows beyond the first per identical feature tuple (key excluded)."""
    return P.duplicate_count(read_table(spark, sf, "documents"), ["text", "lang", "source"])


@query("q_value_counts", sql=f"""
WITH o AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS p FROM orders),
v AS (SELECT p AS o_orderpriority, count(*) AS n FROM o WHERE p IS NOT NULL GROUP BY p)
SELECT o_orderpriority, CAST(n AS BIGINT) AS n, {r6('n * 100.0 / (SELECT sum(n) FROM v)')} AS pct,
       CAST(CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '4-NOT SPECIFIED' THEN 1 WHEN '3-MEDIUM' THEN 2
            WHEN '2-HIGH' THEN 3 WHEN '1-URGENT' THEN 4 ELSE 5 END AS INTEGER) AS order_code
FROM v""")
def q_value_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts, share of total, custom (ordered categorical) code."""
    o = read_table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")).alias("o_orderpriority"))
    vc = P.value_counts(o, "o_orderpriority")
    order = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]
    return vc.select("o_orderpriority", "n", C.round6("pct").alias("pct"),
                     C.order_code("o_orderpriority", order).cast("int").alias("order_code"))


@query("q_hist20", sql=f"""
WITH m AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT CAST(least(floor((l_extendedprice - lo) / (hi - lo) * 20), 19) AS INTEGER) AS bin, lo, hi
      FROM lineitem, m)
SELECT bin, {r6('min(lo) + bin * ((min(hi) - min(lo)) / 20)')} AS lo,
       {r6('min(lo) + (bin + 1) * ((min(hi) - min(lo)) / 20)')} AS hi, CAST(count(*) AS BIGINT) AS n
FROM b GROUP BY bin""")
def q_hist20(spark: SparkSession, sf: str) -> DataFrame:
    """20 equal-width bins, last bin closed."""
    h = P.histogram(read_table(spark, sf, "lineitem"), "l_extendedprice", 20)
    return h.select("bin", C.round6("lo").alias("lo"), C.round6("hi").alias("hi"), "n")


def order_features(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("n_lines"),
        F.avg("l_discount").alias("avg_disc"), F.avg("l_tax").alias("avg_tax"),
        F.max("l_quantity").alias("max_qty"), order_label().alias("y"))


ORDER_FEATS_SQL = f"""po AS (SELECT l_orderkey, sum(l_quantity) AS qty, count(*) AS n_lines,
  avg(l_discount) AS avg_disc, avg(l_tax) AS avg_tax, max(l_quantity) AS max_qty,
  {Y_SQL} AS y FROM lineitem GROUP BY l_orderkey)"""
FEATS = ["qty", "n_lines", "avg_disc", "avg_tax", "max_qty"]


@query("q_corr_target", sql=f"""
WITH {ORDER_FEATS_SQL},
c AS ({" UNION ALL ".join(f"SELECT '{f}' AS feature, corr({f}, y) AS corr FROM po" for f in FEATS)})
SELECT feature, {r6('corr')} AS corr FROM c WHERE abs(corr) > 0.1""")
def q_corr_target(spark: SparkSession, sf: str) -> DataFrame:
    """Pearson r of each feature with the target, |r| > 0.1, ascending."""
    c = P.target_correlations(order_features(spark, sf), FEATS, "y", min_abs=0.1)
    return c.select("feature", C.round6("corr").alias("corr"))


@query("q_corr_matrix", sql=f"""
WITH {ORDER_FEATS_SQL}
{" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {r6(f'corr({a}, {b})')} AS corr FROM po"
                    for i, a in enumerate(FEATS) for b in FEATS[i + 1:])}""")
def q_corr_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """G8 (full matrix): every feature pair in one aggregation."""
    m = P.correlation_matrix(order_features(spark, sf), FEATS)
    return m.select("a", "b", C.round6("corr").alias("corr"))


_WIDE = 34


def _wide_sql(k: int) -> str:
    """Column k of the wide table: a mix of quantity, price and order, null in a row of eleven."""
    return f"CASE WHEN (l_orderkey + {k}) % 11 <> 0 THEN CAST(l_quantity AS DOUBLE) * {k % 5} + CAST((l_orderkey * {k + 3}) % {k + 17} AS DOUBLE) + CAST(l_extendedprice AS DOUBLE) / {10_000 * (k + 1)} END"


@query("q_corr_wide", sql=f"""
WITH w AS (SELECT {", ".join(f"{_wide_sql(k)} AS x{k}" for k in range(_WIDE))} FROM lineitem),
r AS (SELECT unnest([{", ".join(f"{{'a': 'x{i}', 'b': 'x{j}', 'corr': corr(x{i}, x{j})}}" for i in range(_WIDE) for j in range(i + 1, _WIDE))}]) AS p FROM w)
SELECT p.a AS a, p.b AS b, {r6('p.corr', 5)} AS corr FROM r""")
def q_corr_wide(spark: SparkSession, sf: str) -> DataFrame:
    """G8 over many columns with nulls: pairwise complete, by matrix products."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    wide = li.selectExpr(*[f"{_wide_sql(k)} AS x{k}" for k in range(_WIDE)])
    return P.correlation_matrix(wide, [f"x{k}" for k in range(_WIDE)]).select("a", "b", C.round6("corr", 5).alias("corr"))


@query("q_null_rows", sql=f"""
WITH {LI_INJ_SQL}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, l_tax
FROM li WHERE l_quantity IS NULL OR l_discount IS NULL OR l_tax IS NULL
ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber LIMIT 20""")
def q_null_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The first 20 rows (by key) with a null in a column set (head is the feature)."""
    li = lineitem_injected(spark, sf)
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return (li.where(C.any_null(["l_quantity", "l_discount", "l_tax"]))
              .select(*keys, "l_quantity", "l_discount", "l_tax").orderBy(*keys).limit(20))


@query("q_class_shares", sql=f"""
WITH {ORDER_FEATS_SQL},
c AS (SELECT CASE WHEN y < 30 THEN 0 WHEN y < 50 THEN 1 WHEN y < 80 THEN 2 ELSE 3 END AS severity, n_lines FROM po)
SELECT severity, {r6('avg(CASE WHEN n_lines < 3 THEN 1.0 ELSE 0.0 END)')} AS share_few_lines,
       CAST(count(*) AS BIGINT) AS n
FROM c GROUP BY severity""")
def q_class_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Per severity class, share of orders with fewer than 3 lines."""
    po = order_features(spark, sf).withColumn("severity", C.ordinal_bin("y", C.SEVERITY_CUTS))
    s = P.conditional_share(po, "severity", F.col("n_lines") < 3, "share_few_lines")
    return s.select("severity", C.round6("share_few_lines").alias("share_few_lines"), "n")
