"""Split queries: hold-out, K-fold, grouped, stratified, stratified-grouped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfold.operators import folds as K
from tabfold.plans.registry import query
from tabfold.plans.sqlfrag import fold_sql, unit_sql
from tabfold.sources.tables import read_table

KF = 5


def _md5(key: str, seed: int = 0) -> str:
    return f"md5('{seed}:' || CAST({key} AS VARCHAR))"


@query("q_holdout", sql=f"SELECT o_orderkey, {unit_sql('o_orderkey')} < 0.25 AS is_valid FROM orders")
def q_holdout(spark: SparkSession, sf: str) -> DataFrame:
    """K1: 25 % validation flag from the key hash (stable under re-partitioning)."""
    o = read_table(spark, sf, "orders").select("o_orderkey")
    return K.holdout(o, "o_orderkey", 0.25, 0)


@query("q_kfold", sql=f"SELECT o_orderkey, {fold_sql('o_orderkey', KF)} AS fold FROM orders")
def q_kfold(spark: SparkSession, sf: str) -> DataFrame:
    """K2: shuffled K-fold by key hash."""
    return K.kfold(read_table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", KF)


@query("q_group", sql=f"SELECT event_id, user_id, {fold_sql('user_id', KF)} AS fold FROM events")
def q_group(spark: SparkSession, sf: str) -> DataFrame:
    """K3: group K-fold (a user never spans folds)."""
    e = read_table(spark, sf, "events").select("event_id", "user_id")
    return K.group_kfold(e, "user_id", KF)


@query("q_strat", sql=f"""
SELECT o_orderkey, o_orderstatus,
       CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_md5('o_orderkey')}, o_orderkey) - 1) % {KF}
            AS INTEGER) AS fold
FROM orders""")
def q_strat(spark: SparkSession, sf: str) -> DataFrame:
    """K4: stratified K-fold (salted per-class numbering)."""
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return K.stratified_kfold(o, "o_orderkey", "o_orderstatus", KF)


@query("q_strat_labels", sql=f"""
SELECT doc_id, quality,
       CAST((row_number() OVER (PARTITION BY quality ORDER BY {_md5('doc_id')}, doc_id) - 1) % {KF} AS INTEGER) AS fold
FROM labels""")
def q_strat_labels(spark: SparkSession, sf: str) -> DataFrame:
    """K4 on an imbalanced binary label."""
    lab = read_table(spark, sf, "labels").select("doc_id", "quality")
    return K.stratified_kfold(lab, "doc_id", "quality", KF)


@query("q_strat_group", sql=f"""
WITH h AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type),
d AS (SELECT user_id, event_type AS dom FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS r FROM h) WHERE r = 1),
g AS (SELECT user_id,
             CAST((row_number() OVER (PARTITION BY dom ORDER BY {_md5('user_id')}, user_id) - 1) % {KF} AS INTEGER)
             AS fold FROM d)
SELECT e.event_id, e.user_id, g.fold FROM events e JOIN g USING (user_id)""")
def q_strat_group(spark: SparkSession, sf: str) -> DataFrame:
    """K5: groups intact, stratified by each group's dominant class."""
    e = read_table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return K.dominant_class_group_kfold(e, "user_id", "event_type", KF).select("event_id", "user_id", "fold")


@query("q_strat_group_balanced", sql=f"""
WITH RECURSIVE h AS (SELECT user_id, event_type AS c, count(*) AS n FROM events GROUP BY ALL),
cls AS (SELECT c, sum(n) AS total, row_number() OVER (ORDER BY c) AS ci FROM h GROUP BY c),
tl AS (SELECT list(CAST(total AS DOUBLE) ORDER BY ci) AS total, count(*) AS nc FROM cls),
g AS (SELECT user_id, sum(n) AS n_rows, min_by(c, (-n, c)) AS dom FROM h GROUP BY 1),
thr AS (SELECT greatest(1, ceil(sum(n_rows) / ({KF} * {K.HEAVY_FACTOR}.0))) AS least FROM g),
hv AS (SELECT user_id, n_rows, row_number() OVER (ORDER BY n_rows DESC, user_id) AS i FROM g, thr WHERE n_rows >= least),
hc AS (SELECT hv.i, hv.user_id, hv.n_rows, list(coalesce(h.n, 0) ORDER BY cls.ci) AS cnt
       FROM hv JOIN cls ON true LEFT JOIN h ON h.user_id = hv.user_id AND h.c = cls.c GROUP BY ALL),
rec AS (
  SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS user_id, CAST(-1 AS BIGINT) AS fold,
    list_transform(range({KF}), lambda f: list_transform(range(nc), lambda c: CAST(0 AS BIGINT))) AS loads,
    list_transform(range({KF}), lambda f: CAST(0 AS BIGINT)) AS sizes FROM tl
  UNION ALL
  SELECT i, user_id, best, list_transform(loads, lambda l, f: CASE WHEN f - 1 = best THEN list_transform(l, lambda x, c: x + cnt[c]) ELSE l END),
    list_transform(sizes, lambda s, f: CASE WHEN f - 1 = best THEN CAST(s + n_rows AS BIGINT) ELSE s END)
  FROM (SELECT hc.i, CAST(hc.user_id AS BIGINT) AS user_id, loads, sizes, cnt, n_rows,
          list_sort(list_transform(range({KF}), lambda f: {{'rise': round(list_sum(list_transform(range(nc), lambda c: CASE WHEN cnt[c + 1] > 0 THEN
              pow((loads[f + 1][c + 1] + cnt[c + 1]) / total[c + 1] - 1.0 / {KF}, 2) - pow(loads[f + 1][c + 1] / total[c + 1] - 1.0 / {KF}, 2) ELSE 0 END)), 12),
            'size': sizes[f + 1], 'f': f}}))[1].f AS best
        FROM rec JOIN hc ON hc.i = rec.i + 1 JOIN tl ON true)
),
fin AS (SELECT loads FROM rec ORDER BY i DESC LIMIT 1),
room AS (SELECT c, list_transform(range({KF}), lambda f: greatest(0, total / {KF}.0 - loads[f + 1][ci])) AS r FROM cls, fin),
light AS (SELECT user_id, {unit_sql('user_id')} AS u, list_sum(r) AS s, r FROM g JOIN room ON dom = c, thr WHERE n_rows < least),
folds AS (
  SELECT user_id, fold FROM rec WHERE i > 0 UNION ALL
  SELECT user_id, len(list_filter(range(1, {KF}), lambda f: CASE WHEN s > 0 THEN list_sum(r[1:f]) / s ELSE f / {KF}.0 END <= u)) FROM light
)
SELECT e.event_id, e.user_id, CAST(folds.fold AS INTEGER) AS fold FROM events e JOIN folds USING (user_id)""")
def q_strat_group_balanced(spark: SparkSession, sf: str) -> DataFrame:
    """K5: groups intact, every class's share and the sizes balanced over the folds."""
    e = read_table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return K.stratified_group_kfold(e, "user_id", "event_type", KF).select("event_id", "user_id", "fold")


@query("q_fold_sizes", sql=f"""
SELECT {fold_sql('l_orderkey', KF)} AS fold, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(DISTINCT l_orderkey) AS BIGINT) AS n_orders
FROM lineitem GROUP BY 1""")
def q_fold_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """K3/K6 on lineitem: rows grouped by order never split; fold sizes."""
    li = K.group_kfold(read_table(spark, sf, "lineitem").select("l_orderkey"), "l_orderkey", KF)
    return li.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"),
                                  F.countDistinct("l_orderkey").alias("n_orders"))


_LI_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_LI_KEY_SQL = "concat_ws(chr(1), " + ", ".join(f"CAST({c} AS VARCHAR)" for c in _LI_KEY) + ")"


@query("q_strat_lineitem", sql=f"""
SELECT {", ".join(_LI_KEY)}, l_linestatus,
       CAST((row_number() OVER (PARTITION BY l_linestatus ORDER BY md5('0:' || {_LI_KEY_SQL}), {", ".join(_LI_KEY)}) - 1)
            % {KF} AS INTEGER) AS fold
FROM lineitem""")
def q_strat_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """K4 on the whole lineitem table with its unique four-column key (two large classes)."""
    li = read_table(spark, sf, "lineitem").select(*_LI_KEY, "l_linestatus")
    return K.stratified_kfold(li, _LI_KEY, "l_linestatus", KF)


@query("q_group_null", sql=f"""
WITH e AS (SELECT event_id, CASE WHEN user_id % 2 = 0 THEN user_id END AS g FROM events),
k AS (SELECT g, CAST(CAST('0x' || substr(md5('0:' || coalesce(CAST(g AS VARCHAR), chr(0) || 'null')), 1, 8) AS BIGINT) % 5 AS INTEGER) AS fold FROM e)
SELECT fold, count(*) AS n, count(DISTINCT g) AS n_groups, count(*) FILTER (WHERE g IS NULL) AS n_null FROM k GROUP BY fold""")
def q_group_null(spark: SparkSession, sf: str) -> DataFrame:
    """K3: rows without a group are a group of their own and keep their place in a fold."""
    e = read_table(spark, sf, "events").select("event_id", F.when(F.col("user_id") % 2 == 0, F.col("user_id")).alias("g"))
    return K.group_kfold(e, "g", 5).groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("g").alias("n_groups"),
                                                        F.count_if(F.col("g").isNull()).alias("n_null"))
