"""Queries over column operators: encodings, fills, products/ratios, bins,
row-wise sums and null counts, certain classes, label maps, rounding, schema."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfold.functions import columns as C
from tabfold.plans.q_flagship import Y_SQL, order_label
from tabfold.plans.registry import query
from tabfold.plans.sqlfrag import r6
from tabfold.sources import schema as S
from tabfold.sources.csv import NA_TOKENS
from tabfold.sources.tables import read_table

# fixed values for the driver tables: a partial order-priority code table
PRIORITY_CODES = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2}
# fixed values: class code -> text
CLASS_LABELS = {0: "None", 1: "Mild", 2: "Moderate", 3: "Severe"}
# items per order (line numbers 1..7), each 0..5; class cuts on the 0..35 total
ITEM_LINES = list(range(1, 8))
ITEM_CUTS = (11.0, 18.0, 25.0)


def _orders_injected(spark, sf):
    """Orders with deterministic null and empty priorities (driver tables have none)."""
    o = read_table(spark, sf, "orders")
    pr = (F.when(F.col("o_orderkey") % 7 == 0, F.lit(None).cast("string"))
           .when(F.col("o_orderkey") % 11 == 0, F.lit("")).otherwise(F.col("o_orderpriority")))
    return o.withColumn("o_orderpriority", pr)


ORDERS_INJ_SQL = """o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN '' ELSE o_orderpriority END
  AS o_orderpriority FROM orders)"""


@query("q_ordinal_encode", sql=f"""
WITH {ORDERS_INJ_SQL}
SELECT o_orderkey,
       CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2
            ELSE -1 END AS INTEGER) AS priority_code
FROM o""")
def q_ordinal_encode(spark: SparkSession, sf: str) -> DataFrame:
    """String -> code, null/empty/unknown -> -1."""
    o = _orders_injected(spark, sf)
    return o.select("o_orderkey", C.ordinal_encode("o_orderpriority", PRIORITY_CODES)
                    .cast("int").alias("priority_code"))


@query("q_fill_constant", sql="""
SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END, -1.0) AS o_totalprice
FROM orders""")
def q_fill_constant(spark: SparkSession, sf: str) -> DataFrame:
    """Explicit -1 marker for missing values."""
    o = read_table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("o_totalprice"))
    return C.fill_constant(o, ["o_totalprice"], -1.0)


@query("q_products_ratios", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CAST(floor((l_quantity * l_discount) * 1000000.0 + 0.5) / 1000000.0 AS DOUBLE) AS qty_x_disc,
       CAST(floor((l_extendedprice * l_tax) * 1000000.0 + 0.5) / 1000000.0 AS DOUBLE) AS price_x_tax,
       CAST(floor((l_extendedprice / nullif(l_quantity, 0)) * 1000000.0 + 0.5) / 1000000.0 AS DOUBLE) AS unit_price,
       CAST(floor((l_tax / nullif(l_discount, 0)) * 1000000.0 + 0.5) / 1000000.0 AS DOUBLE) AS tax_per_disc
FROM lineitem""")
def q_products_ratios(spark: SparkSession, sf: str) -> DataFrame:
    """S3: products (null-propagating) and ratios (zero denominator -> null)."""
    li = read_table(spark, sf, "lineitem")
    out = C.feature_products(li, {"qty_x_disc": ("l_quantity", "l_discount"),
                                  "price_x_tax": ("l_extendedprice", "l_tax")})
    out = C.feature_ratios(out, {"unit_price": ("l_extendedprice", "l_quantity"),
                                 "tax_per_disc": ("l_tax", "l_discount")})
    feats = ["qty_x_disc", "price_x_tax", "unit_price", "tax_per_disc"]
    return out.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                      *[C.round6(c).alias(c) for c in feats])


@query("q_bin_left", sql=f"""
WITH po AS (SELECT l_orderkey, {Y_SQL} AS y FROM lineitem GROUP BY l_orderkey)
SELECT CASE WHEN y * 1.2525 < 30 THEN 0 WHEN y * 1.2525 < 50 THEN 1 WHEN y * 1.2525 < 80 THEN 2 ELSE 3 END
       AS severity, CAST(count(*) AS BIGINT) AS n
FROM po GROUP BY 1""")
def q_bin_left(spark: SparkSession, sf: str) -> DataFrame:
    """Scaled score -> left-closed severity class, counted."""
    po = read_table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        order_label().alias("y"))
    return (po.select(C.scaled_class("y", 1.2525).alias("severity"))
              .groupBy("severity").agg(F.count(F.lit(1)).alias("n")))


@query("q_bin_right", sql="""
SELECT CASE WHEN l_quantity > 4 AND l_quantity <= 12 THEN 0 WHEN l_quantity > 12 AND l_quantity <= 18 THEN 1
            WHEN l_quantity > 18 AND l_quantity <= 22 THEN 2 END AS age_group,
       CAST(count(*) AS BIGINT) AS n
FROM lineitem GROUP BY 1""")
def q_bin_right(spark: SparkSession, sf: str) -> DataFrame:
    """Right-closed inner bins (4,12], (12,18], (18,22]; outside -> null."""
    li = read_table(spark, sf, "lineitem")
    return (li.select(C.ordinal_bin("l_quantity", [4, 12, 18, 22], right=True, open_ends=False)
                      .alias("age_group"))
              .groupBy("age_group").agg(F.count(F.lit(1)).alias("n")))


def order_items(spark: SparkSession, sf: str) -> DataFrame:
    """Wide per-order item table: item_i in 0..5 from line i (null if absent/injected)."""
    li = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_partkey") % 9 != 0,
               F.least(F.lit(5.0), F.floor(F.col("l_quantity") / 10))).alias("item"))
    # (order, line) is not unique: lines with the same number are added up
    return (li.groupBy("l_orderkey").pivot("l_linenumber", ITEM_LINES).agg(F.sum("item"))
              .toDF("l_orderkey", *[f"item_{i}" for i in ITEM_LINES]))


ITEMS_SQL = "items AS (SELECT l_orderkey, " + ", ".join(
    f"sum(CASE WHEN l_linenumber = {i} AND l_partkey % 9 <> 0 THEN least(5.0, floor(l_quantity / 10)) END)"
    f" AS item_{i}" for i in ITEM_LINES) + " FROM lineitem GROUP BY l_orderkey)"
ITEM_COLS = [f"item_{i}" for i in ITEM_LINES]
_SUM_SQL = " + ".join(f"coalesce({c}, 0)" for c in ITEM_COLS)
_NULLS_SQL = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in ITEM_COLS)
_ALL_SQL = " AND ".join(f"{c} IS NOT NULL" for c in ITEM_COLS)


def _bin_sql(x: str, cuts) -> str:
    a, b, c = cuts
    return f"CASE WHEN {x} < {a} THEN 0 WHEN {x} < {b} THEN 1 WHEN {x} < {c} THEN 2 ELSE 3 END"


@query("q_recalc_class", sql=f"""
WITH {ITEMS_SQL},
t AS (SELECT l_orderkey, {_SUM_SQL} AS total, {_NULLS_SQL} AS n_missing,
             CASE WHEN {_ALL_SQL} THEN {_SUM_SQL} END AS total_complete FROM items),
c AS (SELECT *, CASE WHEN {_bin_sql('total', ITEM_CUTS)} = {_bin_sql('total + 5 * n_missing', ITEM_CUTS)}
                     THEN {_bin_sql('total', ITEM_CUTS)} END AS certain FROM t)
SELECT l_orderkey, total, n_missing, total_complete, certain,
       coalesce(CASE certain WHEN 0 THEN 'None' WHEN 1 THEN 'Mild' WHEN 2 THEN 'Moderate'
                WHEN 3 THEN 'Severe' END, 'Missing') AS certain_label
FROM c""")
def q_recalc_class(spark: SparkSession, sf: str) -> DataFrame:
    """Row sum, null count, complete-only total, certain class, label map."""
    w = order_items(spark, sf)
    n_missing = C.row_null_count(ITEM_COLS)
    out = w.select("l_orderkey", C.row_sum(ITEM_COLS).alias("total"),
                   n_missing.alias("n_missing"),
                   C.keep_if_complete(C.row_sum(ITEM_COLS), ITEM_COLS).alias("total_complete"))
    out = out.withColumn("certain", C.certain_class("total", F.col("n_missing"), 5, ITEM_CUTS))
    return out.withColumn("certain_label", C.label_map("certain", CLASS_LABELS))


@query("q_row_sum_check", sql=f"""
WITH {ITEMS_SQL},
direct AS (SELECT l_orderkey, sum(it) AS stored FROM (
    SELECT l_orderkey, l_linenumber,
           sum(CASE WHEN l_partkey % 9 <> 0 THEN least(5.0, floor(l_quantity / 10)) END) AS it
    FROM lineitem GROUP BY l_orderkey, l_linenumber) GROUP BY l_orderkey)
SELECT CAST(count(*) AS BIGINT) AS n_orders,
       bool_and(coalesce(({_SUM_SQL}) = d.stored, false)) AS all_equal,
       CAST(sum(CASE WHEN coalesce(({_SUM_SQL}) = d.stored, false) THEN 0 ELSE 1 END) AS BIGINT) AS n_differ
FROM items i JOIN direct d USING (l_orderkey)""")
def q_row_sum_check(spark: SparkSession, sf: str) -> DataFrame:
    """Recomputed row total equals a stored total (NaN/null never equal)."""
    w = order_items(spark, sf)
    li = read_table(spark, sf, "lineitem")
    per_line = li.groupBy("l_orderkey", "l_linenumber").agg(F.sum(
        F.when(F.col("l_partkey") % 9 != 0, F.least(F.lit(5.0), F.floor(F.col("l_quantity") / 10)))).alias("it"))
    stored = per_line.groupBy("l_orderkey").agg(F.sum("it").alias("stored"))
    eq = F.coalesce(C.row_sum(ITEM_COLS) == F.col("stored"), F.lit(False))
    return (w.join(stored, "l_orderkey")
              .agg(F.count(F.lit(1)).alias("n_orders"), F.bool_and(eq).alias("all_equal"),
                   F.sum(F.when(eq, 0).otherwise(1)).cast("bigint").alias("n_differ")))


@query("q_inconsistent", sql=f"""
WITH {ITEMS_SQL}
SELECT * FROM (
  SELECT {", ".join(f"CAST(count(*) FILTER (WHERE item_{i} IS NULL AND item_{i+1} IS NOT NULL) AS BIGINT) AS gap_{i}_{i+1}"
                    for i in ITEM_LINES[:-1])}
  FROM items)""")
def q_inconsistent(spark: SparkSession, sf: str) -> DataFrame:
    """Per column pair, rows where the first is missing but the next is present (one pass)."""
    w = order_items(spark, sf)
    return w.agg(*[F.count_if(F.col(f"item_{i}").isNull() & F.col(f"item_{i+1}").isNotNull())
                   .cast("bigint").alias(f"gap_{i}_{i+1}") for i in ITEM_LINES[:-1]])


@query("q_round_even", sql="""
SELECT round_even(l_quantity / 4, 0) AS q4, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1""")
def q_round_even(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest integer, ties to even (2.5 -> 2)."""
    li = read_table(spark, sf, "lineitem")
    return li.groupBy(C.round_half_even(F.col("l_quantity") / 4).alias("q4")).agg(
        F.count(F.lit(1)).alias("n"))


@query("q_weighted_avg", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CAST(floor(((l_discount * 2.0 + l_tax * 1.0 + 0.05 * 0.5) / 3.5) * 1000000.0 + 0.5) / 1000000.0 AS DOUBLE) AS blend
FROM lineitem""")
def q_weighted_avg(spark: SparkSession, sf: str) -> DataFrame:
    """Σ w_i p_i / Σ w_i across columns."""
    li = read_table(spark, sf, "lineitem").withColumn("c", F.lit(0.05))
    return li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                     C.round6(C.weighted_average(["l_discount", "l_tax", "c"], [2.0, 1.0, 0.5])).alias("blend"))


_LI_NULLABLE_SQL = """li AS (SELECT l_orderkey, l_partkey, l_suppkey,
  CASE WHEN l_orderkey % 13 <> 0 THEN l_linenumber END AS l_linenumber, l_quantity, l_extendedprice,
  l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem)"""


def _model_sql(view: str, base: str) -> str:
    return f"""SELECT d.column_name AS "column",
       CASE WHEN d.column_type IN ('BIGINT', 'INTEGER', 'SMALLINT', 'TINYINT')
                 THEN CASE WHEN n.has_null THEN 'float' ELSE 'int' END
            WHEN d.column_type IN ('DOUBLE', 'FLOAT') THEN 'float' ELSE 'str' END AS "type"
FROM (DESCRIBE {base}) d LEFT JOIN (
  SELECT unnest(['l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber']) AS column_name,
         unnest([bool_or(l_orderkey IS NULL), bool_or(l_partkey IS NULL), bool_or(l_suppkey IS NULL),
                 bool_or(l_linenumber IS NULL)]) AS has_null FROM {view}) n USING (column_name)"""


@query("q_schema_export", sql=f"WITH {_LI_NULLABLE_SQL} " + _model_sql("li", "lineitem"))
def q_schema_export(spark: SparkSession, sf: str) -> DataFrame:
    """Data model inferred from the rows (an int column with nulls exports as float)."""
    li = read_table(spark, sf, "lineitem").withColumn(
        "l_linenumber", F.when(F.col("l_orderkey") % 13 != 0, F.col("l_linenumber")))
    return spark.createDataFrame(list(S.infer_data_model(li).items()), "column string, type string")


@query("q_schema_enforce", sql="""
SELECT event_id, user_id, CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS value,
       TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       (CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END) IS NOT NULL
         AND TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) IS NOT NULL AS is_valid
FROM events""")
def q_schema_enforce(spark: SparkSession, sf: str) -> DataFrame:
    """Apply a frozen data model (try-cast, required fields) and flag rejects."""
    ev = read_table(spark, sf, "events").select(
        "event_id", "user_id",
        F.when(F.col("event_id") % 13 != 0, F.col("value")).alias("value"),
        F.get_json_object("props", "$.k").alias("k"))
    model = json.loads('{"fields": {"event_id": "int", "user_id": "int", "value": "float", "k": "int"}}')
    return S.enforce(ev, model, required=["value", "k"], flag="is_valid")


# ---------------------------------------------------------------- preprocessing chain / CSV

def _season_sql(m: str) -> str:
    return (f"CASE WHEN {m} IN (3, 4, 5) THEN 'Spring' WHEN {m} IN (6, 7, 8) THEN 'Summer' "
            f"WHEN {m} IN (9, 10, 11) THEN 'Fall' ELSE 'Winter' END")


def survey_like_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders shaped like the survey table: a season column, a leaked column, a sparse column."""
    o = read_table(spark, sf, "orders")
    m = F.month("o_orderdate")
    season = (F.when(m.isin(3, 4, 5), "Spring").when(m.isin(6, 7, 8), "Summer")
               .when(m.isin(9, 10, 11), "Fall").otherwise("Winter"))
    season = (F.when(F.col("o_orderkey") % 7 == 0, F.lit(None).cast("string"))
               .when(F.col("o_orderkey") % 11 == 0, F.lit("")).otherwise(season))
    return o.select(F.col("o_orderkey").alias("id"), season.alias("Order_Season"),
                    F.col("o_totalprice").alias("PCIAT_Total"),
                    F.when(F.col("o_orderkey") % 10 >= 7, F.col("o_totalprice")).alias("Sparse_Price"),
                    F.col("o_totalprice").alias("Price"), F.col("o_custkey").cast("double").alias("Cust"))


PRE_PRODUCTS = {"Price_x_Cust": ("Price", "Cust")}
PRE_RATIOS = {"Price_per_Cust": ("Price", "Cust"), "Sparse_per_Cust": ("Sparse_Price", "Cust")}


@query("q_preprocess", sql=f"""
WITH o AS (SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN '' ELSE {_season_sql('month(o_orderdate)')} END
    AS s, o_totalprice AS price, CAST(o_custkey AS DOUBLE) AS cust FROM orders)
SELECT id, CAST(CASE s WHEN 'Spring' THEN 0 WHEN 'Summer' THEN 1 WHEN 'Fall' THEN 2 WHEN 'Winter' THEN 3 ELSE -1 END
            AS INTEGER) AS Order_Season,
       price AS Price, cust AS Cust, {r6('price * cust')} AS Price_x_Cust,
       {r6('price / nullif(cust, 0)')} AS Price_per_Cust
FROM o""")
def q_preprocess(spark: SparkSession, sf: str) -> DataFrame:
    """Fitted preprocessing chain (season codes, leak and sparse drops, features)."""
    from tabfold.operators.preprocess import SurveyPreprocessor
    df = survey_like_orders(spark, sf)
    model = SurveyPreprocessor(products=PRE_PRODUCTS, ratios=PRE_RATIOS, protect=["id"]).fit(df)
    out = model.transform(df)
    return out.select("id", F.col("Order_Season").cast("int").alias("Order_Season"), "Price", "Cust",
                      C.round6("Price_x_Cust").alias("Price_x_Cust"),
                      C.round6("Price_per_Cust").alias("Price_per_Cust"))


@query("q_select_numeric", sql="SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def q_select_numeric(spark: SparkSession, sf: str) -> DataFrame:
    """Role selection by type: keep the numeric (and boolean) columns, drop the rest."""
    o = read_table(spark, sf, "orders")
    return C.select_numeric(o)


@query("q_csv_roundtrip", sql=f"""
WITH po AS (SELECT l_orderkey, sum(l_quantity) AS qty, {Y_SQL} AS y
            FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey AS Order_Key, qty AS Total_Qty_, {r6('y')} AS Target_y FROM po WHERE l_orderkey % 9 <> 0""")
def q_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A4 -> A1/A2/P1/P2: CSV sink with raw names, load back: clean names, NA tokens, drop null targets."""
    import uuid

    from tabfold.session import scratch_path
    from tabfold.sources import csv as CSV
    li = read_table(spark, sf, "lineitem")
    po = li.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("qty"), order_label().alias("y"))
    raw = po.select(F.col("l_orderkey").alias("Order-Key"), F.col("qty").alias("Total Qty (#)"),
                    F.when(F.col("l_orderkey") % 9 != 0, F.col("y").cast("string")).otherwise(F.lit("NA"))
                    .alias("Target-y"))
    path = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    CSV.write_csv(raw, path)
    back = CSV.load_labelled(spark, path, "Target-y", key="Order-Key")
    return back.withColumn("Target_y", C.round6("Target_y"))


_NA_SQL = ", ".join("'" + t + "'" for t in NA_TOKENS)


@query("q_csv_quotes", sql=f"""
SELECT doc_id, md5(t) AS text_md5, length(t) AS n_chars, len(string_split(t, chr(10))) AS n_lines
FROM (SELECT doc_id, CASE WHEN text NOT IN ({_NA_SQL}) THEN text END AS t FROM documents)""")
def q_csv_quotes(spark: SparkSession, sf: str) -> DataFrame:
    """A1/A3/A4: whole texts (line breaks, quotation marks) through CSV: written, cut into records by many tasks, read back."""
    import uuid

    from tabfold.session import scratch_path
    from tabfold.sources import csv as CSV
    path = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    CSV.write_csv(read_table(spark, sf, "documents").select("doc_id", "text"), path, quote_all=True)
    back = CSV.load_unlabelled(spark, path)
    return back.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n_chars"),
                       F.size(F.split("text", "\n")).cast("long").alias("n_lines"))
