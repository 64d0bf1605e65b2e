"""Queries over text cleaning, readability and cyclical time features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfold.functions import columns as C
from tabfold.functions import text as X
from tabfold.functions import timefeat as TF
from tabfold.plans.registry import query
from tabfold.plans.sqlfrag import r6
from tabfold.sources.tables import read_table

_STOP_SQL = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in X.ENGLISH_STOPWORDS) + "]"


def _re(expr: str, pat: str, rep: str) -> str:
    return f"regexp_replace({expr}, '{pat}', '{rep}', 'g')"


def normalise_sql(col: str) -> str:
    t = f"lower({col})"
    t = _re(t, X.TAG_RE, "")
    t = _re(t, X.URL_RE, "")
    t = _re(t, X.HANDLE_RE, "")
    t = _re(t, X.ISOLATED_LETTER_RE, " ")
    return _re(t, X.MULTI_SPACE_RE, " ")


def strip_sql(expr: str) -> str:
    return _re(_re(expr, "^" + X.WS + "+", ""), X.WS + "+\\z", "")


def clean_sql(col: str) -> str:
    kept = f"list_filter(string_split({normalise_sql(col)}, ' '), lambda w: NOT list_contains({_STOP_SQL}, w))"
    return strip_sql(f"array_to_string({kept}, ' ')")


def words_sql(e: str) -> str:
    return f"CAST(len(regexp_split_to_array({e}, '{X.WORD_SPLIT_RE}')) AS DOUBLE)"


def sents_sql(e: str) -> str:
    return f"CAST(len(regexp_split_to_array({e}, '{X.SENTENCE_SPLIT_RE}')) AS DOUBLE)"


def ari_sql(cleaned: str) -> str:
    return (f"4.71 * (CAST(length({cleaned}) AS DOUBLE) / {words_sql(cleaned)}) + "
            f"0.5 * ({words_sql(cleaned)} / {sents_sql(cleaned)}) - 21.43")


@query("q_clean_text", sql=f"SELECT doc_id, {clean_sql('text')} AS clean FROM documents")
def q_clean_text(spark: SparkSession, sf: str) -> DataFrame:
    """S14a-h: full cleaning chain on whole documents."""
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    return X.clean_text(d, "text", "clean").select("doc_id", "clean")


@query("q_strip_html", sql=f"""
SELECT page_id, {_re('html', X.TAG_RE, '')} AS body, CAST(length({_re('html', X.TAG_RE, '')}) AS BIGINT) AS n_chars
FROM pages""")
def q_strip_html(spark: SparkSession, sf: str) -> DataFrame:
    """S14b on raw web pages."""
    p = read_table(spark, sf, "pages")
    body = X.strip_tags("html")
    return p.select("page_id", body.alias("body"), F.length(body).cast("bigint").alias("n_chars"))


@query("q_ari", sql=f"""
WITH c AS (SELECT doc_id, {clean_sql('text')} AS clean FROM documents)
SELECT doc_id, {r6(ari_sql('clean'))} AS ari FROM c""")
def q_ari(spark: SparkSession, sf: str) -> DataFrame:
    """Automated readability index of the cleaned text."""
    d = X.clean_text(read_table(spark, sf, "documents").select("doc_id", "text"), "text", "clean")
    return d.select("doc_id", C.round6(X.ari("clean")).alias("ari"))


@query("q_eflaw", sql=f"""
SELECT doc_id, {r6(f"({words_sql('text')} + {sents_sql('text')} * {words_sql('text')}) / {sents_sql('text')}")} AS eflaw
FROM documents""")
def q_eflaw(spark: SparkSession, sf: str) -> DataFrame:
    """EFLAW of the raw text."""
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", C.round6(X.eflaw("text")).alias("eflaw"))


@query("q_clri", sql=f"""
SELECT doc_id, {r6(f"0.0588 * (100.0 * CAST(length(text) AS DOUBLE) / {words_sql('text')}) - "
                   f"0.296 * (100.0 * {sents_sql('text')} / {words_sql('text')}) - 15.8")} AS clri
FROM documents""")
def q_clri(spark: SparkSession, sf: str) -> DataFrame:
    """Coleman-Liau index of the raw text."""
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", C.round6(X.clri("text")).alias("clri"))


@query("q_conv_readability", sql=f"""
WITH c AS (SELECT role, text, {clean_sql('text')} AS clean FROM conversations)
SELECT role, CAST(count(*) AS BIGINT) AS n, {r6(f"avg({ari_sql('clean')})")} AS avg_ari,
       {r6(f"avg(({words_sql('text')} + {sents_sql('text')} * {words_sql('text')}) / {sents_sql('text')})")} AS avg_eflaw
FROM c GROUP BY role""")
def q_conv_readability(spark: SparkSession, sf: str) -> DataFrame:
    """S14-S18 on conversation turns, averaged per role."""
    c = X.clean_text(read_table(spark, sf, "conversations").select("role", "text"), "text", "clean")
    return c.groupBy("role").agg(F.count(F.lit(1)).alias("n"),
                                 C.round6(F.avg(X.ari("clean"))).alias("avg_ari"),
                                 C.round6(F.avg(X.eflaw("text"))).alias("avg_eflaw"))


_TWO_PI = "(2 * pi())"


def _w(fn: str, x: str, p: int) -> str:
    return r6(f"{fn}({_TWO_PI} * CAST({x} AS DOUBLE) / {p})")


@query("q_yearly", sql=f"""
WITH d AS (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS BIGINT) AS dn FROM orders),
p AS (SELECT o_orderkey, ((dn % 365) + 365) % 365 AS dayofyear, ((dn % 7) + 7) % 7 AS dayofweek FROM d),
q AS (SELECT *, CAST(floor(dayofyear / 31) AS BIGINT) AS month FROM p)
SELECT o_orderkey, dayofyear, dayofweek, month,
       {_w('sin', 'dayofweek', 7)} AS sin_dayofweek, {_w('cos', 'dayofweek', 7)} AS cos_dayofweek,
       {_w('sin', 'dayofyear', 365)} AS sin_day, {_w('cos', 'dayofyear', 365)} AS cos_day,
       {_w('sin', 'month', 12)} AS sin_month, {_w('cos', 'month', 12)} AS cos_month
FROM q""")
def q_yearly(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly cycle features of the order date (day number since epoch)."""
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    f = TF.yearly_features(o, "o_orderdate")
    waves = ["sin_dayofweek", "cos_dayofweek", "sin_day", "cos_day", "sin_month", "cos_month"]
    return f.select("o_orderkey", F.col("dayofyear").cast("bigint").alias("dayofyear"),
                    F.col("dayofweek").cast("bigint").alias("dayofweek"), "month",
                    *[C.round6(w).alias(w) for w in waves])


@query("q_daily", sql=f"""
WITH t AS (SELECT event_id, CAST(hour(ts) AS BIGINT) AS hour, CAST(minute(ts) AS BIGINT) AS minute,
                  CAST(second(ts) AS BIGINT) AS seconds FROM events)
SELECT event_id, hour, minute, seconds,
       {_w('sin', 'hour', 24)} AS hour_sin, {_w('cos', 'hour', 24)} AS hour_cos,
       {_w('sin', 'minute', 60)} AS minute_sin, {_w('cos', 'minute', 60)} AS minute_cos,
       {_w('sin', 'seconds', 60)} AS seconds_sin, {_w('cos', 'seconds', 60)} AS seconds_cos
FROM t""")
def q_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Daily cycle features of event timestamps (with seconds)."""
    e = read_table(spark, sf, "events").select("event_id", "ts")
    f = TF.daily_features(e, "ts", seconds=True)
    waves = ["hour_sin", "hour_cos", "minute_sin", "minute_cos", "seconds_sin", "seconds_cos"]
    return f.select("event_id", *[F.col(c).cast("bigint").alias(c) for c in ("hour", "minute", "seconds")],
                    *[C.round6(w).alias(w) for w in waves])


@query("q_parse_time", sql="""
WITH t AS (SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 'not a date' ELSE strftime(ts, '%d/%m/%Y %H:%M:%S') END AS said FROM events),
p AS (SELECT event_id, try_strptime(said, '%d/%m/%Y %H:%M:%S') AS ts FROM t),
d AS (SELECT event_id, ts, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS d FROM p)
SELECT event_id, CAST(hour(ts) AS BIGINT) AS hour, CAST(minute(ts) AS BIGINT) AS minute, CAST(d % 365 AS BIGINT) AS dayofyear,
  CAST(d % 7 AS BIGINT) AS dayofweek, CAST((d % 365) // 31 AS BIGINT) AS month FROM d""")
def q_parse_time(spark: SparkSession, sf: str) -> DataFrame:
    """S21 with S19 and S20: dates written as text, parsed by a strftime pattern; what is no date gives nulls."""
    e = read_table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 13 == 0, F.lit("not a date"))
                                               .otherwise(F.date_format("ts", "dd/MM/yyyy HH:mm:ss")).alias("said"))
    pattern = "%d/%m/%Y %H:%M:%S"
    both = TF.yearly_features(TF.daily_features(e, "said", time_format=pattern), "said", date_format=pattern)
    return both.select("event_id", *[F.col(c).cast("bigint").alias(c) for c in ("hour", "minute", "dayofyear", "dayofweek", "month")])


@query("q_page_readability", sql=f"""
WITH b AS (SELECT page_id, {_re('html', X.TAG_RE, '')} AS body FROM pages),
c AS (SELECT page_id, body, {clean_sql('body')} AS clean FROM b)
SELECT page_id, CAST(length(clean) AS BIGINT) AS clean_chars, {r6(ari_sql('clean'))} AS ari,
       {r6(f"({words_sql('body')} + {sents_sql('body')} * {words_sql('body')}) / {sents_sql('body')}")} AS eflaw
FROM c""")
def q_page_readability(spark: SparkSession, sf: str) -> DataFrame:
    """S14-S16 on raw web pages: tags stripped, cleaned text scored per page."""
    p = read_table(spark, sf, "pages").select("page_id", X.strip_tags("html").alias("body"))
    c = X.clean_text(p, "body", "clean")
    return c.select("page_id", F.length("clean").cast("bigint").alias("clean_chars"),
                    C.round6(X.ari("clean")).alias("ari"), C.round6(X.eflaw("body")).alias("eflaw"))
