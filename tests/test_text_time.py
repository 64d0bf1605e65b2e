import math
import re

import pytest

from conftest import SF01
from tabfold.functions import text as X
from tabfold.functions import timefeat as TF
from tabfold.sources.tables import read_table

STOP = set(X.ENGLISH_STOPWORDS)


def py_clean(t: str) -> str:
    """Reference semantics in plain Python (without emoji/mojibake helpers)."""
    t = t.lower()
    t = re.sub(r"<[^>]+>", "", t)
    t = re.sub(r"http\w+", "", t)
    t = re.sub(r"@\w+", "", t)
    t = re.sub(r"\s[a-z]\s", " ", t)
    t = re.sub(r"\s\s+", " ", t)
    t = " ".join(w for w in t.split(" ") if w not in STOP)
    return t.strip()


def py_counts(t):
    return len(re.split(r"[ \n.?!,]", t)), len(re.split(r"[.?!]", t))


CASES = ["<b>Hello</b> World", "see https://x.org now", "see http://x.org now", "hi @user_1 there",
         " a b c ", "two  spaces\tand\ttab", "", "Ünïcödé  À la carte", "the cat is on the mat",
         "a  b", "trailing space  \n"]


def test_clean_text_fixtures(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "id int, text string")
    got = {r.id: r.clean for r in X.clean_text(df, "text").collect()}
    for i, t in enumerate(CASES):
        assert got[i] == py_clean(t), (t, got[i], py_clean(t))


def test_clean_text_whole_documents_match_python(spark):
    d = read_table(spark, SF01, "documents").select("doc_id", "text")
    got = {r.doc_id: (r.clean, r.text) for r in X.clean_text(d, "text").collect()}
    bad = [k for k, (c, t) in got.items() if c != py_clean(t)]
    assert not bad, bad[:5]


def test_expression_form_equals_stage_form(spark):
    d = read_table(spark, SF01, "documents").select("doc_id", "text")
    a = X.clean_text(d, "text").select("doc_id", "clean")
    b = d.select("doc_id", X.clean_text_expr("text").alias("clean"))
    assert a.exceptAll(b).count() == 0


def test_readability_matches_python(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "id int, text string")
    rows = X.readability(df, "text").collect()
    for r in rows:
        c = py_clean(r.text)
        w, s = py_counts(c)
        assert r.ari == pytest.approx(4.71 * len(c) / w + 0.5 * w / s - 21.43)
        W_, S_ = py_counts(r.text)
        assert r.eflaw == pytest.approx((W_ + S_ * W_) / S_)
        assert r.clri == pytest.approx(0.0588 * 100 * len(r.text) / W_ - 0.296 * 100 * S_ / W_ - 15.8)


def test_yearly_features_pmod(spark):
    df = spark.createDataFrame([(d,) for d in (0, 6, 7, 364, 365, -5)], "d int")
    out = {r.d: r for r in TF.yearly_features(df, "d").collect()}
    for d, r in out.items():
        assert r.dayofyear == d % 365 and r.dayofweek == d % 7 and r.month == (d % 365) // 31
        assert r.sin_day == pytest.approx(math.sin(2 * math.pi * (d % 365) / 365))


def test_daily_features(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 30, 15),)], "ts timestamp")
    r = TF.daily_features(df, "ts", seconds=True).first()
    assert (r.hour, r.minute, r.seconds) == (10, 30, 15)
    assert r.hour_sin == pytest.approx(math.sin(2 * math.pi * 10 / 24))
    assert {"seconds_sin", "seconds_cos"} <= set(r.asDict())


def test_time_format_parse(spark):
    df = spark.createDataFrame([("2024-01-01 10:30",)], "t string")
    r = TF.daily_features(df, "t", time_format="%Y-%m-%d %H:%M").first()
    assert (r.hour, r.minute) == (10, 30)
    assert TF.java_pattern("%Y-%m-%d") == "yyyy-MM-dd"
