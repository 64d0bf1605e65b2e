"""Sharding, WARC archives, line spread and top-k search against plain Python, with odd inputs."""

import gzip
import hashlib
import zlib
from base64 import b32encode

import duckdb
import numpy as np
import pytest
from corpus_helpers import COLUMNS, doc_rows, prose  # noqa: F401
from pyspark.sql import functions as F
from tabfold.llm import line_dedup, sharding, topk, warc
from tabfold.llm.queries import OP5_SQL, OP6_SQL

ODD = [None, "", "x", "é" * 100, "line\r\nline\n\n line \nend", "WARC/1.1\r\nContent-Length: 5\r\n\r\n", "a" * 50_000]


def test_shards_are_near_equal_and_slots_gapless(spark, prose):
    texts = ODD + [prose(k, 3 + k % 90) for k in range(3000)] + ["a third of all rows"] * 1600
    df = spark.createDataFrame([(*r, 5, "x") for r in doc_rows(texts)], COLUMNS + ", shard int, at string")
    got = sharding.shard_documents(df, 8).collect()
    assert len(got) == len(texts)
    for r in got:
        b = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(b) + 1, zlib.crc32(b), "bytes", None)
    sums = [sum(r.size for r in got if r.shard == s) for s in range(8)]
    # the ideal lies within the tolerance, or within the largest row, which cannot be cut
    assert max(sums) - min(sums) <= 2 * max(50_001, sum(sums) / 8 * 0.001)
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_sharding_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE_ROWS", 50)
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % 700).cast("string")).alias("text"))
    got = sharding.shard_documents(df, 8).toPandas()
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    sums = got.groupby("shard")["size"].sum()
    assert len(sums) == 8 and sums.max() - sums.min() <= 0.004 * sums.mean() + 10


def test_sharding_repeated_rows_and_nothing(spark):
    rows = [(1, "same")] * 40 + [(None, None)] * 3
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    assert len(got) == 43 and all(r.slot >= 0 and 0 <= r.shard < 8 for r in got)
    assert sharding.shard_documents(spark.createDataFrame([], "doc_id long, text string"), 8).count() == 0


def test_splitters_meet_exact_bytes(spark):
    keyed = spark.range(10_000).select((F.col("id") * 461168601842).alias("at"), (F.col("id") % 7 + 1).alias("size"))
    total = keyed.agg(F.sum("size")).first()[0]
    want = [total // 5 * k for k in range(1, 5)]
    for (key, below, rows), t in zip(sharding.find_splitters(keyed, [(w, 3) for w in want]), want):
        exact = keyed.where(F.col("at") < key).agg(F.sum("size"), F.count("*")).first()
        assert (below, rows) == tuple(exact) and abs(below - t) <= 8


PAGES = "page_id long, url string, html string, extra int, payload string, record_type string"


@pytest.fixture(scope="module")
def pages(spark):
    texts = ODD + ["dup"] * 9 + [f"<p>{k}</p>" for k in range(40)] + [None, ""]
    rows = [(i, None if i % 5 == 0 else f"http://s/{i}\r\nX: y", t, 1, "p", "r") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, PAGES)


def test_archives(spark, pages, tmp_path):
    got = sorted(tuple(r)[:5] for r in warc.deduplicated_archives(pages, str(tmp_path / "w")).collect())
    con = duckdb.connect()
    frame = pages.select("page_id", "url", "html").toPandas()
    con.register("pages", frame)
    assert got == sorted(con.execute(OP5_SQL).fetchall())
    files = list((tmp_path / "w").glob("part-*"))
    heads = [h for f in files for h, _ in warc.parse_archive(f.read_bytes())]
    assert len(heads) == len(got) and len({h["warc-record-id"] for h in heads}) == len(heads)
    assert all("warc-refers-to" in h for h in heads if h["warc-type"] == "revisit")


def test_small_payloads_are_responses(spark, pages):
    got = warc.deduplicated_archives(pages, min_bytes=4).collect()
    assert all(r.record_type == "response" for r in got if r.payload_bytes < 4)


def test_repeated_and_null_pages_and_none(spark):
    df = spark.createDataFrame([(3, "u", "a"), (3, "u", "a"), (1, "u", "a"), (None, None, "a"), (None, "u", "b")], "page_id long, url string, html string")
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in warc.deduplicated_archives(df).collect()), key=str)
    assert got == sorted([(3, "response", None), (3, "response", None), (1, "revisit", 3), (None, "revisit", 3), (None, "response", None)], key=str)
    assert warc.deduplicated_archives(df.where("false")).count() == 0


def test_reader_takes_member_per_record():
    def rec(body):
        return b"WARC/1.0\r\nContent-Length: %d\r\n\r\n%b\r\n\r\n" % (len(body), body)
    bodies = [b"", b"a\r\n\r\nWARC/1.0\r\n", b"x" * 1000]
    for data in (b"".join(map(rec, bodies)), b"".join(gzip.compress(rec(b)) for b in bodies)):
        assert [b for _, b in warc.parse_archive(data)] == bodies


def test_base32(spark):
    for t in ("", "abc", "é"):
        got = spark.range(1).select(warc.base32_sha1(F.encode(F.lit(t), "UTF-8"))).first()[0]
        assert got == b32encode(hashlib.sha1(t.encode()).digest()).decode()


@pytest.mark.parametrize("near", [(0.75, 1.5), (0.0, 100.0), (0.99, 1.01)])
def test_line_spread(spark, prose, monkeypatch, near):
    monkeypatch.setattr(line_dedup, "NEAR", near)
    common, rare = "All rights reserved here.", "On few sites only."
    texts = list(ODD)
    for k in range(60):
        texts.append("\n".join([prose(k, 8), f"  {common}\t", prose(k + 500, 5)] + ([rare] if k % 20 < 9 else []) + ([common] if k == 7 else [])))
    texts += [common, common + "\n" + common, "\n".join(f"l{k}" for k in range(3000))]
    df = spark.createDataFrame([(*r, "c") for r in doc_rows(texts, [f"s{k}" for k in range(20)])], COLUMNS + ", clean string")
    cleaned = line_dedup.without_boilerplate(df).select("row.doc_id", "n_lines", "n_removed", F.octet_length("clean").cast("long"), F.sha2("clean", 256))
    con = duckdb.connect()
    frame = df.select("doc_id", "text", "source").toPandas()
    con.register("documents", frame)
    got = sorted(map(tuple, cleaned.collect()))
    assert got == sorted(con.execute(OP6_SQL).fetchall())
    assert sum(r[2] for r in got) == 60 + 1 + 1 + 2 - 1
    line_dedup_empty = line_dedup.without_boilerplate(df.where("false"))
    assert line_dedup_empty.count() == 0


def test_line_spread_null_sites_and_repeated_rows(spark):
    rows = [(1, "x\ny", f"s{k}") for k in range(12)] + [(None, "x", "s1"), (5, "x", None)]
    got = line_dedup.without_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    out = sorted(((r["row"]["doc_id"], r.clean) for r in got.collect()), key=str)
    # the null id comes first, so it keeps "x"; the rows of id 1 are one document and keep "y"
    assert out == sorted([(1, "y")] * 12 + [(None, "x"), (5, "")], key=str)


def brute_top(ids, vectors, k):
    out = []
    ok = [i for i, v in enumerate(vectors) if v and all(x is not None and np.isfinite(x) for x in v)]
    ints = {i: [int(np.floor(np.float64(x) * 256)) for x in vectors[i]] for i in ok}
    for q in ok:
        if ids[q] is None or ids[q] % 50:
            continue
        cand = [(-sum(a * b for a, b in zip(ints[q], ints[i])), ids[i]) for i in ok if ids[i] not in (None, ids[q]) and len(ints[i]) == len(ints[q])]
        out += [(ids[q], r + 1, i, -s) for r, (s, i) in enumerate(sorted(cand)[:k])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(2048, 4096), (3, 40)])
def test_top_k(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(topk, "ROW_BLOCK", blocks[1])
    rng = np.random.default_rng(4)
    vectors = [list(map(float, v)) for v in rng.normal(size=(600, 12)).astype("float32")]
    for k in range(100, 140):
        vectors[k] = vectors[100]                      # ties
    vectors[7], vectors[8], vectors[9], vectors[50] = None, [], [float("nan")] * 12, [None] * 12
    vectors[11], vectors[300] = [float("inf")] + [1.0] * 11, [1.0, 2.0]
    ids = list(range(600))
    df = spark.createDataFrame([(i, v, 1, "v") for i, v in zip(ids, vectors)], "vec_id long, embedding array<float>, score int, v string")
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, 5)
    assert sorted(map(tuple, got.drop("depth").collect())) == brute_top(ids, vectors, 5)
    assert topk.top_k(df.where("false"), F.col("vec_id") % 50 == 0, 5).count() == 0
    assert topk.top_k(df.unionByName(df), F.col("vec_id") % 50 == 0, 5).count() == got.count()


def test_top_k_of_few_and_large(spark):
    df = spark.createDataFrame([(0, [1e6, -1e6]), (1, [1e6, 1.0]), (2, [0.0, -1e6])], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 50 == 0, 5).drop("depth").collect()))
    assert got == brute_top([0, 1, 2], [[1e6, -1e6], [1e6, 1.0], [0.0, -1e6]], 5)


def test_bounds_never_lose_a_row():
    rng = np.random.default_rng(1)
    for spread in (1, 50):
        x = np.floor(rng.normal(size=(900, 16)) * np.array([spread] + [1] * 15) * 256).astype("int64")
        ids = np.arange(900)
        got = sorted(r[:3] for r in topk.nra_block(ids[:20], x[:20], ids, x, 5))
        want = sorted((q, int(i), int(x[q] @ x[i])) for q in range(20) for i in sorted((j for j in ids if j != q), key=lambda j: (-(x[q] @ x[j]), j))[:5])
        assert got == want


def test_null_ids_take_no_part_in_top_k(spark):
    df = spark.createDataFrame([(None, [9.0, 9.0]), (0, [1.0, 1.0]), (50, [2.0, 1.0]), (3, [3.0, 3.0])], "vec_id long, embedding array<double>")
    got = sorted(tuple(r)[:4] for r in topk.top_k(df, F.col("vec_id") % 50 == 0, 5).collect())
    assert got == brute_top([None, 0, 50, 3], [[9.0, 9.0], [1.0, 1.0], [2.0, 1.0], [3.0, 3.0]], 5)


def test_bounds_stop_the_reading(spark):
    """At least 95 of 100 queries are served by their bounds; the scores are those of all pairs."""
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = topk.top_k(vectors, F.col("vec_id") % 50 == 0, 5)
    by_query = got.groupBy("query_id").agg(F.max("depth").alias("d")).collect()
    assert len(by_query) >= 10 and sum(r["d"] < 1 for r in by_query) >= 0.95 * len(by_query)
    rng = np.random.default_rng(3)
    x = np.floor(256 * rng.normal(size=(3000, 64))).astype("int64")
    ids = rng.permutation(3000)
    out = topk.nra_block(ids[:300], x[:300], ids, x, 5)
    assert len(out) == 1500 and sum(d < 1 for *_, d in out) >= 0.95 * len(out)
    best = [sorted(((-int(x[i] @ x[j]), int(ids[j])) for j in range(3000) if j != i))[:5] for i in range(0, 300, 10)]
    mine = {}
    for q, v, s, _ in out:
        mine.setdefault(q, []).append((-s, v))
    assert [sorted(mine[int(ids[i])]) for i in range(0, 300, 10)] == best
