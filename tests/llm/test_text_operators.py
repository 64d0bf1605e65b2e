"""Quality rules, byte-level BPE and packing against plain Python, with odd inputs."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from corpus_helpers import COLUMNS, doc_rows, prose  # noqa: F401
from tabfold.llm import byte_bpe, cutting_stock, packing, quality

BPE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " \t\n\x0b\x0c\r", "one", "naïve café  x y\x1cz", "Σας ΟΔΟΣ  İstanbul é ́x",
       "don't I'll we've 'S ''s", "a" * 5000, "ab " * 4000, "x\n\n  y\n   \tz\n" * 50, "<|endoftext|> <|startoftext|>",
       "日本語テキスト 한국어 ١٢٣ 🙂🙃", " leading", "trailing \n", "x" + " " * 3000 + "y", "1234 5678" * 10]


def base_measures(t):
    t = t or ""
    w = WORD.findall(t)
    c = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    cover = {j for k in range(len(w) - 4) if c[tuple(w[k:k + 5])] > 1 for j in range(k, k + 5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(t.count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover),
            len(w) < 10 or 100 * len(cover) > 20 * len(w))


def test_quality_base_and_bands(spark, prose):
    import random
    noise = "".join(random.Random(3).choices([chr(c) for c in range(0x100, 0x2000)], k=4000))
    good = [prose(k, n) for k, n in ((1, 60), (2, 400), (3, 3000))]
    long_loop = prose(5, 4000) + " " + "spam ham eggs " * 4000
    texts = ODD + good + ["buy now " * 3000, " ".join(noise[i:i + 9] for i in range(0, 4000, 9)), long_loop, good[0], good[0]]
    df = spark.createDataFrame([(*r, 1, "q") for r in doc_rows(texts)], COLUMNS + ", kept int, quality string")
    rows = {r["row"]["doc_id"]: r["quality"] for r in quality.compression_quality(df).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        q = rows[i]
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words, q.base_failed) == base_measures(t), i
    at = len(ODD)
    assert all(rows[at + k].kept for k in range(3))
    assert rows[at + 3].verdict == "repetitive" and rows[at + 4].verdict == "incompressible"
    assert rows[at + 5].verdict != "ok" and not rows[at + 5].kept
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i in rows if rows[i].kept}


def test_quality_limits_come_from_the_table(spark, prose):
    """Repeats that the base rules and the fixed limits let pass; copies do not move the limits."""
    good = [prose(k, 350 + k) for k in range(120)]
    loose = []
    for k in range(5):                               # every phrase returns with another word in it
        part = prose(500 + k, 200).split()
        loose.append(" ".join(w if j % 4 else f"{w}{'abcdefg'[r]}" for r in range(2) for j, w in enumerate(part)))
    texts = good + loose + [good[0]] * 300
    df = spark.createDataFrame(doc_rows(texts), COLUMNS)
    rows = {r["row"]["doc_id"]: r["quality"] for r in quality.compression_quality(df).collect()}
    assert not any(rows[i].base_failed for i in rows)
    assert sum(rows[i].kept for i in range(120)) >= 117 and all(rows[i].kept for i in range(125, 425))
    assert [rows[i].verdict for i in range(120, 125)] == ["repetitive"] * 5
    assert all(quality.in_band(len(t), len(t) / rows[120 + k].ratio, quality.FIXED) == 0 for k, t in enumerate(loose))
    chunked = quality.limits_from({quality.WHOLE_CHUNKS: {2100 + k: 1 for k in range(100)}})
    assert chunked[:-1] == quality.FIXED[:-1] and 1.9 < chunked[-1][0] < 2.1 < 2.2 < chunked[-1][1] < 2.4


def test_quality_of_an_empty_table(spark):
    df = spark.createDataFrame([], COLUMNS)
    assert quality.compression_quality(df).count() == 0 and quality.keep_good(df).columns == df.columns


@pytest.fixture(scope="module")
def whole():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_round_trip(spark, whole, prose):
    texts = ODD + [prose(9, 40_000), "word" * 60_000 + " \n " + "z" * 70_000]
    df = spark.createDataFrame([(*r, "clash") for r in doc_rows(texts)], COLUMNS + ", ids string")
    got = {r.doc_id: r for r in byte_bpe.round_trip(df, "doc_id", RANKS, public_tokenizers.PATTERN).collect()}
    for i, t in enumerate(texts):
        ids = np.array(whole.encode_ordinary(t or ""), "<u4")
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest()), i
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    coded = byte_bpe.encode_texts(df, "doc_id", RANKS, public_tokenizers.PATTERN)
    back = {r.doc_id: bytes(r.bytes) for r in byte_bpe.decode_ids(coded, "doc_id", RANKS, public_tokenizers.PATTERN).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(texts)}
    assert byte_bpe.round_trip(df.where("false"), "doc_id", RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_safe_pieces_keep_the_ids(whole, size):
    for t in ODD:
        t = (t or "")[:600]
        assert "".join(byte_bpe.safe_pieces(t, size)) == t
        assert [i for p in byte_bpe.safe_pieces(t, size) for i in whole.encode_ordinary(p)] == whole.encode_ordinary(t)


def test_tokens_by_word_are_those_of_the_whole_text():
    ids = packing.WordIds(BPE)
    for t in ODD:
        want = packing.tokenizer(BPE).encode(t or "", add_special_tokens=False).ids + [packing.END_ID]
        assert np.frombuffer(ids((t or "").encode()), "<u4").tolist() == want, t


def test_tokens_of_a_batch_are_those_of_its_texts():
    ids = packing.WordIds(BPE)
    spaces = ["a\x1cb\x85c\u2028d\xa0e", "\v\fDon't\r\n  Été's 12\t", "İ ı ŉ", "漢字 plain 漢字", " \n\t", "x" * 5000]
    texts = [(t or "").encode() for t in ODD + spaces]
    for part in (texts, texts[:1], [b"", b" "], [], texts * 3):
        got = [np.frombuffer(b, "<u4").tolist() for b in ids.batch(part)]
        assert got == [packing.tokenizer(BPE).encode(t.decode(), add_special_tokens=False).ids + [packing.END_ID] for t in part]


def test_a_worker_encodes_a_batch_in_slices(monkeypatch):
    ids, sizes, whole = packing.WordIds(BPE), [], packing.WordIds.batch
    texts = [(t or "").encode() for t in ODD] * 3
    want = ids.batch(texts)

    def noted(self, part):
        sizes.append((len(part), sum(map(len, part))))
        return whole(self, part)
    monkeypatch.setattr(packing.WordIds, "batch", noted)
    for most in (0, 1, 500, 1 << 20):
        sizes.clear()
        assert list(ids.each(iter(texts), most)) == want
        assert all(n == 1 or size <= most for n, size in sizes) and sum(n for n, _ in sizes) == len(texts)
    assert list(ids.each([])) == []


def test_bytes_that_are_no_utf8_end_at_white_space():
    ids = packing.WordIds(BPE)
    texts = [b"a\xff b", b"\xe2\x80 \xa6", b"plain words"]
    for t, got in zip(texts, ids.batch(texts)):
        want = packing.tokenizer(BPE).encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids + [packing.END_ID]
        assert np.frombuffer(got, "<u4").tolist() == want


def test_compression_ratios_are_taken_once(spark, prose):
    texts = [None, "", prose(1, 60), prose(1, 60), prose(2, 4000)]
    bins = quality.ratio_bins(spark.createDataFrame(doc_rows(texts), COLUMNS))
    assert bins._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [") == 1
    whole = sum(quality.class_of(len(t.encode())) is not None for t in texts[3:])      # an empty text has no ratio, a copy counts once
    rows = bins.collect()
    assert sum(r[2] for r in rows if r[0] != quality.WHOLE_CHUNKS) == whole == 2
    assert sum(r[2] for r in rows if r[0] == quality.WHOLE_CHUNKS) == len(texts[4].encode()) // quality.CHUNK


def test_a_batch_splits_each_distinct_word_once(prose):
    ids, seen = packing.WordIds(BPE), []
    ids.pieces = type("Seen", (packing.Remembered,), {"__getitem__": lambda self, k: seen.append(k) or super(type(self), self).__getitem__(k)})(ids._piece, 1000)
    texts = [prose(k, 40).encode() for k in range(5)] * 100
    got = ids.batch(texts)
    words = {w for t in texts for w in t.split()}
    assert len(seen) <= 8 * len(words) < sum(len(t.split()) for t in texts)      # not once a place
    assert got[:5] * 100 == got == [packing.WordIds(BPE)(t) for t in texts[:5]] * 100


def check_pieces(rows, texts, capacity):
    want = {i: np.array(packing.tokenizer(BPE).encode(t or "", add_special_tokens=False).ids + [2], "<u4") for i, t in enumerate(texts)}
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
        x = want[r.doc_id][r.start:r.start + r.length]
        assert r.length > 0 and len(x) == r.length and r.doc_tokens == len(want[r.doc_id]) and r.ids_crc32 == zlib.crc32(x.tobytes())
    assert set(by_doc) == set(want)
    for i, ps in by_doc.items():
        ps.sort(key=lambda r: r.start)
        assert [p.start for p in ps] == np.cumsum([0] + [p.length for p in ps])[:-1].tolist() and sum(p.length for p in ps) == len(want[i])
    for ps in by_seq.values():
        ps.sort(key=lambda r: r.offset)
        assert [p.offset for p in ps] == np.cumsum([0] + [p.length for p in ps])[:-1].tolist() and sum(p.length for p in ps) <= capacity
    return sum(capacity - sum(p.length for p in ps) for ps in by_seq.values()), sum(map(len, want.values()))


@pytest.mark.parametrize("capacity", [64, 512])
def test_packing(spark, prose, capacity):
    texts = ODD + [prose(k, 5 + 13 * (k % 29)) for k in range(250)] + ["same words here"] * 200
    df = spark.createDataFrame([(*r, 0, 0, "s") for r in doc_rows(texts)], COLUMNS + ", class int, n int, sequence_id string")
    waste, total = check_pieces(packing.pack(df, BPE, capacity=capacity, grain=2).collect(), texts, capacity)
    assert waste <= 0.03 * total + capacity


def test_packing_repeated_rows_nulls_and_nothing(spark):
    rows = [(1, "a b c"), (1, "a b c"), (1, "d"), (None, "e f"), (2, None)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), BPE, capacity=16, grain=2).collect()
    assert sorted(sum(r.length for r in got if r.doc_id == d) for d in (1, 2, None)) == [1, 3, 10]
    spans = sorted((r.sequence_id, r.offset, r.offset + r.length) for r in got)
    assert all(b[0] > a[0] or b[1] == a[2] for a, b in zip(spans, spans[1:]))
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), BPE).count() == 0


@pytest.mark.parametrize("histogram", [{}, {1: 1}, {40: 1000}, {33: 10_000, 20: 5}, {63: 50, 1: 3}, {k: k * 7 % 50 for k in range(1, 64) if k * 7 % 50}])
def test_cutting_plan_uses_each_document_once(histogram):
    plan, shred = cutting_stock.cutting_plan(histogram, 64)
    for units, n in histogram.items():
        assert sum(copies * items.get(units, 0) for copies, items, _ in plan) + shred.get(units, 0) == n
    assert all(sum(u * k for u, k in items.items()) + fill <= 64 for _, items, fill in plan)
    total = sum(u * n for u, n in histogram.items())
    sequences = sum(copies for copies, _, _ in plan)
    spare = sum(copies * fill for copies, _, fill in plan)
    cut = sum(u * n for u, n in shred.items())
    assert sequences + max(0, -(-(cut - spare) // 64)) <= 1.03 * total / 64 + 2
