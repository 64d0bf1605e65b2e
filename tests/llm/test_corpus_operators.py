"""Personal data, repeated strings, near-duplicates and the pipeline against plain Python, with odd inputs."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus_helpers import COLUMNS, doc_rows, prose  # noqa: F401
from pyspark.sql import functions as F
from tabfold.llm import near_dup, personal, repeats, two_stage
from tabfold.llm.components import components

ODD = [None, "", " \t\n", "word", "a b c d", "é ü 日本 🙂 x", "z" * 3000, "ab" * 900]

# ---- repeated strings ------------------------------------------------------


def brute_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = True
        gone = gone[:len(d)]
        out.append((len(d), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()),
                    bytes(b for b, g in zip(d, gone) if not g)))
    return out


def repeat_texts(prose):
    passage, other = prose(70, 60), prose(71, 45)
    texts = list(ODD) + [prose(k, 20 + k) for k in range(30)]
    texts += [f"{prose(100 + k, 12)} {passage} {prose(200 + k, 9)}" for k in range(25)]
    texts += [f"{passage[40:300]}|{other}|{other}|x", other[:199], other[:200], other[1:201], "é" * 300, "\x00" * 450]
    return texts + [texts[40], texts[40], prose(300, 5000) + passage]


@pytest.mark.parametrize("limit", [8192, 3])
@pytest.mark.parametrize("part", [1 << 20, 700])
def test_repeats(spark, prose, monkeypatch, limit, part):
    texts = repeat_texts(prose)
    monkeypatch.setattr(repeats, "FILE_LIMIT", limit)
    df = spark.createDataFrame([(*r, 3, "b", "f") for r in doc_rows(texts)], COLUMNS + ", n_bytes int, body string, file string")
    if part != 1 << 20 and limit != 8192:
        pytest.skip("one at a time")
    first, count, file = repeats.segments(b"abcdefgh" * 200)
    assert first[0] == 0 and count.sum() == 1600 - 199 and len(file) == len(first)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.without_repeats(df).collect()}
    want = brute_repeats(texts, 200)
    assert len(got) == len(texts) and all(got[i] == want[i] for i in range(len(texts)))


def test_repeats_of_repeated_rows_and_nothing(spark, prose):
    long = prose(1, 100)
    df = spark.createDataFrame([(1, long), (1, long), (None, prose(2, 90)), (None, None)], "doc_id long, text string")
    got = sorted((r.n_bytes, r.n_removed) for r in repeats.without_repeats(df).collect())
    assert got == sorted([(len(long),) * 2, (len(long),) * 2, (len(prose(2, 90)), 0), (0, 0)])
    assert repeats.without_repeats(df.where("false")).count() == 0


def test_long_texts_are_cut_without_loss(prose):
    """Parts overlap so that every start lies in exactly one segment."""
    old, repeats.PART = repeats.PART, 700
    try:
        text = (prose(5, 900) + "y" * 900).encode()
        frame = next(repeats._segment_rows(iter([[text]])))
        starts = sorted((int(a), int(n)) for a, n in zip(frame["start"][0], frame["n"][0]))
    finally:
        repeats.PART = old
    assert [a for a, _ in starts] == np.cumsum([0] + [n for _, n in starts])[:-1].tolist()
    assert sum(n for _, n in starts) == len(text) - 199


@pytest.mark.parametrize("text", [b"", b"a", b"aaaaaaaaaaaaaaaa", b"banana bandana", bytes(range(256)) * 2, b"\x00\x00\xff\xff" * 20,
                                  b"mississippi" * 7, bytes(np.random.default_rng(0).integers(0, 3, 4000, dtype=np.uint8))])
def test_two_stage_order(text):
    for seed in range(3):
        wanted = np.random.default_rng(seed).random(len(text)) < (1.0, 0.5, 0.1)[seed]
        order = two_stage.sort_suffixes(text, wanted, len(text) + 1)
        assert set(np.flatnonzero(wanted)) <= set(order.tolist()) and len(set(order.tolist())) == len(order)
        keys = [text[i:] for i in order.tolist() if i < len(text)]
        assert keys == sorted(keys)


# ---- near-duplicates -------------------------------------------------------


def shingle_set(t):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(texts):
    sets = [shingle_set(t) for t in texts]
    group = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b) and group[i] != group[j]:
                lo, hi = sorted((group[i], group[j]))
                group = [lo if g == hi else g for g in group]
    return [len(s) for s in sets], group


def near_texts(prose):
    texts = list(ODD) + ["A b C d", "one two three four five", "ONE two three four FIVE"]
    for base in range(12):
        words = prose(base, 150 + 40 * base).split()
        for k in range(8):
            w = list(words)
            for e in range(k):                     # chains: each copy has one more edit than the one before
                w[(37 * (e + 1) + base) % len(w)] = f"edit{e}"
            texts.append(" ".join(w))
    return texts + [prose(900 + k, 60) for k in range(40)] + ["same text of some words again"] * 30


@pytest.mark.parametrize("blocks", [(2048, 1_000_000), (3, 700)])
def test_near_duplicates(spark, prose, monkeypatch, blocks):
    monkeypatch.setattr(near_dup, "BUCKET_BLOCK", blocks[0])
    monkeypatch.setattr(near_dup, "FAMILY_BLOCK", blocks[1])
    texts = near_texts(prose)
    df = spark.createDataFrame([(*r, 0, "c", 1) for r in doc_rows(texts)], COLUMNS + ", node int, component string, n int")
    got = {r.doc_id: r for r in near_dup.near_duplicates(df).collect()}
    sizes, group = brute_components(texts)
    assert [got[i].n_shingles for i in range(len(texts))] == sizes
    assert [got[i].component_id for i in range(len(texts))] == group
    assert all(got[i].kept == (group[i] == i) for i in got)
    one = near_dup.one_of_each(df)
    assert one.columns == df.columns and sorted(r.doc_id for r in one.collect()) == sorted(set(group))


def test_sets_of_families_are_made_once_a_task(spark):
    text = "one two three four five six seven"
    made = near_dup.shingles(text.encode(), near_dup.word_hashes()).tobytes()
    own = near_dup.xxhash.xxh3_128_digest(made)
    rows = [(1, own, 7, text.encode()), (1, own, 7, b"another text of the same id"), (1, own, 7, text.encode())]
    found = near_dup._bodies(spark.createDataFrame(rows, "node long, set_id binary, component long, text_bytes binary"))
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [") == 1
    assert [(r.node, r.component, r.body, r.n) for r in found.collect()] == [(1, 7, made, 3)]


def test_near_duplicates_repeated_rows_null_ids_and_nothing(spark, prose):
    t = prose(1, 50)
    df = spark.createDataFrame([(4, t), (4, t), (2, t), (None, t), (9, prose(2, 50)), (9, prose(3, 50))], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(4, 2, False)] * 2 + [(2, 2, True), (None, None, True), (9, 9, True), (9, 9, True)], key=str)
    assert near_dup.near_duplicates(df.where("false")).count() == 0


def test_pipeline_links_from_80_percent(spark, prose):
    """A pair between 0.80 and 0.85: two texts for the query, one for the pipeline's stage."""
    import corpus_pipeline
    texts = []
    for base in range(30):
        words = prose(3000 + base, 204).split()
        texts += [" ".join(words), " ".join(words[:50] + ["edita"] + words[51:100] + ["editb"] + words[101:150] + ["editc"] + words[151:-4] + words[-3:])]
        a, b = map(shingle_set, texts[-2:])
        assert 80 * len(a | b) <= 100 * len(a & b) < 85 * len(a | b)
    df = spark.createDataFrame(doc_rows(texts), COLUMNS)
    assert near_dup.one_of_each(df).count() == 60
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()) == list(range(0, 60, 2))


def test_bands_and_sketch_limit_follow_the_similarity():
    assert (near_dup.n_bands(85), near_dup.max_xor(85)) == (16, 72)
    assert (near_dup.n_bands(80), near_dup.max_xor(80)) == (22, 84)
    assert near_dup.n_bands(100) == 1 and near_dup.max_xor(100) == 0
    with pytest.raises(ValueError):
        near_dup.n_bands(60)


def test_odd_sketch_estimates():
    """Sketches of samples that differ in d places differ in about 2 d bits, less what meets."""
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, near_dup.SAMPLES, dtype=np.uint64)
    for d in (0, 8, 19, 40):
        b = a.copy()
        b[:d] = rng.integers(0, 2**63, d, dtype=np.uint64)
        x = np.frombuffer(near_dup.odd_sketch(a), np.uint64) ^ np.frombuffer(near_dup.odd_sketch(b), np.uint64)
        bits = int(np.bitwise_count(x).sum())
        assert abs(-near_dup.BITS / 4 * math.log(1 - 2 * bits / near_dup.BITS) - d) <= 4 + d / 4


def test_components(spark):
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(5, 5), (300, 200), (250, 300)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()))
    assert got == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 140)}, 200: 200, 250: 200, 300: 200}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


# ---- personal data ---------------------------------------------------------

BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def brute_spans(t):
    out = []
    for kind, pattern in BASE:
        for m in re.finditer(pattern, t or ""):
            d = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else False,
                    "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                out.append((kind, m.start(), m.end(), m.group().lower() if kind == "email" else (m.group() if kind == "ip" else d)))
    return out


def entropy_bits(s):
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values()) * len(s)


def is_secret(s):
    changes = len(re.findall("[0-9]+|[^0-9]+", s)) - 1
    return len(s) >= 16 and changes >= max(3, len(s) / 8) and entropy_bits(s) >= personal.SECRET_BITS


def brute_entities(texts):
    """By text: base spans, then secrets and numbers that the table's distinct texts leave informative."""
    spans = {t: [(k, a, b, v) for k, a, b, v in brute_spans(t)] for t in set(texts)}
    added, holds = defaultdict(list), defaultdict(set)
    for t, base in spans.items():
        found = [("secret", m.start(), m.end(), m.group()) for m in re.finditer(r"[A-Za-z0-9+/_=-]+", t) if is_secret(m.group())]
        for m in re.finditer(BASE[2][1], t):
            d = re.sub("[^0-9]", "", m.group())
            if not (13 <= len(d) <= 19 and luhn(d)) and re.search(personal.NUMBER, m.group()):
                found.append(("number", m.start(), m.end(), d))
        for s in found:
            if not any(s[1] < b and a < s[2] for _, a, b, _ in base):
                added[t].append(s)
                holds[s[0], s[3]].add(t)
    most = max(personal.SURELY, len(spans) ** (1 - personal.INFORMATION))
    return spans, {t: [s for s in ss if len(holds[s[0], s[3]]) <= most] for t, ss in added.items()}


def brute_terms(texts):
    """Terms that give values away, from all distinct texts."""
    texts = sorted({t or "" for t in texts})
    base, added = brute_entities(texts)
    terms = [{w for w in re.findall(r"[^\W\d_]+", re.sub(BASE[0][1], " ", t).lower()) if len(w) >= personal.MIN_LETTERS} for t in texts]
    near, holds = defaultdict(set), defaultdict(set)
    for i, t in enumerate(texts):
        for kind, a, b, value in [*base[t], *added.get(t, [])]:
            holds[kind, value].add(i)
            around = t[max(0, a - personal.CONTEXT):a] + " " + t[b:b + personal.CONTEXT]
            for w in re.findall(r"[^\W\d_]+", re.sub(BASE[0][1], " ", around).lower()):
                if len(w) >= personal.MIN_LETTERS:
                    near[kind, value, w].add(i)
    out = set()
    for (kind, value, w), docs in near.items():
        n_c, n_t = len(holds[kind, value]), max(len(docs), sum(w in s for s in terms)) + personal.UNSEEN
        if n_c < len(texts) and math.log2(len(texts) * len(docs) / (n_c * n_t)) >= personal.GENERALISE * math.log2(len(texts) / n_c):
            out.add(w)
    return out


def personal_texts(prose):
    tricky = ["a@b.c@d.e.f", "x.y@z", "a@b.c_d@e.f g@h.i", "@@a@b..c", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.001.2.3 1.2.3", "99999999999999999999.1.1.1",
              "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111", "378282246310005 7", "+1 (555) 123-4567.", "+1 2", "+123456789012345678",
              "é🙂 me@ex-ample.org, +44 20 7946 0958; 10.0.0.1", "a" * 3000 + "@", "1" * 3000, "1 " * 2000, "+1" + "(" * 3000, "<" * 50 + "q@w.er" + ">" * 50,
              "me@x.y\nme@x.y"]
    texts = list(ODD) + tricky + [prose(k, 30) for k in range(150)]
    # a name that stands beside one telephone number in different texts, and nowhere else
    texts += [f"{prose(500 + k, 20)} Zyxwvut Quorbel, +1 (555) 010-20{k % 1}7 {prose(600 + k, 20)}" for k in range(6)]
    texts += [f"{prose(700, 20)} Onecopy only@once.org {prose(701, 20)}"] * 5           # one text five times: one text
    key = "9f8e7d6c5b4a39281706f5e4d3c2b1a098765432"
    texts += [f"{prose(710, 20)} token = \"{key}\" {prose(711, 20)}", f"{prose(712, 9)} 9807915762804490 and 1234-5678 9012 {prose(713, 9)}",
              "2023 2024 2025 2026 1 2 3 4 5 6 7 8 9 10 11 12", "report-2024-01-15-final-version some/path/to/file_name_12.txt",
              "aaaaaaaaaaaaaaaaaaaa1b1b1b1b", "4000-1234-5678-9010 4000 1234 5678 9017", f"x@{key}.org 5105105105105100 " + "0" * 40]
    texts += [f"{prose(720 + k, 8)} notice 77b5c3d1e9f0a2b4c6d8e0f1 {prose(750 + k, 8)}" for k in range(70)]       # in too many texts
    return texts


def test_personal(spark, prose):
    texts = personal_texts(prose)
    df = spark.createDataFrame([(*r, 0, "s", "v") for r in doc_rows(texts)], COLUMNS + ", kind int, spans string, value string")
    got = {r.doc_id: r for r in personal.find_personal(df).collect()}
    found = brute_terms(texts)
    assert {"zyxwvut", "quorbel"} <= found and "onecopy" not in found
    _, added = brute_entities([t or "" for t in texts])
    assert sum(map(len, added.values())) >= 4 and not any("77b5" in s[3] for ss in added.values() for s in ss)
    for i, t in enumerate(texts):
        base, more = brute_spans(t), added.get(t or "", [])
        told = ",".join(f"{k}:{a}:{b}" for k, a, b, _ in base)
        assert got[i].base_sha256 == hashlib.sha256(told.encode()).hexdigest(), (t, told, got[i])
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(s[0] == k for s in base) for k, _ in BASE]
        extra = [f"term:{m.start()}:{m.end()}" for m in re.finditer(r"[^\W\d_]+", t or "") if m.group().lower() in found
                 and not any(m.start() < b and a < m.end() for _, a, b, _ in [*base, *more])]
        assert got[i].spans == ",".join([told] * bool(told) + extra + [f"{k}:{a}:{b}" for k, a, b, _ in more]), t
        assert got[i].n_spans == len(base) + len(extra) + len(more)
    clean = {r["row"]["doc_id"]: r.clean for r in personal.sanitise(df).collect()}
    assert len(clean) == len(texts)
    for i, t in enumerate(texts):
        assert "Quorbel" not in clean[i] and not [s for s in brute_spans(clean[i]) if s[0] == "email"]
        if not got[i].spans:
            assert clean[i] == (t or "")
    at = next(i for i, t in enumerate(texts) if t and "Quorbel" in t)
    assert "<PHONE>" in clean[at] and "token = \"<SECRET>\"" in clean[next(i for i, t in enumerate(texts) if t and "token" in t)]
    assert not any("9807915762804490" in c for c in clean.values())


def test_personal_terms_beside_values_of_one_or_two_texts(spark, prose):
    """Names beside values that occur once or twice; the same in a copied text; a word seen elsewhere, too, gives nothing away."""
    texts = [prose(k, 12) for k in range(1100)] + [f"Common {prose(2000 + k, 12)}" for k in range(5)]
    texts += [f"{prose(3000, 12)} Vexworth Common, vex@one.org {prose(3001, 12)}"]
    texts += [f"{prose(3010 + k, 12)} Plimsy, plim@two.org {prose(3020 + k, 12)}" for k in range(2)]
    texts += [f"{prose(3030, 12)} Qarrow, qar@copied.org {prose(3031, 12)}"] * 4
    df = spark.createDataFrame(doc_rows(texts), COLUMNS)
    clean = {r["row"]["doc_id"]: r.clean for r in personal.sanitise(df).collect()}
    for i, t in enumerate(texts):
        want = t
        for x in ("Vexworth", "Plimsy", "Qarrow"):
            want = want.replace(x, "<TERM>")
        for x in ("vex@one.org", "plim@two.org", "qar@copied.org"):
            want = want.replace(x, "<EMAIL>")
        assert clean[i] == want


def test_personal_terms_whose_letters_are_also_cut_pieces(spark, prose):
    """Runs and addresses cut by the window's edge are no occurrences of a term, nor of a longer word's piece."""
    texts = [f"{prose(k, 30)}" for k in range(200)]
    texts += [f"{prose(300 + k, 20)} Qlee, +1 (555) 010-2007 {prose(350 + k, 20)}" for k in range(4)]
    for k in range(20):
        fill = prose(400 + k, 40)
        texts.append(f"galumphqlee {fill[:59]} +1 (555) 030-{2000 + k} {fill[:61]} qleegalumph")       # 'qlee' begins 64 characters before
        texts.append(f"{prose(450 + k, 20)} m{k}@qlee.org {fill[:54]} +1 (555) 040-{2000 + k}")        # '@' is 65 characters before
        texts.append(f"+1 (555) 050-{2000 + k} {fill[:58]} qleex{k}y")                               # 'qlee' ends 64 characters after
    df = spark.createDataFrame(doc_rows(texts), COLUMNS)
    got = {r.doc_id: r for r in personal.find_personal(df).collect()}
    found = brute_terms(texts)
    assert "qlee" in found and [got[200 + k].n_term for k in range(4)] == [1] * 4
    assert sum(r.n_term for r in got.values()) == 4


def test_personal_repeated_rows_null_ids_and_nothing(spark):
    df = spark.createDataFrame([(1, "a@b.cd"), (1, "a@b.cd"), (None, "c@d.ef 1.1.1.1"), (2, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.spans) for r in personal.find_personal(df).collect()), key=str)
    assert got == sorted([(1, "email:0:6")] * 2 + [(None, "email:0:6,ip:7:14"), (2, "")], key=str)
    assert personal.find_personal(df.where("false")).count() == 0
    assert personal.sanitise(df.where("false")).count() == 0


# ---- pipeline --------------------------------------------------------------


def test_pipeline_stages(spark, prose, tmp_path):
    import corpus_pipeline
    from tabfold.llm import packing
    boiler = "Subscribe to our newsletter today please."
    texts = [None, "", "short"] + [f"{prose(k, 80)}\n{boiler}\n{prose(900 + k, 40)}" for k in range(40)]
    texts += [texts[10].replace("newsletter", "Newsletter")] * 3 + ["spam " * 2000, f"{prose(2000, 90)} write to who@where.org"]
    rows = [(i, t, "en", f"s{i % 20}", None if t is None else len(t), "extra") for i, t in enumerate(texts)]
    (tmp_path / "sf").mkdir()
    spark.createDataFrame(rows, COLUMNS + ", row string").write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "sf" / "documents.parquet"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path / "sf"))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        docs = spark.createDataFrame(out.collect(), out.schema)
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
    kept = set(range(3, 43)) | {43, 44, 45, 47}
    assert set(seen["quality rules"]) == kept
    assert sum(boiler in t for t in seen["line dedup"].values()) == 1
    assert set(seen["near-dedup"]) == set(range(3, 43)) | {47}
    assert seen["personal data"][47].endswith("write to <EMAIL>")
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    packed = corpus_pipeline.run(spark, str(tmp_path / "sf"))
    total = sum(len(packing.tokenizer(corpus_pipeline.public_tokenizers.path("word_bpe_49k.json")).encode(t).ids) + 1 for t in seen["personal data"].values())
    assert packed.agg(F.sum("length")).first()[0] == total
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0


def test_pipeline_of_odd_rows(spark, prose, tmp_path):
    """Null ids, repeated rows, a very long text, clashing columns: every stage returns the columns it got and loses no clean row."""
    import corpus_pipeline
    long = "\n".join(prose(3000 + k, 400) for k in range(60))
    base = [(i, prose(4000 + i, 60 + i % 9)) for i in range(30)] + [(None, prose(4100, 70)), (50, prose(4101, 70)), (50, prose(4101, 70)), (51, long), (52, None), (53, "")]
    rows = [(i, t, None if i == 5 else "en", None if i == 6 else "s", None if t is None else len(t), "x", 1, "k") for i, t in base]
    df = spark.createDataFrame(rows, COLUMNS + ", clean string, component_id int, `key` string")
    docs = df
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.dtypes == df.dtypes, name
        docs = spark.createDataFrame(out.collect(), out.schema)
        left = sorted((r.doc_id for r in docs.collect()), key=str)
        assert left == sorted([*range(30), None, 50, 50, 51], key=str), name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert {r.doc_id for r in packed} == {*range(30), None, 50, 51}
