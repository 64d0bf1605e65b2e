"""Fill-in-middle against plain Python on whole texts, with odd inputs."""

import hashlib
import random
import re

import pytest
from corpus_helpers import COLUMNS, doc_rows, prose  # noqa: F401
from tabfold.llm import fim
from tabfold.llm.common import Remembered

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")
ODD = [None, "", "a", "<", "ab", "naïve café é 日本語 🙂x", "x" * 30_000, "é" * 9_000, "\n" * 5000, "a <P> b", "s<S>", "<M>",
       "a< b <c> P> <", "word " * 8000, "\x00\x01 z", "aé" * 6000, "long" * 4000 + " " + "tail" * 3000]


def plain_fim(doc_id, text):
    t = text or ""
    hexes = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexes[8 * k:8 * k + 8], 16) for k in range(4)]
    units = UNIT.findall(t) if "\n" not in t else re.findall(r"(?s)[A-Za-z]+|[^A-Za-z]", t)
    n = len(units)
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, t
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_against_plain_python(spark, prose):
    rand = random.Random(5)
    shared = prose(1, 900)
    texts = ODD + [prose(k, 5 + 40 * (k % 9)) for k in range(60)] + [prose(99 + k, 30) + shared + prose(50 + k, 60) for k in range(8)]
    texts += ["".join(rand.choices("ab <é🙂>PSM\n", k=200 + k)) for k in range(40)] + [shared] * 3
    rows = [(*r, "clash", 3, 4) for r in doc_rows(texts)] + [(None, "no id at all", "en", "a", 12, "clash", 3, 4)]
    df = spark.createDataFrame(rows, COLUMNS + ", output string, n int, h1 int").repartition(3)
    made = fim.fill_in_middle(df)
    got = {r.doc_id: r for r in made.withColumn("back", fim.restored()).collect()}
    assert len(got) == len(rows)
    for doc_id, text, *_ in rows:
        r = got[doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_fim(doc_id, text), doc_id
        assert r.back == (text or "")
    assert {r.form for r in got.values()} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(df.where("false")).count() == 0


@pytest.mark.parametrize("text", [t for t in ODD if t])
def test_every_cut(text):
    units = fim.Units(text.encode(), Remembered(fim.summary, 16))
    want = re.findall(r"(?s)[A-Za-z]+|[^A-Za-z]", text)
    assert (units.n, units.n_chars) == (len(want), len(text))
    for k in {0, 1, 2, len(want) // 3, len(want) // 2, len(want) - 1, len(want), *random.Random(1).sample(range(len(want) + 1), min(50, len(want)))}:
        assert units.chars_of(k) == len("".join(want[:max(0, k)])) if k >= 0 else True


def test_chunks_are_those_of_the_content(prose):
    shared, chunks = prose(7, 4000).encode(), []
    for raw in (shared, b"another start " * 9 + shared, prose(8, 333).encode() + shared):
        ends = fim.chunk_ends(raw)
        sizes = [b - a for a, b in zip([0, *ends], ends)]
        assert sum(sizes) == len(raw) and all(fim.SHORTEST <= s <= fim.LONGEST for s in sizes[:-1])
        chunks.append({raw[a:b] for a, b in zip([0, *ends], ends)})
    assert len(chunks[0] & chunks[1] & chunks[2]) >= 0.9 * len(chunks[0]) > 20
    asked = []
    remembered = Remembered(lambda c: asked.append(c) or fim.summary(c), 1000)
    for _ in range(3):
        fim.Units(shared, remembered)
    assert len(asked) == len(set(asked)) == len(chunks[0])


def test_strides_do_not_move_chunks(prose, monkeypatch):
    raw = ("é" + prose(3, 3000)).encode()
    want = fim.chunk_ends(raw)
    for stride in (17, 64, 1000):
        monkeypatch.setattr(fim, "STRIDE", stride)
        assert fim.chunk_ends(raw) == want
