"""Merkle manifests against plain Python, with odd groups and keys."""

import hashlib
import zlib

import pytest
from corpus_helpers import COLUMNS, prose  # noqa: F401
from pyspark.sql import functions as F
from tabfold.llm import merkle, queries

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels_of(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + arity]) for i in range(0, len(out[-1]), arity)])
    return out


def siblings(levels, at, arity):
    steps = []
    for nodes in levels[:-1]:
        lo = at - at % arity
        run = nodes[lo:lo + arity]
        steps.append((run[:at - lo], run[at - lo + 1:]))
        at //= arity
    return steps


def brute(rows, arity=8):
    """row -> (leaf, subroot, root, siblings, steps); rows are (doc_id, source, lang, n_chars, text)."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, out = {}, {}
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, bytes.fromhex(leaf_of(r))))
        trees[lang] = own, levels_of([leaf_of(r) for r in own], arity)
    top = levels_of([trees[x][1][-1][0] for x in langs], arity)
    for k, lang in enumerate(langs):
        own, levels = trees[lang]
        for at, r in enumerate(own):
            steps = siblings(levels, at, arity) + siblings(top, k, arity)
            out.setdefault(r, []).append((leaf_of(r), levels[-1][0], top[-1][0], steps))
    return out


def folded(start, steps):
    for left, right in steps:
        start = h(*left, start, *right)
    return start


def rows_of(prose, sizes):
    out, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            i = (i * 7919 + 13) % 100_003
            out.append((i, f"s{i % 3}" if i % 11 else None, lang, 5 if i % 7 else None, prose(i, 3).title() if i % 5 else None))
    return out


def check(got, rows, arity=8):
    want = brute(rows, arity)
    assert len(got) == len(rows)
    for r in got:
        found = want[(r.doc_id, r.source, r.lang, r.n_chars, r.text)]
        digests = [[x.hex() for x in (r.leaf, r.subroot, r.root)], [(bytes(s.before).hex(), bytes(s.after).hex()) for s in r.path]]
        assert digests in [[[a, b, c], [("".join(x), "".join(y)) for x, y in steps]] for a, b, c, steps in found]


def keep():
    return {c: F.col(c) for c in FIELDS[1:]}


@pytest.mark.parametrize("arity", [2, 3, 8])
def test_against_plain_python(spark, prose, arity, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_ROWS", 40)           # several ranges in a group
    rows = rows_of(prose, {"en": 150, "de": 65, "fr": 9, "é": 8, "Z": 2, "a": 1, None: 20, "": 3})
    rows += [rows[0]] * 3 + [(None, "s", "en", 1, "null id")] * 2 + [(rows[1][0], "twice the id", "en", 2, "other text")]
    df = spark.createDataFrame([(a, e, c, b, d, "clash", "clash") for a, b, c, d, e in rows],
                               COLUMNS + ", `group` string, at string").repartition(5)
    check(merkle.manifest(df, FIELDS, "lang", "doc_id", arity, keep()).collect(), rows, arity)


@pytest.mark.parametrize("sizes", [{}, {"en": 1}, {None: 1, "de": 1}, {"en": 8}, {"en": 9}, {"en": 65, None: 1}, dict.fromkeys("abcdefghijklmnopqrst", 1)])
def test_small_trees(spark, prose, sizes):
    rows = rows_of(prose, sizes)
    df = spark.createDataFrame([(a, e, c, b, d) for a, b, c, d, e in rows], COLUMNS)
    check(merkle.manifest(df, FIELDS, "lang", "doc_id", carried=keep()).collect(), rows)


def test_query_sees_what_was_tampered_with(spark, prose, tmp_path):
    rows = rows_of(prose, {"en": 90, "de": 10, None: 1}) + [(9, "s", "en", 3, "lower only"), (None, "s", "en", 4, "No Id")]
    spark.createDataFrame([(a, e, c, b, d) for a, b, c, d, e in rows], COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    want = {r[0]: (r, v[0]) for r, v in brute(rows).items()}
    got = queries.op12_merkle(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and {r.verified for r in got} == {True, False}
    for r in got:
        row, (leaf, subroot, root, steps) = want[r.doc_id]
        text = row[4]
        if r.doc_id is not None and text is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0:
            text = text.lower()
        bent = folded(leaf_of((*row[:4], text)), steps)
        assert (r.leaf, r.subroot, r.root, r.folded_root, r.verified) == (leaf, subroot, root, bent, bent == root)
        assert r.proof_sha256 == h(*[x for left, right in steps for x in (*left, *right)])
