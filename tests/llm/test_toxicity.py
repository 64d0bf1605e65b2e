"""Toxicity: the grammar against plain rules, the learned lexicon, held-out accuracy, odd inputs."""

import random
import re
import zlib

import numpy as np
import pytest
from corpus_helpers import COLUMNS, doc_rows, prose  # noqa: F401
from pyspark.sql import functions as F
from tabfold.llm import queries, toxicity
from tabfold.llm.common import Remembered

MACHINE = toxicity.grammar()


def kinds(text, learned=None):
    sums, counts, clauses = toxicity.clause_weights(text, Remembered(toxicity.Classes(learned or {}), 1000), MACHINE)
    return {k: n for k, n in counts.items() if n}, clauses


@pytest.mark.parametrize("text, want", [
    ("You are an idiot.", {"D": 1}), ("you idiot", {"D": 1}), ("idiot, all of you", {"P": 1}), ("Idiot you are", {"D": 1}),
    ("That plan was stupid.", {"P": 1}), ("You are not stupid.", {"n": 1}), ("He is not at all a very stupid man", {"P": 1}),
    ("She called the man a moron. The man is a moron.", {"r": 1, "P": 1}), ('The sign says "trash" here', {"r": 1}),
    ('A "loser" was seen', {"r": 1}), ("I will kill you", {"K": 1}), ("They kill the lights", {"W": 1}), ("kill time and you", {"K": 1}), ("kill time and then you", {"W": 1}),
    ("kill some time and then rest, you", {"W": 1}), ("I will not hurt you", {"n": 1}), ("he said he would shoot you", {"r": 1}),
    ("idiot idiot idiot", {"P": 1}), ("idiot; idiot", {"P": 2}), ("kill moron you", {"W": 1, "D": 1}), ("du Idiot!", {"D": 1}),
    ("ce n'est pas stupid", {"n": 1}), ("", {}), ("...!?", {}), ("nothing here.", {}), ("isn’t stupid", {"n": 1})])
def test_clauses(text, want):
    assert kinds(text)[0] == want


def test_number_of_clauses():
    assert kinds("a b. c!\n\n d; . \" e")[1] == 4 and kinds("")[1] == 0


def test_composition_does_what_its_parts_do_in_turn():
    """The one machine against the three run one after the other, on random classes."""
    parts = (toxicity.negation(), toxicity.report(), toxicity.target())
    for seed in range(300):
        symbols = random.Random(seed).choices("oooYNRQIITE", k=40) + ["E"]
        state, out = 0, ""
        for c in symbols:
            state, o = MACHINE[state, c]
            out += o
        told = symbols
        for part in parts:
            s, made = 0, []
            for c in told:
                s, o = part[s, c]
                made += o
            told = made
        assert "".join(told) == out and len(out) == sum(c in "IT" for c in symbols) and state == 0


def test_longest_known_beginning_counts():
    classes = toxicity.Classes({"bad": 1.0, "badge": -2.0, "badly|": 3.0})
    assert [classes(w) for w in ("bad", "badness", "badges", "badly", "badlyx", "idiot", "idiots")] == [
        ("I", 1.0), ("I", 1.0), toxicity.OTHER, ("I", 3.0), ("I", 1.0), ("I", toxicity.SEEDED), toxicity.OTHER]


def test_logistic_fit_reaches_the_posterior_mode():
    rand = np.random.default_rng(1)
    x = np.c_[np.ones(400), rand.poisson(0.4, (400, 8))].astype(float)
    y = (rand.random(400) < 1 / (1 + np.exp(3 - x[:, 1:].sum(1)))).astype(float)
    w = toxicity.fit_logistic(x, y)
    slope = x.T @ (1 / (1 + np.exp(-(x @ w))) - y) + toxicity.PULL * (w - toxicity.STATED)
    assert np.abs(slope).max() < 1e-6


def corpus(prose, n=900):
    """Toxic texts hold insults that no list knows: a word, and words with one beginning."""
    rand, rows = random.Random(3), []
    for i in range(n):
        words, toxic = prose(i, 30 + i % 40).split(), i % 8 == 0
        for _ in range(2 + i % 3 if toxic else 0):
            words.insert(rand.randrange(len(words)), "zorkle" if i % 16 else "quaxl" + rand.choice(["a", "en", "ity"]))
        rows.append((i, " ".join(words).capitalize() + ".", int(toxic)))
    return rows


def test_learned_from_labels(spark, prose):
    rows = corpus(prose)
    df = spark.createDataFrame([(i, t, "en", "s", 1, 0.5, 7) for i, t, _ in rows] + [(9001, None, None, None, None, 0.0, 0), (9002, "", "", "", 0, 0.0, 0),
                               (None, "zorkle you", "en", "s", 1, 0.0, 0), (9003, "zorkle " * 50_000, "en", "s", 1, 0.0, 0), (0, rows[0][1], "en", "s", 1, 0.0, 0)],
                               COLUMNS + ", score double, s_0 int")
    labels = spark.createDataFrame([(i, x, "other") for i, _, x in rows] + [(1, None, ""), (None, 1, ""), (77_777, 1, ""), (5, 0, "")],
                                   "doc_id long, toxic int, text string")
    model = toxicity.train(df, labels, F.col("doc_id") % 5 != 0)
    assert any(k.startswith("zork") for k in model.learned) and any(k.startswith("quax") for k in model.learned)
    got = toxicity.score(df, model).collect()
    assert len(got) == len(rows) + 5 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by = {r.doc_id: r for r in got}
    held = [(by[i], x) for i, _, x in rows if i % 5 == 0]
    assert sum(r.predicted == x for r, x in held) >= 0.98 * len(held)
    assert by[9001].score == by[9002].score < 0.2 and by[None].predicted == 1 and by[9003].predicted == 1
    assert toxicity.score(df.where("false"), model).count() == 0
    assert [r.score for r in got if r.doc_id == 0][0] == [r.score for r in got if r.doc_id == 0][1]


def test_without_labels_the_stated_weights_hold(spark, prose):
    rows = doc_rows(["You are a pathetic idiot. You worthless scum! You clown.", prose(1, 50), "He said you are stupid."])
    df = spark.createDataFrame(rows, COLUMNS)
    for labels in ([], [(0, 1)], [(1, 0)]):
        model = toxicity.train(df, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
        assert model == toxicity.Model({}, toxicity.STATED.tolist())
        assert [r.predicted for r in toxicity.score(df, model).orderBy("doc_id").collect()] == [1, 0, 0]


def test_held_out_rows_are_not_learned_from(spark, prose, tmp_path):
    rows = corpus(prose, 300)
    out = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    for name, flip in (("a", False), ("b", True)):
        spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t, _ in rows], COLUMNS).write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.createDataFrame([(i, 1 - x if flip and out(i) else x) for i, _, x in rows], "doc_id long, toxic int").write.parquet(
            str(tmp_path / name / "labels.parquet"))
    a, b = ({r.doc_id: r for r in queries.op13_toxicity(spark, str(tmp_path / n)).collect()} for n in "ab")
    assert a == b and all(r.held_out == out(i) for i, r in a.items())


def test_clauses_against_a_plain_reading(prose):
    """Without negation, report and target words a clause counts once, if it holds an insult."""
    rand = random.Random(9)
    for seed in range(40):
        words = prose(seed, 60).split()
        for _ in range(seed % 7):
            words.insert(rand.randrange(len(words)), rand.choice(toxicity.INSULTS[:10]))
        text = " ".join(w + (rand.choice(".!?;") if rand.random() < 0.1 else "") for w in words)
        known = set(toxicity.INSULTS)
        clauses = [set(re.findall(r"[^\W\d_]+", c)) for c in re.split(r"[.!?;]", text)]
        if any(w in toxicity.WORDS for c in clauses for w in c):
            continue
        assert kinds(text)[0].get("P", 0) == sum(bool(c & known) for c in clauses)
