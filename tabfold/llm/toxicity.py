"""Toxicity by a weighted finite-state grammar of insults and threats.

A text is a string of classes: words of the lexicon (insult, threat, target,
negation, report), quotation marks, clause ends, anything else.  Three
transducers are composed into one machine that reads this string once:

* negation: an insult or threat up to ``REACH`` words behind a negation is negated;
* reported speech: one that follows a word of saying, or stands in quotation
  marks, is reported;
* targets: an insult beside a target ("you ...", "... you") is directed, a
  threat that a target follows is directed, others are plain.

So a clause, not a word, decides what a match counts as.  A clause has one
weight for each kind of match, that of its strongest word; a document has the
sums over its clauses and their share of its clauses, and a logistic model
turns these into a score.

The word lists below are a start; the lexicon learns from labelled documents
which beginnings of words, and which whole words, mark the label: those whose
likelihood ratio would not come up by chance among as many as were tried.
Their weights are log-odds.  The model's weights are drawn towards stated
values, so that what the labels do not tell of keeps a sensible weight.

Learning uses at most about ``SAMPLE`` labelled documents (by a hash of the
id; of near copies one) and ``ENTRIES`` learned words; every document is scored, over its whole
text, in one narrow pass.

Defined cases: null and empty texts have no clause and get the model's lowest
common score; null ids are scored and never learned from; of several labels of an id
the largest holds; null labels and labels without a document are not used;
without any label of either kind the stated weights hold; repeated rows are
scored each; a table without rows gives no rows; other columns are never read.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabfold.llm.common import Remembered, let, ship_package, spent, stash, text_or_empty

SAMPLE = 20_000            # labelled documents that are learned from, about
ENTRIES = 5_000            # learned words and beginnings of words, those that tell most
PREFIXES = range(3, 9)     # letters of a beginning of a word
LONGEST = 40               # letters of a whole word of the lexicon
CHANCE = 0.05              # beginnings of words that may be learned by chance, of all that were tried
LIFT = 4.0                 # times the label's share that a learned one has at least
MORE = 0.5                 # log-odds by which a learned one differs from the longest beginning of it that is learned, too
OWED = 0.9                 # share of a beginning's documents that one longer entry has at most
REACH = 3                  # words

# Common words of four languages (a start; labels add to them).
INSULTS = ("idiot moron stupid loser scum trash pathetic worthless disgusting clown fool dumb jerk filth vermin "
           "dummkopf trottel abschaum imbécile crétin ordure idiota imbécil estúpido basura escoria").split()
THREATS = ("kill hurt destroy beat burn shoot stab strangle murder töten umbringen verletzen tuer frapper brûler "
           "matar golpear quemar destruir").split()
TARGETS = ("you your yours yourself du dich dir ihr euch tu toi te vous usted ustedes tú ti he she they them him "
           "people everyone").split()
NEGATIONS = ("not no never nobody isn't aren't don't doesn't didn't won't wasn't can't cannot nicht kein keine nie "
             "ne pas jamais nunca tampoco sin").split()
REPORTS = ("said says say called calls wrote writes told claimed quoted reported sagte sagt nannte schrieb laut dit "
           "disait écrit appelé selon dijo dice escribió llamó según").split()
WORDS = {w: letter for letter, words in (("Y", TARGETS), ("N", NEGATIONS), ("R", REPORTS), ("T", THREATS)) for w in words}
SEEDED, THREAT = 2.0, 1.0  # weights of listed insults and threats

KINDS = "DPKWnr"           # directed and plain insult, directed and plain threat, negated, reported
TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;\n]+|[\"“”„«»]")
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
END, QUOTE, OTHER = ("E", 0.0), ("Q", 0.0), ("o", 0.0)


# -- the grammar -----------------------------------------------------------------------------------------------------

Machine = dict             # (state, symbol) -> (next state, output); state 0 is where a clause begins


def negation() -> Machine:
    step = {}
    for left in range(REACH + 1):
        for c in "oYRQ":
            step[left, c] = max(0, left - 1), c
        step[left, "N"] = REACH, "N"
        for c in "IT":
            step[left, c] = max(0, left - 1), c.lower() if left else c
        step[left, "E"] = 0, "E"
    return step


def report() -> Machine:
    """States: 0 plain, 1 after a word of saying, 2 in quotation marks, 3 both."""
    step = {}
    for s in range(4):
        for c in "oYNit":                        # what is negated stays so
            step[s, c] = s, c
        step[s, "R"], step[s, "Q"] = (s | 1, "R"), (s ^ 2, "Q")
        for c in "IT":
            step[s, c] = s, "J" if s else c
        step[s, "E"] = 0, "E"
    return step


def target() -> Machine:
    """States: (words since a target, what waits for one, words it may wait), numbered; every match is written once, in order."""
    step, todo, number = {}, [(0, "", 0)], {(0, "", 0): 0}
    plain, directed = {"I": "P", "T": "W", "": ""}, {"I": "D", "T": "K", "": ""}

    def to(state, near, waits, left, out):
        new = (near, waits, left)
        if new not in number:
            number[new] = len(number)
            todo.append(new)
        return lambda c: step.__setitem__((state, c), (number[new], out))
    while todo:
        near, waits, left = state = todo.pop()
        k, gone = number[state], max(0, near - 1)
        to(k, REACH + 1, "", 0, directed[waits])("Y")
        for c in "oNRQ":
            if left > 1:
                to(k, gone, waits, left - 1, "")(c)
            else:
                to(k, gone, "", 0, plain[waits])(c)
        if near:
            to(k, gone, "", 0, plain[waits] + "D")("I")
        else:
            to(k, gone, "I", 2, plain[waits])("I")
        to(k, gone, "T", REACH, plain[waits])("T")
        for c in "it":
            to(k, gone, "", 0, plain[waits] + "n")(c)
        to(k, gone, "", 0, plain[waits] + "r")("J")
        to(k, 0, "", 0, plain[waits])("E")
    return step


def compose(first: Machine, second: Machine) -> Machine:
    """One machine that does what ``second`` does with the output of ``first``."""
    symbols = {c for _, c in first}
    number, todo, step = {(0, 0): 0}, [(0, 0)], {}
    while todo:
        a, b = pair = todo.pop()
        for c in symbols:
            a2, middle = first[a, c]
            b2, out = b, ""
            for m in middle:
                b2, o = second[b2, m]
                out += o
            if (a2, b2) not in number:
                number[a2, b2] = len(number)
                todo.append((a2, b2))
            step[number[pair], c] = number[a2, b2], out
    return step


def grammar() -> Machine:
    return compose(compose(negation(), report()), target())


# -- words -----------------------------------------------------------------------------------------------------------

def beginnings(word: str) -> list[str]:
    """What of a word the lexicon may hold, shortest first; a whole word ends with a mark."""
    found = [word[:k] for k in PREFIXES if k <= len(word)]
    return [*found, word + "|"] if 2 <= len(word) <= LONGEST else found


class Classes:
    """Class and weight of each token."""

    def __init__(self, learned: dict[str, float]):
        self.learned = {w + "|": SEEDED for w in INSULTS} | learned

    def __call__(self, token: str) -> tuple[str, float]:
        if not token[0].isalpha():
            return QUOTE if token[0] in "\"“”„«»" else END
        token = token.replace("’", "'")
        if token in WORDS:
            return WORDS[token], THREAT if WORDS[token] == "T" else 0.0
        for known in reversed(beginnings(token)):            # the longest that the lexicon has
            if known in self.learned:
                weight = self.learned[known]
                return ("I", weight) if weight > 0 else OTHER
        return OTHER


def clause_weights(text: str, classes: Remembered, machine: Machine) -> tuple[dict[str, float], dict[str, int], int]:
    """Sums of the clauses' strongest matches by kind, clauses with a match by kind, and the number of clauses."""
    tokens = [classes[t] for t in TOKEN.findall(text.lower())]
    sums, counts = dict.fromkeys(KINDS, 0.0), dict.fromkeys(KINDS, 0)
    clauses, open_ = 0, False
    for c, _ in tokens:
        if c == "E":
            clauses, open_ = clauses + open_, False
        elif c != "Q":
            open_ = True
    clauses += open_
    if not any(c in "IT" for c, _ in tokens):
        return sums, counts, clauses
    state, waiting, best = 0, deque(), {}
    for c, weight in [*tokens, END]:
        if c in "IT":
            waiting.append(weight)
        state, out = machine[state, c]
        for kind in out:
            best[kind] = max(best.get(kind, 0.0), waiting.popleft())
        if c == "E" and best:
            for kind, w in best.items():
                sums[kind] += w
                counts[kind] += 1
            best = {}
    return sums, counts, clauses


# -- the model -------------------------------------------------------------------------------------------------------

def features(sums: dict[str, float], clauses: int) -> list[float]:
    share = (sums["D"] + sums["P"] + sums["K"]) / max(1, clauses)
    return [1.0, *[math.log1p(sums[k]) for k in KINDS], math.log1p(share), math.log1p(clauses)]


#: Where the weights start from: constant, kinds as in ``KINDS``, share of the clauses, number of clauses.
STATED = np.array([-3.0, 2.0, 1.5, 2.0, 0.3, -0.3, 0.3, 0.5, 0.0])
PULL = np.array([0.05, *[0.2] * 6, 0.2, 0.2])         # towards these


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of highest posterior probability (Newton's method with halved steps)."""
    w = STATED.copy()

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0, z).sum() - y @ z + (PULL * (w - STATED) ** 2).sum() / 2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ w)))
        slope = x.T @ (p - y) + PULL * (w - STATED)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(PULL), slope)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if size * np.abs(step).max() < 1e-8:
            break
    return w


@dataclass(frozen=True)
class Model:
    learned: dict[str, float]
    weights: list[float]


def _beginning_counts(sample: DataFrame) -> DataFrame:
    """(beginning, pos, neg): labelled documents of either kind that hold it."""
    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pos, neg = Counter(), Counter()

        def told() -> Iterator[pd.DataFrame]:
            keys = list(pos | neg)
            for lo in range(0, len(keys), 20_000):
                some = keys[lo:lo + 20_000]
                yield pd.DataFrame({"beginning": some, "pos": [pos[k] for k in some], "neg": [neg[k] for k in some]})
            pos.clear()
            neg.clear()
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"], strict=True):
                own = {b for w in {w.replace("’", "'") for w in WORD.findall(text.lower())} for b in beginnings(w)}
                (pos if label else neg).update(own)
                if len(pos) + len(neg) > 200_000:
                    yield from told()
        yield from told()
    return (sample.select("text", "label").mapInPandas(counts, "beginning string, pos long, neg long")
            .groupBy("beginning").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))


def _lexicon(sample: DataFrame, pos: int, neg: int) -> dict[str, float]:
    counts = stash(_beginning_counts(sample), "toxicity-beginnings")
    tried = counts.count()
    a, b, n, p = F.col("pos"), F.col("neg"), float(pos + neg), pos / (pos + neg)
    has, some = a + b, lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
    ratio = 2 * (some(a, has * p) + some(b, has * (1 - p)) + some(pos - a, (n - has) * p) + some(neg - b, (n - has) * (1 - p)))
    found = (counts.withColumn("ratio", ratio).where((a >= 3) & (a / has >= min(LIFT * p, (1 + p) / 2)))
             .where(F.col("ratio") >= 2 * math.log(max(tried, 1) / CHANCE))
             .orderBy(F.desc("ratio"), "beginning").limit(ENTRIES).collect())            # at most ENTRIES rows
    # a beginning that owes most of its documents to one longer entry says no more than that one
    held = {r["beginning"]: r["pos"] for r in found}
    owed: dict[str, int] = {}
    for b, n in held.items():
        for shorter in (b[:k] for k in PREFIXES if k < len(b)):
            if shorter in held:
                owed[shorter] = max(owed.get(shorter, 0), n)
    base, learned = math.log((pos + 0.5) / (neg + 0.5)), {}
    for r in sorted(found, key=lambda r: len(r["beginning"])):
        b, odds = r["beginning"], math.log((r["pos"] + 0.5) / (r["neg"] + 0.5)) - base
        shorter = [learned[b[:k]] for k in PREFIXES if k < len(b) and b[:k] in learned]
        if owed.get(b, 0) < OWED * r["pos"] and not (shorter and abs(odds - shorter[-1]) <= MORE):
            learned[b] = odds
    return learned


def _class_features(texts: Column, learned: dict[str, float]) -> Column:
    """Sums and counts by kind and the number of clauses of each text."""
    fields = [*[f"s_{k} double" for k in range(len(KINDS))], *[f"c_{k} long" for k in range(len(KINDS))], "clauses long"]

    @F.pandas_udf(", ".join(fields))
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        classes, machine = Remembered(Classes(learned), 50_000), grammar()
        for texts in batches:
            rows = []
            for t in texts:
                sums, counts, clauses = clause_weights(t, classes, machine)
                rows.append((*[sums[k] for k in KINDS], *[counts[k] for k in KINDS], clauses))
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in fields])
        classes.forget()
        spent()
    return read(texts)


def train(docs: DataFrame, labels: DataFrame, learn_from: Column, key: str = "doc_id", text: str = "text",
          label: str = "toxic", sample: int = SAMPLE) -> Model:
    """A model from the labels of rows of ``labels`` for which ``learn_from`` holds."""
    ship_package(docs.sparkSession)
    known = (labels.where(F.coalesce(learn_from, F.lit(False)) & F.col(key).isNotNull() & F.col(label).isNotNull())
             .groupBy(F.col(key).alias("_id")).agg(F.max(F.col(label).cast("int")).alias("label")))
    n = known.count()
    few = known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < math.ceil(sample * (1 << 20) / max(n, sample)))
    # about ``sample`` rows of two numbers, so a broadcast is safe
    rows = docs.select(F.col(key).alias("_key"), text_or_empty(text).alias("text")).join(F.broadcast(few), F.col("_key") == F.col("_id"))
    # documents alike in their smallest hash of three words are mostly copies of one text: one of them tells
    words = F.split(F.lower("text"), r"[^\p{L}]+")
    threes = lambda w: F.array_min(F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - 2, F.lit(1))), lambda i: F.xxhash64(F.array_join(F.slice(w, i, 3), " "))))
    one = rows.groupBy(let(words, threes).alias("alike")).agg(F.min_by(F.struct("text", "label"), F.struct("_id", "text")).alias("one"))
    texts = stash(one.select("one.text", (F.col("one.label") > 0).alias("label")), "toxicity-sample")
    pos, neg = texts.agg(F.count_if("label"), F.count_if(~F.col("label"))).first()
    if not pos or not neg:
        return Model({}, STATED.tolist())
    learned = _lexicon(texts, pos, neg)
    rows = texts.select(_class_features(F.col("text"), learned).alias("f"), "label").select("f.*", "label").collect()     # about SAMPLE rows
    x = np.array([features({k: r[f"s_{i}"] for i, k in enumerate(KINDS)}, r["clauses"]) for r in rows])
    return Model(learned, fit_logistic(x, np.array([r["label"] for r in rows], dtype=float)).tolist())


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, score, predicted, clauses, and clauses with each kind of match, of every row; no shuffle."""
    ship_package(docs.sparkSession)
    read = docs.select(F.col(key).alias("_key"), _class_features(text_or_empty(text), model.learned).alias("f"))
    sums = [F.col(f"f.s_{i}") for i in range(len(KINDS))]
    share = (sums[0] + sums[1] + sums[2]) / F.greatest(F.col("f.clauses"), F.lit(1))
    parts = [*[F.log1p(s) for s in sums], F.log1p(share), F.log1p(F.col("f.clauses"))]
    z = F.lit(model.weights[0])
    for w, part in zip(model.weights[1:], parts, strict=True):
        z = z + F.lit(w) * part
    names = ("directed_insults", "insults", "directed_threats", "threats", "negated", "reported")
    scored = read.select("_key", (1 / (1 + F.exp(-z))).alias("score"), "f")
    return scored.select(F.col("_key").alias(key), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         F.col("f.clauses").alias("clauses"), *[F.col(f"f.c_{i}").alias(name) for i, name in enumerate(names)])
