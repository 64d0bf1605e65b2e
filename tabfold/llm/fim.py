"""Fill-in-middle texts, cut at units counted chunk by chunk.

A unit is a run of ASCII letters or any other single character.  Where the
n-th unit of a document begins is found from summaries of its chunks:

1. A rolling hash over the last 16 bytes of the UTF-8 text names the places
   where a chunk may end; chunks have 64 to 4,096 bytes and never split a
   character.  The places depend on the bytes around them only, so passages
   that documents share fall into the same chunks.
2. A chunk's summary (units, characters, whether it begins and ends within a
   run of letters) is made once and remembered under the chunk's own bytes: a
   remembered summary is used only for bytes that are equal, not for a hash.
3. Summaries combine: a run of letters that goes on from one chunk into the
   next is one unit less.  Running totals give the number of units and, for a
   cut, the chunk that holds it; only that chunk is read again.

Prefix and middle end after the smaller and the larger of two hashes of the id
(modulo the number of units plus one); a third hash keeps some texts plain, a
fourth puts the suffix first.  The pieces are put together by Spark.

Defined cases: a null text counts as the empty text, which is plain; a text
that holds one of the marks is plain; a null id is hashed like an empty one;
repeated rows come out alike; texts of any length are hashed a megabyte at a
time; a table without rows gives no rows; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabfold.llm.common import Remembered, let, ship_package, spent, text_or_empty

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20        # percent of the third and of the fourth hash

WINDOW = 16                           # bytes that the rolling hash sees
SHORTEST, MASK, LONGEST = 64, 0xFF, 4096      # bytes of a chunk: at least, about (plus the shortest), at most
STRIDE = 1 << 20                      # bytes hashed at a time
REMEMBERED = 8192                     # chunks: 32 MB at the very most, twice

#: A fixed random word for each byte (splitmix64 of the byte, upper half).
_MIXED = [((b + 1) * 0x9E3779B97F4A7C15) & ((1 << 64) - 1) for b in range(256)]
_MIXED = [((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & ((1 << 64) - 1) for x in _MIXED]
GEAR = np.array([((x ^ (x >> 27)) * 0x94D049BB133111EB >> 32) & 0xFFFFFFFF for x in _MIXED], dtype=np.uint32)

_IS_LETTER = np.zeros(256, dtype=bool)
_IS_LETTER[65:91] = _IS_LETTER[97:123] = True


class Summary(NamedTuple):
    units: int           # that begin in the chunk, were it a text of its own
    chars: int
    opens: bool          # with a letter
    closes: bool         # with a letter


def rolling(data: np.ndarray) -> np.ndarray:
    """The hash of the ``WINDOW`` bytes that end at each place (fewer at the start)."""
    h = GEAR[data]
    width = 1
    while width < WINDOW:          # windows of 2, 4, 8 ... bytes from two of half the size
        wider = h.copy()
        wider[width:] += h[:-width] << np.uint32(width)
        h, width = wider, 2 * width
    return h


def chunk_ends(raw: bytes) -> list[int]:
    """Ends of the chunks of ``raw``, the last of them its length."""
    data, ends, last = np.frombuffer(raw, dtype=np.uint8), [], 0
    starts_char = lambda at: data[at] & 0xC0 != 0x80

    def forced(upto: int) -> None:
        nonlocal last
        while upto - last > LONGEST:
            at = last + LONGEST
            while not starts_char(at):
                at -= 1
            ends.append(at)
            last = at

    for lo in range(0, len(data), STRIDE):
        before = min(lo, WINDOW - 1)
        h = rolling(data[lo - before:lo + STRIDE])[before:]
        for at in (np.flatnonzero((h & MASK) == 0) + lo + 1).tolist():
            if at - last >= SHORTEST and at < len(data) and starts_char(at):
                forced(at)
                if at - last >= SHORTEST:
                    ends.append(at)
                    last = at
    forced(len(data))
    return [*ends, len(data)]


def _unit_starts(chunk: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Whether a unit begins at each byte, and whether a character does."""
    data = np.frombuffer(chunk, dtype=np.uint8)
    letter, char = _IS_LETTER[data], (data & 0xC0) != 0x80
    inside = np.zeros(len(data), dtype=bool)
    inside[1:] = letter[1:] & letter[:-1]
    return char & ~inside, char


def summary(chunk: bytes) -> Summary:
    starts, char = _unit_starts(chunk)
    return Summary(int(starts.sum()), int(char.sum()), bool(_IS_LETTER[chunk[0]]), bool(_IS_LETTER[chunk[-1]]))


class Units:
    """Counts and places of the units of one text, from the summaries of its chunks."""

    def __init__(self, raw: bytes, remembered):
        self.chunks, begun, chars, at, closes = [], [], [], 0, False
        self.joined: list[bool] = []           # chunks whose first unit began in an earlier one
        for end in chunk_ends(raw) if raw else []:
            chunk = raw[at:end]
            s = remembered[chunk]
            self.joined.append(closes and s.opens)
            begun.append(s.units - self.joined[-1])
            chars.append(s.chars)
            self.chunks.append(chunk)
            at, closes = end, s.closes
        self.begun, self.chars = np.cumsum([0, *begun]), np.cumsum([0, *chars])
        self.n, self.n_chars = int(self.begun[-1]), int(self.chars[-1])

    def chars_of(self, units: int) -> int:
        """Characters of the first ``units`` units: where the next one begins."""
        if units >= self.n:
            return self.n_chars
        j = int(np.searchsorted(self.begun, units, side="right")) - 1
        starts, char = _unit_starts(self.chunks[j])
        byte = np.flatnonzero(starts)[units - int(self.begun[j]) + self.joined[j]]
        return int(self.chars[j]) + int(char[:byte].sum())


def _hashes(key: str, seed: int) -> list[Column]:
    hexes = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(hexes, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1,
                   plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """``key``, n, form, prefix_chars, middle_chars and output of every row; no shuffle."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("n long, cut1 long, cut2 long")
    def cuts(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        remembered = Remembered(summary, REMEMBERED)
        for texts, first, second in batches:
            rows = []
            for t, a, b in zip(texts, first, second, strict=True):
                units = Units(t.encode(), remembered)
                one, two = sorted((int(a) % (units.n + 1), int(b) % (units.n + 1)))
                rows.append((units.n, units.chars_of(one), units.chars_of(two)))
            yield pd.DataFrame(rows, columns=["n", "cut1", "cut2"])
        remembered.forget()
        spent()

    t, c = F.col("t"), F.col("c")
    marked = t.contains(PREFIX) | t.contains(SUFFIX) | t.contains(MIDDLE)
    form = (F.when((F.length(t) == 0) | marked | (F.col("h3") % 100 >= plain_from), "plain")
            .when(F.col("h4") % 100 < spm_below, "spm").otherwise("psm"))
    piece = lambda start, length: F.substring(t, (start + 1).cast("int"), length.cast("int"))
    prefix, middle = piece(F.lit(0), c["cut1"]), piece(c["cut1"], c["cut2"] - c["cut1"])
    suffix = piece(c["cut2"], F.length(t))
    output = (F.when(F.col("form") == "plain", t)
              .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
              .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)))
    cut = F.col("form") != "plain"
    return (docs.select(F.col(key).alias("id"), text_or_empty(text).alias("t"), *_hashes(key, seed))
            .withColumn("c", cuts("t", "h1", "h2")).withColumn("form", form)
            .select(F.col("id").alias(key), c["n"].alias("n"), "form", F.when(cut, c["cut1"]).alias("prefix_chars"),
                    F.when(cut, c["cut2"] - c["cut1"]).alias("middle_chars"), output.alias("output")))


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that ``output`` was made from: no piece holds a mark, so each mark's first place is its own."""
    def between(o: Column, first: str, then: str | None) -> Column:
        start = F.instr(o, F.lit(first)) + len(first)
        return F.substring(o, start, F.length(o) if then is None else F.instr(o, F.lit(then)) - start)

    def joined(order: tuple[str, str, str]):
        after = dict(zip(order, [*order[1:], None], strict=True))
        return lambda o: F.concat(*[between(o, mark, after[mark]) for mark in (PREFIX, MIDDLE, SUFFIX)])
    return (F.when(F.col(form) == "plain", F.col(output))
            .when(F.col(form) == "psm", let(F.col(output), joined((PREFIX, SUFFIX, MIDDLE))))
            .otherwise(let(F.col(output), joined((SUFFIX, PREFIX, MIDDLE)))))
