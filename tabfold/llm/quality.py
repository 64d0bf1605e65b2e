"""Quality rules: compression bands.

A text is judged by how well zstandard shrinks it, as a whole and in fixed
chunks.  Prose of a given length lies in a narrow band of ratios (raw bytes /
compressed bytes); loops and boilerplate lie above it, random characters and
encoded blobs below it.  Short texts compress less, so the limits depend on the
length.  They come from the table itself: for each class of lengths, and for
whole chunks, the quartiles of the ratios of all distinct texts, and from there
outwards ``LOWER`` or ``UPPER`` times their distance (``LEAST`` times the median
at least).  The lower margin is wider: blobs lie far below prose, loops need not.
``BANDS`` bounds them, for tables of which a large part is junk, and stands alone
for classes of fewer than ``FEWEST`` texts.

Defined cases: a null text counts as the empty text; the empty text has no
words, so the base rules reject it; repeated rows get the same verdict each;
a table without rows gives no rows; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabfold.llm.common import ship_package, spent, utf8

#: (bytes below, lowest ratio, highest ratio).  Written prose in European
#: languages has ratios of about 1.3 (300 bytes) to 3 (100 KB); base64 has 1.3
#: at any length, random bytes 1.  Limits leave a wide margin around prose.
BANDS = (
    (128, 0.0, 2.5),
    (256, 0.9, 3.0),
    (512, 1.15, 3.5),
    (1024, 1.15, 3.5),
    (2048, 1.35, 4.5),
    (4096, 1.35, 4.5),
    (8192, 1.5, 5.5),
    (16384, 1.5, 5.5),
    (float("inf"), 1.5, 7.0),
)
CHUNK = 4096          # bytes of a fixed chunk
WHOLE_CHUNKS = len(BANDS)       # their class, after those of texts
LOWER, UPPER, LEAST = 2.0, 1.5, 0.05    # beyond the quartiles: times their distance, and times the median at least
FEWEST = 50           # distinct texts of a class that has limits of its own
STEP, TOP = 0.001, 10.0         # bins of the ratios, and the last one
MAX_BAD_CHUNKS = 0.25   # share of chunks outside their band that a text may have
LEVEL = 3             # zstandard level
MIN_WORDS = 10        # base rule
MAX_REPEATED = 20     # base rule: percent of words in repeated 5-word windows
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"

SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, ratio double, n_chunks long, n_bad_chunks long, verdict string, kept boolean")


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words that lie in some ``width``-word window which occurs at least twice."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    window = code[:n]
    for k in range(1, width):       # rank windows of k + 1 words exactly, one word at a time
        _, window = np.unique(window * len(ids) + code[k:n + k], return_inverse=True)
    again = np.bincount(window)[window] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += again
    edge[width:] -= again
    return int((np.cumsum(edge[:-1]) > 0).sum())


def class_of(n_bytes: int) -> int:
    return next(k for k, (below, _, _) in enumerate(BANDS) if n_bytes < below)


#: (lowest, highest) ratio of each class of texts, then of whole chunks, where the table gives none.
FIXED = tuple((low, high) for _, low, high in BANDS) + (BANDS[class_of(CHUNK)][1:],)


def chunks_of(text: bytes) -> list[bytes]:
    return [text[i:i + CHUNK] for i in range(0, len(text), CHUNK)] if len(text) > CHUNK else []


def in_band(n_bytes: int, packed: int, limits, chunk: bool = False) -> int:
    """0 inside the band of this length, 1 above it (repetitive), -1 below it (incompressible)."""
    low, high = limits[WHOLE_CHUNKS if chunk and n_bytes == CHUNK else class_of(n_bytes)]
    ratio = n_bytes / packed
    return 1 if ratio > high else (-1 if ratio < low else 0)


def _ratio_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Of each text, (class, bin) of its ratio and of those of its whole chunks."""
    zstd = zstandard.ZstdCompressor(level=LEVEL)

    def binned(data: bytes) -> int:
        return int(min(TOP, len(data) / len(zstd.compress(data))) / STEP)
    for texts in batches:
        yield pd.Series([[[class_of(len(t)), binned(t)]] + [[WHOLE_CHUNKS, binned(c)] for c in chunks_of(t) if len(c) == CHUNK] if t else []
                         for t in texts])
    spent()


def limits_from(histogram: dict[int, dict[int, int]]) -> tuple:
    """(lowest, highest) ratio of each class; ``histogram``: texts by class and bin."""
    out = list(FIXED)
    for k, bins in histogram.items():
        at = np.array(sorted(bins))
        upto = np.cumsum([bins[b] for b in at.tolist()])
        if upto[-1] >= FEWEST:
            q1, mid, q3 = (STEP * (int(at[np.searchsorted(upto, q * upto[-1])]) + 0.5) for q in (0.25, 0.5, 0.75))
            below, above = (max(m * (q3 - q1), LEAST * mid) for m in (LOWER, UPPER))
            out[k] = (max(FIXED[k][0], q1 - below), min(FIXED[k][1], q3 + above))
    return tuple(out)


def ratio_bins(docs: DataFrame, text: str = "text") -> DataFrame:
    """class, bin, count of the ratios of a table's distinct texts."""
    # not deterministic, to Spark: else the explode's filter on empty lists is pushed below the function, which then runs twice
    # in each task, in a second Python worker that stays
    ratios = F.pandas_udf(_ratio_batches, "array<array<int>>").asNondeterministic()
    once = docs.select(F.xxhash64(utf8(text)).alias("text_hash"), ratios(utf8(text)).alias("ratios")).dropDuplicates(["text_hash", "ratios"])
    return once.select(F.explode("ratios").alias("r")).groupBy(F.col("r")[0].alias("class"), F.col("r")[1].alias("bin")).count()


def limits_of(docs: DataFrame, text: str = "text") -> tuple:
    """The limits of a table; copies of a text count once.  The driver gets 10,000 bins of a class at most."""
    histogram: dict[int, dict[int, int]] = {}
    for k, b, n in ratio_bins(docs, text).collect():
        histogram.setdefault(k, {})[b] = n
    return limits_from(histogram)


def judge(text: bytes, zstd: zstandard.ZstdCompressor, limits=FIXED) -> tuple:
    words = text.split()                     # bytes.split() cuts at ASCII white space only
    n = len(words)
    chars = len(text.decode("utf-8", "replace")) - sum(text.count(bytes([s])) for s in SPACES)
    symbols = sum(text.count(bytes([s])) for s in SYMBOLS)
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    dup = len(lines) - len(set(lines))
    rep = repeated_words(words)
    failed = n < MIN_WORDS or 100 * rep > MAX_REPEATED * n
    if not text:
        return n, chars, symbols, dup, rep, failed, 0.0, 0, 0, "empty", False
    packed = len(zstd.compress(text))
    whole = in_band(len(text), packed, limits)
    chunks = chunks_of(text)
    sides = [in_band(len(c), len(zstd.compress(c)), limits, chunk=True) for c in chunks]
    bad = sum(s != 0 for s in sides)
    verdict = "ok"
    if whole:
        verdict = "repetitive" if whole > 0 else "incompressible"
    elif bad > MAX_BAD_CHUNKS * len(chunks):
        verdict = "repetitive chunks" if sum(sides) > 0 else "incompressible chunks"
    return n, chars, symbols, dup, rep, failed, len(text) / packed, len(chunks), bad, verdict, not failed and verdict == "ok"


def _judged(limits):
    def judge_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        zstd = zstandard.ZstdCompressor(level=LEVEL)
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for texts in batches:
            yield pd.DataFrame([judge(t, zstd, limits) for t in texts], columns=names)
        spent()
    return F.pandas_udf(judge_batches, SCHEMA)


def compression_quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` as a struct ``row`` beside its ``quality`` measures; the texts are read twice, only their hashes and ratios are shuffled."""
    ship_package(docs.sparkSession)
    measured = _judged(limits_of(docs, text))
    return docs.select(F.struct("*").alias("row"), measured(utf8(text)).alias("quality"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text passes the base rules and the compression bands."""
    return compression_quality(docs).where("quality.kept").select("row.*")
