"""Removal of long repeated byte strings with suffix arrays.

A byte goes if some string of ``LENGTH`` bytes that covers it also starts
anywhere else in the corpus.  Strings meet by content: each is filed under the
smallest hash of the 16-byte strings within it, so equal strings share a file,
wherever they stand.  Neighbouring strings mostly share that minimum, so a text
falls into segments of about 90 starts, each filed as a whole.

1. Segments (file, content hash, place) are counted.  A file with one segment
   holds no repeat.  Equal segments are repeats of each other as they stand.
2. Files with different segments get their bytes, one copy of each segment.
   Whole files are gathered into blocks of about 1 MB; a block's suffixes are
   sorted in two stages (``two_stage``) and equal neighbours are repeats.
   Files of more than ``FILE_LIMIT`` different segments (a string within very
   many texts) are settled by counting 128-bit hashes of their strings.
3. Repeats go back to every segment with that content, and to the documents.

Defined cases: a null text counts as the empty text; texts shorter than
``LENGTH`` lose nothing; rows alike in id and text are two documents, so they
lose all bytes that such strings cover; a null id is an id like any other; a
table without rows gives no rows; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabfold.llm.common import ship_package, stash, utf8
from tabfold.llm.two_stage import repeated

LENGTH = 200
GRAM = 16                   # bytes of the strings whose smallest hash files a string
PART = 1 << 20              # bytes of a text that are cut into segments at a time
BLOCK = 1 << 20             # bytes whose suffixes are sorted together, about
FILE_LIMIT = 8192           # different segments of a file that are sorted together (3 MB at most)
_LOW = np.uint64((1 << 21) - 1)


def _scatter(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = _scatter(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEPS = _scatter(np.arange(1, 9, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


def segments(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First start, number of starts, and file of each segment; one 16-byte string files all starts of a segment."""
    x = np.frombuffer(text, np.uint8)
    h, width = _BYTES[x], 1
    while width < GRAM:                                   # hashes of 2, 4, 8, 16 bytes
        h = h[:-width] * _STEPS[width.bit_length()] + h[width:]
        width *= 2
    h = _scatter(h)
    # smallest of each window; of equal hashes the last one, by the place in the low bits
    low = (h & ~_LOW) | (_LOW - np.arange(len(h), dtype=np.uint64))
    window, width = length - GRAM + 1, 1
    while width * 2 <= window:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < window:
        low = np.minimum(low[:len(low) - (window - width)], low[window - width:])
    at = (_LOW - (low & _LOW)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
    count = np.diff(np.append(first, len(at)))
    return first, count, h[at[first]].view(np.int64)


def _segment_rows(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    names = ["file", "content", "start", "n"]
    for texts in batches:
        rows = []
        for t in texts:
            got = {k: [] for k in names}
            for base in range(0, max(0, len(t) - LENGTH + 1), PART):
                part = t[base:base + PART + LENGTH - 1]
                if len(part) < LENGTH:
                    continue
                first, count, file = segments(part)
                got["file"].append(file)
                got["start"].append(first + base)
                got["n"].append(count)
                got["content"].append(np.array([xxhash.xxh3_64_intdigest(part[a:a + c + LENGTH - 1]) for a, c in zip(first.tolist(), count.tolist())],
                                               np.uint64).view(np.int64))
            rows.append(tuple(np.concatenate(v) if v else np.empty(0, np.int64) for v in got.values()))
        yield pd.DataFrame(rows, columns=names)


def _repeats_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (file, content, body) sorted by file -> (file, content, a, b): starts a to b (exclusive) are repeated."""
    def runs(frame: pd.DataFrame) -> pd.DataFrame:
        bodies = frame["body"].tolist()
        sizes = np.array([len(b) for b in bodies])
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        edge = np.zeros(int(sizes.sum()) + 1, np.int32)
        np.add.at(edge, begin, 1)
        np.add.at(edge, begin + sizes - LENGTH + 1, -1)
        hit = repeated(b"".join(bodies), np.cumsum(edge[:-1]) > 0, LENGTH)
        step = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
        a, b = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        # bodies end in LENGTH - 1 bytes that are no starts, so a run never spans two
        own = np.searchsorted(begin, a, "right") - 1
        return pd.DataFrame({"file": frame["file"].to_numpy()[own], "content": frame["content"].to_numpy()[own],
                             "a": a - begin[own], "b": b - begin[own]})
    rest = None
    for batch in batches:
        frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        while len(frame):
            file = frame["file"].to_numpy()
            size = np.cumsum(frame["body"].map(len).to_numpy())
            full = int(np.searchsorted(size, BLOCK))
            ends = np.flatnonzero(file[1:] != file[:-1]) + 1     # a block ends with a file
            ends = ends[ends >= full]
            if full >= len(frame) or not len(ends):
                break
            yield runs(frame.iloc[:ends[0]])
            frame = frame.iloc[ends[0]:].reset_index(drop=True)
        rest = frame
    if rest is not None and len(rest):
        yield runs(rest)


def _string_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for file, content, body in zip(batch["file"], batch["content"], batch["body"]):
            n = len(body) - LENGTH + 1
            yield pd.DataFrame({"file": file, "content": content, "a": np.arange(n),
                                "string": [xxhash.xxh3_128_digest(body[i:i + LENGTH]) for i in range(n)]})


def repeated_ranges(bodies: DataFrame) -> DataFrame:
    """(doc_id, text_hash, ranges) of documents with bytes to remove; ranges (from, to) may overlap.

    ``bodies``: doc_id, text_hash, body.
    """
    cut = F.pandas_udf(_segment_rows, "file array<long>, content array<long>, start array<long>, n array<long>")
    segs = (bodies.where(F.octet_length("body") >= LENGTH).select("doc_id", "text_hash", cut("body").alias("s"))
            .select("doc_id", "text_hash", F.explode(F.arrays_zip("s.file", "s.content", "s.start", "s.n")).alias("z"))
            .select("doc_id", "text_hash", F.col("z.file").alias("file"), F.col("z.content").alias("content"),
                    F.col("z.start").alias("start"), F.col("z.n").cast("int").alias("n")))
    segs = stash(segs, "segments")
    # equal segments are one row from here on; any of them stands for all
    kinds = stash(segs.groupBy("file", "content").agg(
        F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("doc_id", "text_hash", "start", "n")]), "segment-kinds")
    files = kinds.groupBy("file").agg(F.count("*").alias("kinds")).where("kinds > 1")
    mixed = kinds.join(files, "file")
    lists = (mixed.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
             .agg(F.collect_list(F.struct("file", "content", "start", "n", "kinds")).alias("list")))
    pieces = (bodies.join(lists, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
              .select("doc_id", "body", F.explode("list").alias("z"))
              .select("z.file", "z.content", "z.kinds",
                      F.substring("body", F.col("z.start").cast("int") + 1, F.col("z.n") + (LENGTH - 1)).alias("body")))
    # rows alike in id and text give a piece each
    pieces = stash(pieces.dropDuplicates(["file", "content"]), "pieces")
    runs = "file long, content long, a long, b long"
    few = (pieces.where(F.col("kinds") <= FILE_LIMIT).select("file", "content", "body")
           .repartition("file").sortWithinPartitions("file").mapInPandas(_repeats_of, runs))
    strings = (pieces.where(F.col("kinds") > FILE_LIMIT).select("file", "content", "body")
               .mapInPandas(_string_hashes, "file long, content long, a long, string binary"))
    again = strings.groupBy("string").agg(F.count("*").alias("c")).where("c > 1").select("string")
    many = strings.join(again, "string").select("file", "content", "a", (F.col("a") + 1).alias("b"))
    whole = kinds.where("copies > 1").select("file", "content", F.lit(0).cast("long").alias("a"), F.col("n").cast("long").alias("b"))
    # written first: segments that very many documents share are a hot key, which Spark splits only between plain exchanges
    hits = stash(few.unionByName(many).unionByName(whole).groupBy("file", "content")
                 .agg(F.collect_list(F.struct("a", "b")).alias("runs")), "segment-runs")
    return (segs.join(hits, ["file", "content"])
            .select("doc_id", "text_hash", F.explode(F.transform("runs", lambda r: F.struct(
                (F.col("start") + r["a"]).alias("a"), (F.col("start") + r["b"] + (LENGTH - 1)).alias("b")))).alias("r"))
            .groupBy("doc_id", "text_hash").agg(F.collect_list("r").alias("ranges")))


def _kept(bodies: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, ranges in bodies:
        rows = []
        for t, found in zip(texts, ranges):
            out, at, removed, spans = [], 0, 0, 0
            for a, b in sorted((r["a"], r["b"]) for r in (found if found is not None else ())):
                if a > at or not spans:
                    out.append(t[at:a])
                    spans += 1
                    at = a
                if b > at:
                    removed += b - at
                    at = b
            out.append(t[at:])
            rows.append((removed, spans, b"".join(out)))
        yield pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept"])


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes that stay) of every row."""
    ship_package(docs.sparkSession)
    bodies = docs.select(F.col(key).alias("doc_id"), utf8(text).alias("body")).withColumn("text_hash", F.xxhash64("body"))
    ranges = stash(repeated_ranges(bodies), "ranges")
    found = ranges.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "ranges")
    joined = bodies.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    kept = F.pandas_udf(_kept, "n_removed long, n_spans long, kept binary")
    some = joined.where("ranges IS NOT NULL").select("doc_id", F.octet_length("body").cast("long").alias("n_bytes"), kept("body", "ranges").alias("k"))
    none = joined.where("ranges IS NULL").select("doc_id", F.octet_length("body").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
                                                 F.lit(0).cast("long").alias("n_spans"), F.col("body").alias("kept"))
    return some.select("doc_id", "n_bytes", "k.*").unionByName(none)
