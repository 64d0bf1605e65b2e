"""Packing tokenised documents into sequences of fixed length by column generation.

A document longer than a sequence gives full sequences of its own; what
remains of it (less than a sequence) is one piece.  The histogram of piece
lengths, in classes of ``GRAIN`` tokens, goes to a cutting-stock program on the
driver (``cutting_stock``), whose size is bounded by the number of classes.
Pieces are then ranked within their class across the cluster, and each
pattern's copies take the next ranks of every class it holds: the sequence is
plain arithmetic on the rank, by a join with a table of at most a few thousand
rows.  Documents that the plan cuts are tokenised again and dealt over the
filler space by their position on one line of tokens.

Defined cases: a null text counts as the empty text, which has the end id only;
rows alike in id and text are packed each; rows with a null id are packed, too;
a table without rows gives no rows; other columns are never read.
"""

from __future__ import annotations

import functools
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabfold.llm.common import Remembered, ship_package, spent, stash, utf8
from tabfold.llm.cutting_stock import cutting_plan

CAPACITY = 4096
GRAIN = 8                  # tokens of a unit
END_ID = 2
WORD_END = b"\xff" * 4     # stands behind the ids of a word, within a batch only
SALT_ROWS = 50_000         # rows ranked by a task, about
SLICE_BYTES = 1 << 20      # of texts that a worker encodes at a time, about: their words are numbered, so they take some 20 times as much
CACHED_WORDS = 100_000     # pieces of words whose ids a worker remembers (twice as many at most within a task: 40 MB)
FEW = 200_000              # cut documents up to which their ids are broadcast

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, place long"


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"       # tasks are the parallelism
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True                       # their strings in a text are ordinary text
    spent()                                              # reading the file took as much again
    return t


#: Letters and digits below U+0180, where lower case and composition need no neighbours.
#: Plain texts may also hold common punctuation above (quotes, dashes, the euro sign).
_LATIN = [chr(c) for c in [*range(0x21, 0x7F), *range(0xA1, 0x180)]]
_LETTER = "".join(re.escape(c) for c in _LATIN if unicodedata.category(c)[0] == "L")
_DIGIT = "".join(re.escape(c) for c in _LATIN if unicodedata.category(c)[0] == "N")
_PLAIN = re.compile("[\t-\r\x20-\x7e\xa1-\u017f\u2010-\u2027\u2030-\u205e\u20ac]*")
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^{_LETTER}{_DIGIT}\t-\r ]+|\n")


def _byte_letters() -> dict[int, str]:
    """A letter for each byte, as byte-level models write them: printable ones stand for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(others)}


class WordIds:
    """Token ids of texts, word by word.

    The tokenizer drops white space and never joins characters across it or
    across its own splitting pattern, so a text's ids are those of its words
    in turn.  Arrow splits a batch of texts at ASCII white space and numbers
    its distinct words; only these are encoded, and their ids are dealt out to
    all places by number.  Words of Latin letters are split here, and their
    pieces, which are remembered, go to the tokenizer's model; other words go
    through the whole tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.pieces = Remembered(self._piece, CACHED_WORDS)
        self.words = Remembered(self._word, CACHED_WORDS // 4)

    def _piece(self, piece: str) -> bytes:
        if piece == "\n":
            return WORD_END
        mapped = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(mapped)])

    def _word(self, word: str) -> bytes:
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _of_words(self, words: pa.Array) -> pa.Array:
        """The ids of each word, as binary values."""
        all_of_them = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.view(pa.large_binary()))
        lines = pc.binary_join(all_of_them, pa.scalar(b"\n", pa.large_binary()))[0].as_py().decode("utf-8", "replace")
        odd = {}
        if not _PLAIN.fullmatch(lines):
            split = lines.split("\n")
            odd = {k: self.words[w] for k, w in enumerate(split) if not _PLAIN.fullmatch(w)}
            lines = "\n".join(["" if k in odd else w for k, w in enumerate(split)])
        ids = np.frombuffer(b"".join(map(self.pieces.__getitem__, _SPLIT.findall(lines.lower() + "\n"))), "<u4")
        end = ids == np.frombuffer(WORD_END, "<u4")
        stops = np.flatnonzero(end)
        offsets = np.concatenate([[0], 4 * (stops - np.arange(len(stops)))])
        found = pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(ids[~end])])
        if odd:
            at = np.arange(len(words))
            at[list(odd)] = len(words) + np.arange(len(odd))
            found = pa.concat_arrays([found, pa.array(list(odd.values()), pa.large_binary())]).take(pa.array(at))
        return found

    def batch(self, texts: Sequence[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, with the end id."""
        end = END_ID.to_bytes(4, "little")
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).view(pa.large_string()))
        words = split.flatten().dictionary_encode()
        if not len(words):
            return [end] * len(texts)
        ids = self._of_words(words.dictionary).take(words.indices)
        _, offsets, data = ids.buffers()
        stops = np.frombuffer(offsets, np.int64)[np.asarray(split.offsets)].tolist()
        data = memoryview(data or b"")
        return [bytes(data[a:b]) + end for a, b in zip(stops, stops[1:])]

    def each(self, texts: Sequence[bytes], most: int = SLICE_BYTES) -> Iterator[bytes]:
        """The ids of each text in turn, encoded in slices of at most ``most`` bytes (or one text)."""
        part, size = [], 0
        for t in texts:
            if part and size + len(t) > most:
                yield from self.batch(part)
                part, size = [], 0
            part.append(t)
            size += len(t)
        if part:
            yield from self.batch(part)

    def __call__(self, text: bytes) -> bytes:
        return self.batch([text])[0]

    def rest(self) -> None:
        """Between tasks only what was used last stays."""
        self.pieces.old.clear()
        self.words.old.clear()


@functools.lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """The encoder of a worker process: what it remembers serves its later tasks, too."""
    return WordIds(path)


def _measure(path: str, capacity: int):
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ids_of, step = word_ids(path), 4 * capacity
        for texts in batches:
            rows = []
            for ids in ids_of.each(texts):
                rows.append((len(ids) // 4, [zlib.crc32(ids[i:i + step]) for i in range(0, len(ids), step)]))
            yield pd.DataFrame(rows, columns=["n", "crcs"])
        ids_of.rest()
        spent()
    return F.pandas_udf(measure, "n long, crcs array<long>")


def measured(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
             capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """doc_id, text hash, tokens, checksums of each whole or last piece, length class of the last piece."""
    rest = F.col("n") % capacity
    return (docs.select(F.col(key).alias("doc_id"), F.xxhash64(utf8(text)).alias("text_hash"),
                        _measure(tokenizer_path, capacity)(utf8(text)).alias("m"))
            .select("doc_id", "text_hash", "m.n", "m.crcs")
            .withColumn("class", F.ceil(rest / grain).cast("int"))
            .withColumn("full", F.floor(F.col("n") / capacity)))


def rank_in_class(rows: DataFrame, n_rows: int) -> tuple[DataFrame, list]:
    """``rows`` with ``rank`` (from 0 within the class) and ``full_before`` (full pieces of the class before it).

    Ranks are numbered within salted slices of a class, so that a class with a
    third of all rows is spread; slices start where the ones before them end.
    """
    salts = max(1, -(-n_rows // SALT_ROWS))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(salts).cast("long")))
    counts = salted.groupBy("class", "salt").agg(F.count("*").alias("c"), F.sum("full").alias("f"))
    before = Window.partitionBy("class").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("class", "salt", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("c0"),
                           F.coalesce(F.sum("f").over(before), F.lit(0)).alias("f0"))
    own = Window.partitionBy("class", "salt").orderBy("doc_id", "text_hash")
    ranked = (salted.withColumn("rank", F.row_number().over(own) - 1)
              .withColumn("full_before", F.sum("full").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("full"))
              .join(starts, ["class", "salt"])
              .withColumn("rank", F.col("rank") + F.col("c0"))
              .withColumn("full_before", F.col("full_before") + F.col("f0")).drop("c0", "f0", "salt"))
    totals = counts.groupBy("class").agg(F.sum("c"), F.sum("f")).collect()      # a row for each class
    return ranked, sorted(tuple(r) for r in totals)


def pack(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
         capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    ship_package(docs.sparkSession)
    spark = docs.sparkSession
    cap = capacity // grain
    rows = stash(measured(docs, tokenizer_path, key, text, capacity, grain), "pack-lengths")
    ranked, totals = rank_in_class(rows, rows.count())
    plan, shred = cutting_plan({c: n for c, n, _ in totals if c}, cap)

    # what each pattern takes of each class, by rank
    taken: dict[int, int] = {}
    slots, sequences, filler = [], 0, 0
    spaces = []                                   # (first filler unit, units a sequence, first sequence)
    for copies, items, fill in plan:
        for c, k in items.items():
            lo = taken.get(c, 0)
            slots.append((c, lo, lo + copies * k, k, sequences))
            taken[c] = lo + copies * k
        if fill:
            spaces.append((filler, fill, sequences))
            filler += fill * copies
        sequences += copies
    cut_at, line = [], 0                          # where each class's cut documents begin on the filler line
    for c, k in sorted(shred.items(), reverse=True):
        cut_at.append((c, taken.get(c, 0), line))
        line += c * k
    spaces.append((filler, cap, sequences))       # beyond the patterns' filler space: whole sequences of filler
    sequences += max(0, -(-(line - filler) // cap))
    full_at, first_full = [], sequences
    for c, _, f in totals:
        full_at.append((c, first_full))
        first_full += f

    by_class = spark.createDataFrame(full_at or [(0, 0)], "class int, full_at long")
    at = ranked.join(F.broadcast(by_class), "class")      # a row for each class
    # full pieces: a sequence each
    full = (at.where("full > 0").select("*", F.posexplode(F.slice("crcs", 1, F.col("full").cast("int"))).alias("i", "crc"))
            .select("doc_id", (F.col("i").cast("long") * capacity).alias("start"), F.lit(capacity).cast("long").alias("length"),
                    F.col("crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"),
                    (F.col("full_at") + F.col("full_before") + F.col("i")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    # last pieces that stay whole; the table has a row for each class of each pattern
    near = spark.createDataFrame(slots or [(-1, 0, 0, 1, 0)], "class int, lo long, hi long, k long, first long")
    last = at.where("class > 0").drop("full_at")
    whole = (last.join(F.broadcast(near), "class").where((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
             .select("doc_id", (F.col("full") * capacity).alias("start"), (F.col("n") % capacity).alias("length"),
                     F.element_at("crcs", -1).alias("ids_crc32"), F.col("n").alias("doc_tokens"),
                     (F.col("first") + F.floor((F.col("rank") - F.col("lo")) / F.col("k"))).alias("sequence_id"),
                     (-F.col("class")).cast("long").alias("place")))
    if shred:
        cuts = spark.createDataFrame(cut_at, "class int, lo long, line_at long")
        cut = (last.join(F.broadcast(cuts), "class").where(F.col("rank") >= F.col("lo"))
               .select("doc_id", "text_hash", (F.col("line_at") + (F.col("rank") - F.col("lo")) * F.col("class")).alias("at")))
        whole = whole.unionByName(_cut_pieces(docs, cut, sum(shred.values()), spaces, tokenizer_path, key, text, capacity, grain))
    order = Window.partitionBy("sequence_id").orderBy("place", "doc_id", "start")
    shared = whole.withColumn("offset", F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length"))
    return full.unionByName(shared.drop("place"))


def _cut_pieces(docs: DataFrame, cut: DataFrame, n_cut: int, spaces: list, path: str, key: str, text: str,
                capacity: int, grain: int) -> DataFrame:
    """Pieces of the documents that are cut: each covers a stretch of the line of filler."""
    starts, units, firsts = (np.array(x) for x in zip(*spaces))

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = word_ids(path)
        for batch in batches:
            out = []
            for doc, ids, places in zip(batch["doc_id"], ids_of.each(batch["body"]), batch["places"]):
                n = len(ids) // 4
                base = n // capacity * capacity
                end = -(-(n - base) // grain)
                for at in places:
                    done = 0
                    while done < end:
                        s = int(np.searchsorted(starts, at + done, "right")) - 1
                        slot = (at + done - int(starts[s])) // int(units[s])
                        stop = int(starts[s]) + (slot + 1) * int(units[s]) - at
                        if s + 1 < len(starts):
                            stop = min(stop, int(starts[s + 1]) - at)
                        a, b = base + done * grain, min(n, base + min(stop, end) * grain)
                        out.append((doc, a, b - a, zlib.crc32(ids[4 * a:4 * b]), n, int(firsts[s]) + slot, int(at + done)))
                        done = stop
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in PIECES.split(", ")])
            yield frame.astype({"doc_id": "Int64"})
        ids_of.rest()
        spent()

    # rows alike in id and text share one tokenised text; every one of their places is dealt
    wanted = cut.groupBy("doc_id", "text_hash").agg(F.collect_list("at").alias("places"))
    if n_cut <= FEW:
        wanted = F.broadcast(wanted)
    body = docs.select(F.col(key).alias("doc"), F.xxhash64(utf8(text)).alias("hash"), utf8(text).alias("body"))
    found = (body.join(wanted, F.col("doc").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash")))
             .groupBy("doc_id", "text_hash").agg(F.first("places").alias("places"), F.first("body").alias("body")))
    return found.select("doc_id", "body", "places").mapInPandas(pieces, PIECES)
