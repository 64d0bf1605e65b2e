"""Near-duplicate documents: MinHash bands, odd sketches, exact confirmation.

1. A document's set is that of its 5-word shingles (64-bit hashes).  128
   MinHash samples are taken; some of them make bands of 4, and all are folded
   into an odd sketch: each sample flips one of 512 bits.  Documents with equal
   sets are one class from here on.
2. Classes that share a band meet in a bucket.  The XOR of two odd sketches
   counts the samples that differ, which is precise for high similarities:
   pairs within ``max_xor`` bits are candidates.  A bucket returns a spanning
   forest of its candidate pairs, never all of them.
3. Connected candidates are a family.  Sets are gathered once, by family, and
   every pair that the forest does not join yet is confirmed on the full sets.
   Confirmed links are joined to components.

Buckets and families above a block's size are met block by block (each pair of
blocks in a task of its own), so no task holds an unbounded group and no pair
is skipped.  Bands and ``max_xor`` follow from the similarity asked for (85
percent for the query, any from 75 to 99): 16 bands and 72 bits at 85, 22 bands
and 84 bits at 80.  At exactly that similarity a link is missed with a
probability of about 0.00001 (``MISSED``, and a quarter of it for the sketch).

Defined cases: texts that are null or hold no word are linked with nothing;
rows with a null id are returned with a null component and are kept; rows that
share an id count as one document; repeated rows are returned each; a table
without rows gives no rows; other columns are never read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabfold.llm.common import Remembered, few_bytes, ship_package, spent, stash, utf8
from tabfold.llm.components import components

WIDTH = 5                   # words of a shingle
SIMILARITY = 85             # percent, of the query
SAMPLES, ROWS = 128, 4      # samples, and those of a band
BITS = 512                  # of an odd sketch
MISSED = 1e-5               # probability that a link at the very limit shares no band
BUCKET_BLOCK = 2048         # classes of a bucket that meet in a task
FAMILY_BLOCK = 1_000_000    # shingles of a family that meet in a task
REMEMBERED = 50_000         # words whose hashes a worker remembers (twice as many at most: 12 MB)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _scatter(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


_FACTORS = _scatter(np.arange(1, SAMPLES + 1, dtype=np.uint64) * _MIX) | np.uint64(1)
_SHIFTS = _scatter(np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def word_hashes() -> Remembered:
    """64-bit hashes of words."""
    return Remembered(xxhash.xxh3_64_intdigest, REMEMBERED)


def shingles(text: bytes, hashes: Remembered, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the text's ``width``-word shingles (of all its words, if fewer)."""
    words = text.lower().split()             # bytes: only A-Z change, only ASCII white space cuts
    if not words:
        return np.empty(0, np.uint64)
    code = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    h = np.full(n, np.uint64(min(width, len(words))))
    for k in range(min(width, len(words))):
        h = _scatter(h * _MIX + code[k:n + k])
    return np.unique(h)


def min_hashes(s: np.ndarray) -> np.ndarray:
    low = np.full(SAMPLES, np.uint64(0xFFFFFFFFFFFFFFFF))
    for i in range(0, len(s), 1024):
        np.minimum(low, (s[None, i:i + 1024] * _FACTORS[:, None] + _SHIFTS[:, None]).min(axis=1), out=low)
    return low


def odd_sketch(samples: np.ndarray) -> bytes:
    """Each sample, with its number, flips a bit."""
    at = _scatter(samples + _SHIFTS) % np.uint64(BITS)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=BITS) & 1).tobytes()


def n_bands(percent: int) -> int:
    """Bands with which a link at ``percent`` is missed with a probability of ``MISSED`` at most."""
    bands = math.ceil(math.log(MISSED) / math.log(1 - (percent / 100) ** ROWS)) if 0 < percent < 100 else 1
    if not 0 < percent <= 100 or bands * ROWS > SAMPLES:
        raise ValueError(f"a similarity of {percent} percent needs more than {SAMPLES} samples")
    return bands


@functools.lru_cache
def max_xor(percent: int) -> int:
    """Differing bits within which a pair at ``percent`` stays but for a probability of ``MISSED / 4``."""
    differ, at = 1 - percent / 100, np.arange(BITS + 1)
    bits, now = np.zeros(BITS + 1), np.eye(1, BITS + 1)[0]       # chances of each number of odd bits
    for d in range(SAMPLES + 1):
        bits += math.comb(SAMPLES, d) * differ ** d * (1 - differ) ** (SAMPLES - d) * now
        for _ in range(2):                    # a sample that differs flips a bit of either sketch
            now = np.append(0, (now * (1 - at / BITS))[:-1]) + np.append((now * at / BITS)[1:], 0)
    beyond = np.cumsum(bits[::-1])[::-1]      # chance of k bits or more
    return 2 * ((int(np.argmax(beyond <= MISSED / 4)) - 1) // 2)      # an even number of bits differs


def band_keys(samples: np.ndarray, bands: int) -> np.ndarray:
    h = np.arange(bands, dtype=np.uint64)
    for r in range(ROWS):
        h = _scatter(h * _MIX + samples[r * bands:(r + 1) * bands])
    return h.view(np.int64)


def _signatures(bands: int):
    def signed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = word_hashes()
        for texts in batches:
            rows = []
            for t in texts:
                s = shingles(t, hashes)
                if len(s):
                    m = min_hashes(s)
                    rows.append((len(s), xxhash.xxh3_128_digest(s.tobytes()), odd_sketch(m), band_keys(m, bands)))
                else:
                    rows.append((0, b"", b"", np.empty(0, np.int64)))
            yield pd.DataFrame(rows, columns=["n", "set_id", "sketch", "bands"])
        hashes.forget()
        spent()
    return F.pandas_udf(signed, "n long, set_id binary, sketch binary, bands array<long>")


def _sets_of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    hashes = word_hashes()
    for texts in batches:
        sets = [shingles(t, hashes).tobytes() for t in texts]
        yield pd.DataFrame({"body": sets, "set_id": [xxhash.xxh3_128_digest(s) for s in sets]})
        del sets
    hashes.forget()
    spent()


def _forest(n: int, near) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest; ``near(i, others)`` tells which of ``others`` are linked with i."""
    rest = np.arange(n)
    while len(rest):
        todo, rest = [int(rest[0])], rest[1:]
        while todo and len(rest):
            i = todo.pop()
            hit = near(i, rest)
            for j in rest[hit].tolist():
                yield i, j
                todo.append(j)
            rest = rest[~hit]


def sketch_edges(sketches: np.ndarray, most: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs within ``most`` differing bits; a row of 64-bit words for each sketch."""
    return list(_forest(len(sketches), lambda i, others: np.bitwise_count(sketches[others] ^ sketches[i]).sum(1) <= most))


def set_edges(sets: list[np.ndarray], percent: int = SIMILARITY) -> list[tuple[int, int]]:
    """A spanning forest of the pairs with 100 * intersection >= percent * union, on the full sets."""
    if len(sets) == 1:
        return []
    sizes = np.array([len(s) for s in sets])
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    mark = np.zeros(int(code.max()) + 1, bool)

    def near(i: int, others: np.ndarray) -> np.ndarray:
        small, large = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        out = 100 * small >= percent * large              # the sizes alone may rule a pair out
        if (some := others[out]).size:
            own = code[starts[i]:starts[i + 1]]
            mark[own] = True
            at = np.concatenate([code[starts[j]:starts[j + 1]] for j in some.tolist()])
            common = np.add.reduceat(mark[at].astype(np.int64), np.concatenate([[0], np.cumsum(sizes[some])[:-1]]))
            mark[own] = False
            out[out] = 100 * common >= percent * (sizes[some] + sizes[i] - common)
        return out
    return list(_forest(len(sets), near))


def _by_group(keys: list[str], edges_of, columns: list[str]):
    """For rows that arrive sorted by ``keys``: the edges of each group, as pairs of ``node``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def finished(frame: pd.DataFrame) -> pd.DataFrame:
            values = [frame[k].to_numpy() for k in keys]
            new = np.ones(len(frame), bool)
            new[1:] = np.logical_or.reduce([v[1:] != v[:-1] for v in values])
            at = np.append(np.flatnonzero(new), len(frame))
            node, out = frame["node"].to_numpy(), []
            data = edges_of(frame[columns])
            for lo, hi in zip(at[:-1], at[1:]):
                if hi - lo > 1:
                    out += [(node[lo + i], node[lo + j]) for i, j in data(lo, hi)]
            return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

        rest = None
        for batch in batches:
            frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if len(frame):
                last = np.logical_and.reduce([(frame[k] == frame[k].iloc[-1]).to_numpy() for k in keys])
                cut = int(np.argmax(last))                # the last group may go on in the next batch
                if cut:
                    yield finished(frame.iloc[:cut])
                rest = frame.iloc[cut:]
        if rest is not None:
            yield finished(rest)
        del rest
        spent()
    return run


def _sketches(most: int):
    def data(frame: pd.DataFrame):
        words = np.frombuffer(b"".join(frame["sketch"]), np.uint64).reshape(len(frame), BITS // 64)
        return lambda lo, hi: sketch_edges(words[lo:hi], most)
    return data


def _sets(percent: int):
    def data(frame: pd.DataFrame):
        sets = [np.frombuffer(b, np.uint64) for b in frame["body"]]
        return lambda lo, hi: set_edges(sets[lo:hi], percent)
    return data


def meet(rows: DataFrame, key: str, weight, limit: int, edges_of, data: str) -> DataFrame:
    """Edges (a, b) among the rows that share ``key``.

    The keys' weights are summed first.  Keys of up to ``limit`` meet as they
    are.  The others, at most one for each ``limit`` of the whole weight, are
    cut into blocks by a hash of the row, and every pair of blocks is a group,
    to which the rows of both are sent: no task holds the rows of a heavy key.
    """
    spark_cols = ["node", data]
    heavy = stash(rows.groupBy(F.col(key).alias("_key")).agg(F.ceil(F.sum(weight) / limit).alias("_blocks")).where("_blocks > 1"), "heavy-keys")
    some = few_bytes(heavy, F.lit(32))
    light = rows.select(key, *spark_cols).join(some, F.col(key) == F.col("_key"), "left_anti")
    shared = light.withColumn("_rows", F.count("*").over(Window.partitionBy(key))).where("_rows > 1").select(key, *spark_cols)
    met = shared.sortWithinPartitions(key).mapInPandas(_by_group([key], edges_of, [data]), "a long, b long")
    # pairs of blocks (i, j), i <= j: a row of block k goes to those with k in them
    own = F.pmod(F.xxhash64("node"), F.col("_blocks"))
    pairs = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1),
                                  lambda j: F.struct(F.least(j, F.col("_block")).alias("i"), F.greatest(j, F.col("_block")).alias("j"))))
    many = (rows.select(key, *spark_cols).join(some, F.col(key) == F.col("_key")).withColumn("_block", own)
            .select(key, *spark_cols, pairs.alias("_pair")).select(key, *spark_cols, "_pair.*")
            .repartition(key, "i", "j").sortWithinPartitions(key, "i", "j"))
    return met.unionByName(many.mapInPandas(_by_group([key, "i", "j"], edges_of, [data]), "a long, b long"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row; texts of a similarity of ``percent`` or more are linked."""
    ship_package(docs.sparkSession)
    signed = _signatures(n_bands(percent))
    rows = stash(docs.select(F.col(key).cast("long").alias("doc_id"), signed(utf8(text)).alias("s")).select("doc_id", "s.*"), "signatures")
    links = confirmed_links(docs, rows, key, text, percent)
    found = components(links, "a", "b")
    out = (rows.select("doc_id", F.col("n").alias("n_shingles"), "set_id")
           .join(found, F.col("doc_id") == F.col("node"), "left")
           .withColumn("component_id", F.coalesce("component", "doc_id")))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group; others go."""
    gone = stash(near_duplicates(docs, key, text, percent).where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct(), "near-copies")
    return docs.join(few_bytes(gone, F.lit(32)), docs[key] == F.col("_gone"), "left_anti")


def _bodies(some: DataFrame) -> DataFrame:
    """The sets of documents with a family, made again from their texts."""
    # not deterministic, to Spark: else the filter on the set's id is pushed below the function, which then runs twice in each task
    sets = F.pandas_udf(_sets_of, "body binary, set_id binary").asNondeterministic()
    # rows that share an id may differ in text: those of the class that the id stands for are compared
    return (some.select("node", "set_id", "component", sets("text_bytes").alias("s")).where("set_id = s.set_id")
            .select("node", "set_id", "component", "s.body").dropDuplicates(["node", "set_id"])
            .withColumn("n", F.octet_length("body") / 8))


def confirmed_links(docs: DataFrame, rows: DataFrame, key: str, text: str, percent: int = SIMILARITY) -> DataFrame:
    """Links (a, b) between ids whose transitive closure joins all similar documents."""
    linkable = rows.where("n > 0 AND doc_id IS NOT NULL")
    # one row a class of equal sets; its members are linked to the smallest id
    classes = stash(linkable.groupBy("set_id").agg(F.min(F.struct("doc_id", "n", "sketch", "bands")).alias("c"))
                    .select("set_id", F.col("c.doc_id").alias("node"), "c.n", "c.sketch", "c.bands"), "classes")
    copies = (linkable.select("set_id", "doc_id").join(classes.select("set_id", "node"), "set_id")
              .where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
    bucketed = classes.select("node", "sketch", F.explode("bands").alias("bucket"))
    candidates = stash(meet(bucketed, "bucket", F.lit(1), BUCKET_BLOCK, _sketches(max_xor(percent)), "sketch").distinct(), "candidates", "snappy")
    family = stash(components(candidates, "a", "b"), "families", "snappy")
    wanted = classes.select("node", "set_id").join(family, "node")
    source = docs.select(F.col(key).cast("long").alias("node"), utf8(text).alias("text_bytes"))
    bodies = _bodies(source.join(few_bytes(wanted, F.lit(64)), "node"))
    links = meet(bodies, "component", F.col("n"), FAMILY_BLOCK, _sets(percent), "body")
    return copies.unionByName(links)
