"""Byte-balanced sharding by histogram sort, in DataFrame operations only.

Every row gets a 62-bit sort key: 38 bits of its text's hash, then 24 bits of
its id's hash, so equal texts lie side by side and yet a text that holds a
third of all rows can be cut.  Candidate key boundaries (probes) are the edges
of equal slices of key space.  One aggregation counts the exact bytes and rows
of each slice; the slice that holds a wanted split point is probed again with
finer slices, until each splitter's bytes are within its tolerance.  Only then
the rows move, once, to their range, where they are numbered.

Every shard is made of one or more ranges (about ``RANGE_ROWS`` rows each), so
no task numbers a whole shard.  The driver holds at most ``MAX_CELLS`` counts
at a time, whatever the number of rows.

Defined cases: a null text has size 1 and counts as the empty text; a null id
hashes to a constant; rows alike in text and id share a key and stay together
(a boundary never falls among them); a table without rows gives no rows; other
columns are never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabfold.llm.common import stash, text_or_empty

KEY_BITS, ID_BITS, COARSE = 62, 24, 12
RANGE_ROWS = 100_000           # rows of a range, about
MAX_RANGES = 4096              # of a shard
MAX_CELLS = 65_536             # counts that one round of probes may return
SHARD_TOLERANCE = 0.001        # of a shard's ideal bytes
RANGE_TOLERANCE = 0.1          # of a range's ideal bytes


def with_keys(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and the sort key ``at`` of every row."""
    mask = (1 << ID_BITS) - 1
    high = F.shiftrightunsigned(F.xxhash64(text_or_empty(text)), 64 - KEY_BITS).bitwiseAND(F.lit(~mask))
    low = F.xxhash64(F.col(key)).bitwiseAND(F.lit(mask))
    body = text_or_empty(text)
    return docs.select(F.col(key).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"), high.bitwiseOR(low).alias("at"))


def find_splitters(keyed: DataFrame, targets: list[tuple[int, float]]) -> list[tuple[int, int, int]]:
    """(key, bytes below, rows below) for each (wanted bytes below, tolerance).

    ``keyed`` has ``at`` and ``size``.  Each round counts exactly, over all
    rows, the bytes below the edges of the slices that still hold a split point.
    """
    found: dict[int, tuple[int, int, int]] = {}
    #: target -> (slice, bytes below it, rows below it); slices are 2**shift keys wide
    open_ = {i: (0, 0, 0) for i in range(len(targets))}
    shift = KEY_BITS
    while open_:
        cells = sorted({c for c, _, _ in open_.values()})
        bits = min(shift, COARSE if shift == KEY_BITS else max(1, (MAX_CELLS // len(cells)).bit_length() - 1))
        finer = shift - bits
        inside = keyed if shift == KEY_BITS else keyed.where(F.shiftright("at", shift).isin(cells))
        counts = sorted(tuple(r) for r in inside.groupBy(F.shiftright("at", finer).alias("probe"))
                        .agg(F.sum("size"), F.count("*")).collect())
        by_cell: dict[int, list] = {}
        for probe, size, rows in counts:
            by_cell.setdefault(probe >> bits, []).append((probe, size, rows))
        still = {}
        for i, (cell, below, rows_below) in open_.items():
            want, tolerance = targets[i]
            at = (cell << bits, below, rows_below)              # the last edge not above the target
            for probe, size, rows in by_cell.get(cell, []):
                low, high = (probe, below, rows_below), (probe + 1, below + size, rows_below + rows)
                at = low
                if high[1] > want:
                    best = min(low, high, key=lambda e: abs(e[1] - want))
                    if abs(best[1] - want) > tolerance and finer:
                        still[i], at = (probe, below, rows_below), None
                    else:
                        at = best
                    break
                at, below, rows_below = high, high[1], high[2]
            if at is not None:
                found[i] = (at[0] << finer, at[1], at[2])
        open_, shift = still, finer
    return [found[i] for i in range(len(targets))]


def histogram_sort(keyed: DataFrame, shards: int) -> DataFrame:
    """``keyed`` (at, size, doc_id and more) with ``shard`` and ``slot``: sorted, nearly equal in bytes."""
    spark = keyed.sparkSession
    n, total = keyed.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    per = min(MAX_RANGES, max(1, -(-n // (shards * RANGE_ROWS))))
    ideal = total / (shards * per)
    targets = [(round(i * ideal), ideal * per * SHARD_TOLERANCE if i % per == 0 else ideal * RANGE_TOLERANCE)
               for i in range(1, shards * per)]
    cuts = [(0, 0, 0)]
    for c in find_splitters(keyed, targets):
        cuts.append(max(c, cuts[-1]))
    ends = [c[0] for c in cuts[1:]] + [1 << KEY_BITS]
    width = KEY_BITS - COARSE
    ranges = []                                    # a range in each coarse slice that it meets
    for i, ((lo, _, rows), hi) in enumerate(zip(cuts, ends)):
        first_of_shard = cuts[i - i % per][2]
        for cell in range(lo >> width, ((hi - 1) >> width) + 1 if hi > lo else lo >> width):
            ranges.append((cell, lo, hi, i, i // per, rows - first_of_shard))
    near = spark.createDataFrame(ranges, "cell long, lo long, hi long, part int, shard int, slots_before long")
    # at most 2**COARSE + shards * MAX_RANGES narrow rows, so a broadcast is safe
    dealt = keyed.join(F.broadcast(near), (F.shiftright(keyed["at"], width) == near["cell"])
                       & (keyed["at"] >= near["lo"]) & (keyed["at"] < near["hi"]))
    order = Window.partitionBy("part").orderBy("at", "doc_id", "size")
    return (dealt.withColumn("slot", F.col("slots_before") + F.row_number().over(order) - 1)
            .drop("cell", "lo", "hi", "part", "slots_before"))


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of ``docs``."""
    keyed = stash(with_keys(docs), "shard-keys")     # narrow: texts are read once, for all rounds
    return histogram_sort(keyed, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        "slot", F.lit(None).cast("int").alias("grown_shard"))
