"""Line deduplication by the spread of a line over sites, in DataFrame operations only.

1. Each line hash gets a HyperLogLog sketch of the sites it occurs on; sketches
   of a line merge by aggregation, so a line that a third of all documents
   share is one row a task before it is shuffled.
2. Lines whose estimate is clearly above the threshold are boilerplate; those
   near it get an exact count of distinct sites; all others are left alone.
3. Of a boilerplate line the first occurrence (smallest document id, then
   place) stays and all others are removed, so no content is lost altogether.

A line's key is its text without white space at the ends; blank lines are no
lines.  Documents are read three times, but texts are not shuffled while the
table of removed places is small enough to be broadcast.

Defined cases: a null text counts as the empty text; a null site is no site;
a null document id is below all others; rows alike in id and text are one
document and come out alike; a table without rows gives no rows; other columns
are passed through unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabfold.llm.common import few_bytes, let, stash, text_or_empty

MIN_SITES = 10          # distinct sites of a boilerplate line
LOG_K = 12              # sketch registers, base 2: a standard error of 1.6 percent
NEAR = (0.75, 1.5)      # estimates within these shares of the threshold are counted exactly
ENDS = " \t\r\x0b\x0c"


def _body(text: str) -> Column:
    return text_or_empty(text)


def _lines(docs: DataFrame, key: str, text: str, site: str) -> DataFrame:
    """doc_id, text_hash, site, place, and the two hashes of every line that is not blank."""
    line = F.btrim("line", F.lit(ENDS))
    return (docs.select(F.col(key).alias("doc_id"), F.xxhash64(_body(text)).alias("text_hash"), F.col(site).cast("string").alias("site"),
                        F.posexplode(F.split(_body(text), "\n", -1)).alias("place", "line"))
            .withColumn("line", line).where("line <> ''")
            .select("doc_id", "text_hash", "site", "place", F.xxhash64("line").alias("h1"), F.hash("line").alias("h2")))


def boilerplate_places(docs: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source",
                       min_sites: int = MIN_SITES) -> DataFrame:
    """(doc_id, text_hash, removed: places of the lines that go) of the documents that lose lines."""
    lines = _lines(docs, key, text, site)
    spread = (lines.groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LOG_K)).alias("sites"))
              .where(F.col("sites") >= NEAR[0] * min_sites))
    spread = stash(spread, "line-spread")
    found = stash(lines.join(few_bytes(spread, F.lit(40)), ["h1", "h2"]), "spread-lines")
    near = F.col("sites") <= NEAR[1] * min_sites
    exact = (found.where(near).select("h1", "h2", "site").distinct().groupBy("h1", "h2")
             .agg(F.count("site").alias("n")).where(F.col("n") >= min_sites).select("h1", "h2"))
    flagged = spread.where(~near).select("h1", "h2").unionByName(exact)
    first = found.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "place")).alias("first"))
    # written first: a very common line is a hot key, which Spark splits only between plain exchanges
    known = stash(flagged.join(first, ["h1", "h2"]), "spread-first")
    gone = (found.join(few_bytes(known, F.lit(64)), ["h1", "h2"])
            .where(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("place") == F.col("first.place")))))
    return gone.groupBy("doc_id", "text_hash").agg(F.collect_set("place").alias("removed"))


def without_boilerplate(docs: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source",
                        min_sites: int = MIN_SITES) -> DataFrame:
    """``row`` (all columns of ``docs``), ``clean`` (text without the removed lines), ``n_lines``, ``n_removed``."""
    places = stash(boilerplate_places(docs, key, text, site, min_sites), "removed-lines")
    places = places.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "removed")
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("_key"), _body(text).alias("_text"))
    joined = rows.join(few_bytes(places, 40 + 8 * F.size("removed")), F.col("_key").eqNullSafe(F.col("_id")) & (F.xxhash64("_text") == F.col("_hash")), "left")
    split = F.split("_text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("removed"))
    clean = F.when(F.col("removed").isNull(), F.col("_text")).otherwise(
        let(split, lambda lines: F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")))
    return joined.select("row", clean.alias("clean"), F.size(split).cast("long").alias("n_lines"),
                         F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"))
