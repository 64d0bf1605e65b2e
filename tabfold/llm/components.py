"""Connected components of a table of links, by alternating large and small stars.

Each round replaces links by links to the smallest neighbour, in two grouped
joins; rounds are written to the shared folder.  Only a count and two sums of
64-bit hashes come to the driver.  A node with very many links is one hot key
of a join whose other side has one row for it; that side is written first, as
Spark splits a hot key only between two plain exchanges.

Defined cases: links of a node with itself, repeated links and links in either
direction count once; nulls are no nodes; a table without links gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabfold.llm.common import stash


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (u, v) both ways -> links (larger, smallest neighbour)."""
    if large:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = stash(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")), "least", "snappy")
    joined = both.join(least, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node that each linked node reaches; nodes without links are absent."""
    now = stash(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u") != F.col("v")).distinct(), "links", "snappy")
    told = lambda *c: F.sum(F.xxhash64(*c).cast("decimal(38,0)"))
    state = None
    while True:
        now = stash(_star(_star(now, True), False), "links", "snappy")
        seen = now.agg(F.count("*"), told("u", "v"), told("v")).first()
        if seen == state:
            break
        state = seen
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())
