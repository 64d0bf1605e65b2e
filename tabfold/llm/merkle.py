"""Merkle manifest of a table: a tree a group, a tree over the groups' roots, a proof a row.

A row's leaf is the SHA-256 of its fields; leaves of a group stand in order of
their key.  Every level is one equijoin of the nodes with themselves: a node
asks for the nodes at its siblings' indices, which are computed (its own index
XOR 1 in a binary tree, the run's first index plus a shifted slot in a wider
one).  What it finds, in order, is its step of a proof; the nodes in slot zero
emit their run's parent, and the next level starts from these.  A group is
done when one node remains; the groups' roots, in order, are the leaves of the
tree over them.

Proofs go the other way: from the root down, each node prepends its step to
its parent's path, so the upper steps are joined once a node and not once a
row.  All keys are (group, index): unique or shared by ``arity`` rows at most,
whatever the size of a group.

Numbering does not gather a group: rows are dealt to ranges of (group, key),
numbered within a range, and ranges start where the ones before them end.
Levels are written to the shared folder; their number is the logarithm of the
largest group.

Defined cases: a null field is ``-``, a null group comes first; null keys come
first in their group; rows that share a key are ordered by leaf, rows alike in
every field are interchangeable and each has its proof; a lone leaf is its
group's root and has no siblings; a table without rows gives no rows; other
columns are never read; texts of any length are hashed in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabfold.llm.common import stash

ARITY = 8
RANGE_ROWS = 50_000           # rows of a range that one task numbers, about
NO_PATH = "array<struct<before:binary,after:binary>>"


def field(value: Column) -> Column:
    """``-`` if null, else its UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """The digest (binary) of a row with these fields."""
    return F.unhex(F.sha2(F.encode(F.concat(*[field(v) for v in values]), "UTF-8"), 256))


def hexed(digest: Column) -> Column:
    """Lower-case hex text of one or more digests."""
    return F.lower(F.hex(digest))


def _hashed(digests: Column) -> Column:
    return F.unhex(F.sha2(F.encode(hexed(digests), "UTF-8"), 256))


def fold(start: Column, path: Column) -> Column:
    """The root that ``start`` and the siblings of ``path`` make."""
    return F.aggregate(path, start, lambda node, step: _hashed(F.concat(step["before"], node, step["after"])))


def proof_digest(path: Column) -> Column:
    """H (hex) of all siblings of ``path``, level by level, left to right."""
    joined = F.array_join(F.transform(path, lambda s: F.concat(hexed(s["before"]), hexed(s["after"]))), "")
    return F.sha2(F.encode(joined, "UTF-8"), 256)


def numbered(rows: DataFrame, group: str, order: list[str], n_rows: int, name: str) -> DataFrame:
    """``rows`` with ``at`` (from 0 within the group, by ``order``) and ``n`` (rows of the group), written."""
    ties = rows.withColumn("_row", F.monotonically_increasing_id())       # ranges may part rows alike in all of ``order``
    ranges = max(1, -(-n_rows // RANGE_ROWS))
    dealt = stash(ties.repartitionByRange(ranges, group, *order, "_row").withColumn("_range", F.spark_partition_id()), name + "-ranges")
    counts = dealt.groupBy(group, "_range").agg(F.count("*").alias("c"))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(group).alias("_group"), F.col("_range").alias("_part"), F.coalesce(F.sum("c").over(before), F.lit(0)).alias("_first"),
                           F.sum("c").over(Window.partitionBy(group)).alias("n"))
    own = Window.partitionBy("_range", group).orderBy(*order, "_row")
    placed = (dealt.withColumn("at", F.row_number().over(own).cast("long") - 1)
              .join(starts, (F.col(group) == F.col("_group")) & (F.col("_range") == F.col("_part")))
              .withColumn("at", F.col("at") + F.col("_first")))
    return stash(placed.drop("_row", "_range", "_group", "_part", "_first"), name + "-numbered")


def _sibling(shift: Column, arity: int) -> Column:
    if arity == 2:
        return F.col("at").bitwiseXOR(shift)
    slot = F.col("at") % arity
    return F.col("at") - slot + (slot + shift) % arity


def _level(nodes: DataFrame, arity: int) -> DataFrame:
    """(group, at, n, digest, before, after) of the nodes that have not come down to one."""
    active = nodes.where("n > 1").select("group", "at", "n", "digest")
    asks = (active.select("group", "at", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(arity - 1).cast("long"))).alias("shift"))
            .withColumn("sibling", _sibling(F.col("shift"), arity)).where("sibling < n"))
    held = active.select(F.col("group").alias("_group"), F.col("at").alias("_at"), "digest")
    runs = (asks.join(held, (F.col("group") == F.col("_group")) & (F.col("sibling") == F.col("_at")))
            .groupBy("group", "at", "n").agg(F.array_sort(F.collect_list(F.struct("sibling", "digest"))).alias("run")))
    joined = lambda keep: F.aggregate(F.filter("run", keep), F.lit(b""), lambda a, x: F.concat(a, x["digest"]))
    own = F.get(F.filter("run", lambda x: x["sibling"] == F.col("at")), F.lit(0))["digest"]
    return runs.select("group", "at", "n", own.alias("digest"), joined(lambda x: x["sibling"] < F.col("at")).alias("before"),
                       joined(lambda x: x["sibling"] > F.col("at")).alias("after"))


def _parents(level: DataFrame, arity: int) -> DataFrame:
    """The node above each run, from the run's slot zero."""
    return level.where(F.col("at") % arity == 0).select(
        "group", F.expr(f"at div {arity}").alias("at"), F.ceil(F.col("n") / arity).alias("n"),
        _hashed(F.concat("before", "digest", "after")).alias("digest"))


def _tree(leaves: DataFrame, largest: int, arity: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Written levels, lowest first, and (group, level, digest) of each group's root."""
    nodes, levels = leaves.select("group", "at", "n", "digest"), []
    root_at = lambda k: nodes.where("n = 1").select("group", F.lit(k).alias("level"), "digest")
    roots = root_at(0)
    while largest > 1:
        levels.append(stash(_level(nodes, arity), f"{name}-level-{len(levels)}"))
        nodes, largest = _parents(levels[-1], arity), -(-largest // arity)
        roots = roots.unionByName(root_at(len(levels)))
    return levels, stash(roots, name + "-roots")


def _paths(levels: list[DataFrame], tops: DataFrame, leaves: DataFrame, arity: int) -> DataFrame:
    """``leaves`` (group, at and more) with the path of each and what ``tops`` has.

    ``tops`` has a row a group: level of its root, the path from there on, and more columns.
    """
    more = [c for c in tops.columns if c not in ("group", "level", "path")]
    kept = [c for c in leaves.columns if c not in ("group", "at")]
    own = leaves.select(F.col("group").alias("_own"), F.col("at").alias("_place"), *kept)

    def at_leaf(nodes: DataFrame) -> DataFrame:          # narrow rows meet here, before the long paths come
        return nodes.join(own, (F.col("group") == F.col("_own")) & (F.col("at") == F.col("_place"))).drop("_own", "_place")

    def ends(k: int) -> DataFrame:
        found = tops.where(F.col("level") == k).select("group", F.lit(0).cast("long").alias("at"), "path", *more)
        return found if k else at_leaf(found)
    info = ends(len(levels))
    for k in reversed(range(len(levels))):
        above = info.select(F.col("group").alias("_group"), F.col("at").alias("_at"), F.col("path").alias("_path"), *more)
        nodes = levels[k].select("group", "at", F.array(F.struct("before", "after")).alias("step"))
        info = ((nodes if k else at_leaf(nodes))
                .join(above, (F.col("group") == F.col("_group")) & (F.expr(f"at div {arity}") == F.col("_at")))
                .select("group", "at", F.concat("step", "_path").alias("path"), *more, *([] if k else kept))
                .unionByName(ends(k)))
    return info


def manifest(docs: DataFrame, fields: list[str], group: str, key: str, arity: int = ARITY,
             carried: dict[str, Column] | None = None) -> DataFrame:
    """key, leaf, subroot, root (binary digests), path of every row, and ``carried`` columns.

    ``path`` lists the siblings to the left and to the right from the leaf to
    the root of all; ``fold(leaf, path)`` is the root.
    """
    carried = carried or {}
    rows = docs.select(F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0")).alias("group"),
                       F.col(key).alias("_key"), leaf(*[F.col(c) for c in fields]).alias("digest"),
                       *[value.alias("_c_" + name) for name, value in carried.items()])
    rows = stash(rows, "merkle-leaves")
    leaves = numbered(rows, "group", ["_key", "digest"], rows.count(), "merkle-leaves")
    largest = leaves.agg(F.max("n")).first()[0] or 0
    levels, roots = _tree(leaves, largest, arity, "merkle")
    # the tree over the groups' roots
    subroots = numbered(roots.select(F.lit("").alias("group"), F.col("group").alias("of"), "level", "digest"),
                        "group", ["of"], roots.count(), "merkle-groups")
    upper, top = _tree(subroots, subroots.count(), arity, "merkle-groups")
    last = top.select("group", "level", F.array().cast(NO_PATH).alias("path"), F.col("digest").alias("root"))
    groups = subroots.select("group", "at", "of", F.col("level").alias("of_level"), F.col("digest").alias("subroot"))
    tops = stash(_paths(upper, last, groups, arity)
                 .select(F.col("of").alias("group"), F.col("of_level").alias("level"), "path", "subroot", "root"), "merkle-tops")
    kept = leaves.select("group", "at", "_key", F.col("digest").alias("leaf"), *[F.col("_c_" + name) for name in carried])
    return (_paths(levels, tops, kept, arity)
            .select(F.col("_key").alias(key), "leaf", "subroot", "root", "path", *[F.col("_c_" + name).alias(name) for name in carried]))
