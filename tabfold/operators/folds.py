"""Reproducible splits: hold-out, K-fold, grouped, stratified, stratified-grouped.

Assignments come from a hash of ``seed:key`` (md5), never from ``rand()``,
so a fold does not change when the input is re-partitioned, re-read after
an executor loss, or scanned twice.  The same expression runs in DuckDB:
``('0x' || substr(md5(s), 1, 8))::bigint``.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabfold.session import cut_lineage

# md5 hex digits that define the salt bucket of stratified folds (16^4 buckets)
SALT_HEX_DIGITS = 4
# a group holding more than n / (k * HEAVY_FACTOR) rows is placed explicitly
HEAVY_FACTOR = 64
NULL_KEY = "\u0000null"


def _key_string(key: str | Sequence[str]) -> Column:
    if isinstance(key, str):
        return F.coalesce(F.col(key).cast("string"), F.lit(NULL_KEY))      # nulls are one key of their own
    return F.concat_ws("\u0001", *[F.col(c).cast("string") for c in key])


def key_md5(key: str | Sequence[str], seed: int = 0) -> Column:
    """md5 hex of ``'<seed>:<key>'``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _key_string(key)))


def key_hash32(key: str | Sequence[str], seed: int = 0) -> Column:
    """First 32 bits of the md5 as a non-negative bigint."""
    return F.conv(F.substring(key_md5(key, seed), 1, 8), 16, 10).cast("bigint")


def unit_interval(key: str | Sequence[str], seed: int = 0) -> Column:
    """Deterministic pseudo-uniform value in [0, 1) per key."""
    return key_hash32(key, seed) / F.lit(4294967296.0)


def holdout(df: DataFrame, key: str, test_size: float = 0.25, seed: int = 0,
            col: str = "is_valid") -> DataFrame:
    """Flag ~``test_size`` of the rows as validation rows."""
    return df.withColumn(col, unit_interval(key, seed) < F.lit(float(test_size)))


def kfold(df: DataFrame, key: str | Sequence[str], k: int = 5, seed: int = 0,
          col: str = "fold") -> DataFrame:
    """Shuffled K-fold: fold = hash32(seed:key) mod k.  Narrow (no shuffle)."""
    if k < 2:
        raise ValueError("k must be >= 2")
    return df.withColumn(col, (key_hash32(key, seed) % F.lit(k)).cast("int"))


def group_kfold(df: DataFrame, group: str | Sequence[str], k: int = 5, seed: int = 0,
                col: str = "fold", balanced: bool = False) -> DataFrame:
    """A group never spans folds.

    ``balanced=False``: fold = hash of the group key (narrow, SQL-checkable).
    ``balanced=True`` : heavy groups (at least n/(k*64) rows, so at most k*64
    of them) are placed largest-first on the lightest fold; every light group
    then goes to a fold drawn by its key hash in proportion to the room each
    fold has left below n/k.  Only the group-size aggregate and the bounded
    heavy list reach the driver; the placement table is broadcast.
    """
    hashed = kfold(df, group, k, seed, col)
    if not balanced:
        return hashed
    gcols = [group] if isinstance(group, str) else list(group)
    sizes = df.groupBy(*gcols).agg(F.count(F.lit(1)).alias("_n"))
    n = sizes.agg(F.sum("_n")).first()[0] or 0
    thr = max(1, -(-n // (k * HEAVY_FACTOR)))
    heavy = (sizes.where(F.col("_n") >= thr).orderBy(F.col("_n").desc(), *gcols)
             .limit(k * HEAVY_FACTOR + 1).collect())
    loads = [(0, f) for f in range(k)]
    heapq.heapify(loads)
    rows = []
    for r in heavy:
        load, f = heapq.heappop(loads)
        rows.append(tuple(r[g] for g in gcols) + (f,))
        heapq.heappush(loads, (load + r["_n"], f))
    per_fold = dict((f, load) for load, f in loads)
    room = [max(0.0, n / k - per_fold.get(f, 0)) for f in range(k)]
    tot = sum(room) or float(k)
    room = room if sum(room) else [1.0] * k
    bounds, acc = [], 0.0
    for f in range(k - 1):
        acc += room[f] / tot
        bounds.append(acc)
    u = unit_interval(group, seed)
    light_fold = sum((u >= F.lit(b)).cast("int") for b in bounds) if bounds else F.lit(0)
    # folds with no room are skipped by the cumulative bounds (zero-width intervals)
    out = df.withColumn(col, light_fold.cast("int"))
    if not rows:
        return out
    spark = df.sparkSession
    schema = ", ".join(f"`{g}` {df.schema[g].dataType.simpleString()}" for g in gcols) + ", _heavy_fold int"
    place = spark.createDataFrame(rows, schema)
    place = place.withColumnsRenamed({g: f"_h{i}" for i, g in enumerate(gcols)})
    return (out.join(F.broadcast(place), _same_groups(gcols, "_h"), "left")
               .withColumn(col, F.coalesce(F.col("_heavy_fold"), F.col(col)))
               .drop("_heavy_fold", *[f"_h{i}" for i in range(len(gcols))]))


def _same_groups(gcols: Sequence[str], prefix: str) -> Column:
    """Join condition of group columns with their renamed copies; null groups match."""
    on = F.lit(True)
    for i, g in enumerate(gcols):
        on = on & F.col(g).eqNullSafe(F.col(f"{prefix}{i}"))
    return on


def stratified_kfold(df: DataFrame, key: str | Sequence[str], label: str, k: int = 5, seed: int = 0,
                     col: str = "fold") -> DataFrame:
    """Per-class round robin over a hash order: fold = (rank in class - 1) mod k.

    The rank is ``row_number() over (partition by label order by md5, key)``
    computed without a per-class window: rows are salted by the first
    md5 hex digits (a prefix of the sort key, so the order is unchanged),
    each (class, salt) slice is numbered on its own, and a per-class offset
    from the small (class, salt) count table is added.  A class holding a
    third of all rows is therefore spread over 16^4 tasks.
    """
    h = key_md5(key, seed)
    # null labels form one class of their own, as in SQL's PARTITION BY
    # a null key keeps its row (salt "" sorts before every hex salt)
    salted = (df.withColumn("_h", h).withColumn("_salt", F.coalesce(F.substring("_h", 1, SALT_HEX_DIGITS),
                                                                    F.lit("")))
              .withColumn("_lab", F.coalesce(F.col(label).cast("string"), F.lit("\u0000null"))))
    counts = salted.groupBy("_lab", "_salt").agg(F.count(F.lit(1)).alias("_cnt"))
    # per-class running offset over the bounded (class x 16^4) count table
    w = Window.partitionBy("_lab").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0))).drop("_cnt")
    # the join and the numbering share one hash partitioning on (class, salt)
    keys = [key] if isinstance(key, str) else list(key)
    local = Window.partitionBy("_lab", "_salt").orderBy("_h", *keys)
    return (salted.join(offsets, ["_lab", "_salt"], "inner")
            .withColumn(col, ((F.col("_off") + F.row_number().over(local) - 1) % F.lit(k)).cast("int"))
            .drop("_h", "_salt", "_off", "_lab"))


def dominant_class_group_kfold(df: DataFrame, group: str | Sequence[str], label: str, k: int = 5, seed: int = 0,
                               col: str = "fold") -> DataFrame:
    """Groups stay whole; groups of one dominant class are dealt in turn.  Null is a group like any other.

    Simpler than ``stratified_group_kfold``, which balances every class and the folds' sizes.
    """
    gcols = [group] if isinstance(group, str) else list(group)
    hist = df.groupBy(*dict.fromkeys([*gcols, label])).agg(F.count(F.lit(1)).alias("_n"))
    # most frequent class of the group; ties go to the smallest class
    dominant = (hist.groupBy(*gcols)
                .agg(F.min_by(F.col(label), F.struct(-F.col("_n"), F.col(label))).alias("_dom")))
    gf = stratified_kfold(dominant, group, "_dom", k, seed, col).drop("_dom")
    gf = gf.withColumnsRenamed({g: f"_g{i}" for i, g in enumerate(gcols)})
    return df.join(gf, _same_groups(gcols, "_g"), "left").drop(*[f"_g{i}" for i in range(len(gcols))])


def stratified_group_kfold(df: DataFrame, group: str | Sequence[str], label: str, k: int = 5, seed: int = 0,
                           col: str = "fold") -> DataFrame:
    """Groups stay whole; folds get nearly equal shares of every class.  Null is a group, and a class, like any other.

    Heavy groups (at least n / (k * ``HEAVY_FACTOR``) rows, so at most
    k * ``HEAVY_FACTOR`` of them) are placed one by one, the largest first: on
    the fold where the squares of the classes' deviations from 1 / k of their
    rows, summed over the group's classes, rise least; of several, the one
    with fewer rows, then the smallest.  A light group goes by its most
    frequent class (of several, the smallest): its hash draws a fold in
    proportion to the room that is left for that class.  Only the heavy
    groups' histograms and a row for each of their classes reach the driver.
    """
    gcols = [group] if isinstance(group, str) else list(group)
    spark = df.sparkSession
    own = df.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(gcols)], F.col(label).cast("string").alias("_c"))
    keys = [f"_g{i}" for i in range(len(gcols))]
    hist = own.groupBy(*keys, "_c").agg(F.count(F.lit(1)).alias("_n"))
    # (group, its classes' counts by name, rows): a class is a name here, null among them
    sized = hist.groupBy(*keys).agg(F.sum("_n").alias("_rows"), F.array_sort(F.collect_list(F.struct("_c", "_n"))).alias("_classes"))
    sized = cut_lineage(sized)
    n = sized.agg(F.sum("_rows")).first()[0] or 0
    threshold = max(1, -(-n // (k * HEAVY_FACTOR)))
    heavy = sized.where(F.col("_rows") >= threshold).orderBy(F.col("_rows").desc(), *keys).limit(k * HEAVY_FACTOR).collect()
    met = {c["_c"] for r in heavy for c in r["_classes"]}
    every = sized.select(F.explode("_classes").alias("c")).groupBy("c._c").agg(F.sum("c._n").alias("_all"))
    if met:
        named = F.col("_c").isin([c for c in met if c is not None]) | (F.col("_c").isNull() if None in met else F.lit(False))
        totals = {r["_c"]: r["_all"] for r in every.where(F.coalesce(named, F.lit(False))).collect()}
    else:
        totals = {}
    load: list[dict] = [{} for _ in range(k)]
    sizes, placed = [0] * k, []
    for r in heavy:
        def rise(f: int, counts=r["_classes"]) -> float:
            return sum(((load[f].get(c["_c"], 0) + c["_n"]) / totals[c["_c"]] - 1 / k) ** 2 - (load[f].get(c["_c"], 0) / totals[c["_c"]] - 1 / k) ** 2
                       for c in counts)
        f = min(range(k), key=lambda f: (round(rise(f), 12), sizes[f], f))
        placed.append((*[r[g] for g in keys], f))
        sizes[f] += r["_rows"]
        for c in r["_classes"]:
            load[f][c["_c"]] = load[f].get(c["_c"], 0) + c["_n"]
    # upper ends of the folds' shares of [0, 1) for a light group, by its class; classes without a heavy group have equal room
    rows = []
    for c, total in totals.items():
        room = [max(0.0, total / k - load[f].get(c, 0)) for f in range(k)]
        room = room if sum(room) > 0 else [1.0] * k
        rows.append((c, [sum(room[:f + 1]) / sum(room) for f in range(k - 1)]))
    ends = spark.createDataFrame(rows, "_of string, _ends array<double>")
    equal = F.array(*[F.lit((f + 1) / k) for f in range(k - 1)])
    dominant = F.array_sort(F.transform("_classes", lambda c: F.struct((-c["_n"]).alias("n"), c["_c"].alias("c"))))[0]["c"]
    light = (sized.where(F.col("_rows") < threshold) if len(heavy) < k * HEAVY_FACTOR else sized).withColumn("_dom", dominant)
    drawn = (light.join(ends, F.col("_dom").eqNullSafe(F.col("_of")), "left")
             .withColumn("_u", unit_interval(keys if len(keys) > 1 else keys[0], seed))
             .select(*keys, F.size(F.filter(F.coalesce("_ends", equal), lambda e: e <= F.col("_u"))).alias("_fold"), F.lit(0).alias("_by")))
    kinds = ", ".join(f"{g} {sized.schema[g].dataType.simpleString()}" for g in keys)
    fixed = spark.createDataFrame(placed, f"{kinds}, _fold int").withColumn("_by", F.lit(1))
    folds = drawn.unionByName(fixed).groupBy(*keys).agg(F.max_by("_fold", "_by").alias(col))
    return df.join(folds, _same_groups(gcols, "_g"), "left").drop(*keys)


def fingerprint(df: DataFrame, cols: Sequence[str] | None = None) -> tuple:
    """Order-free frame fingerprint (row count, summed 64-bit row hashes)."""
    cols = list(cols or df.columns)
    r = df.agg(F.count(F.lit(1)).alias("n"),
               F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).alias("h")).first()
    return (r["n"], r["h"])
