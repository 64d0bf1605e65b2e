"""Exact quantiles (linear interpolation, nulls ignored) without holding a whole
column in one task.

Spark's exact ``percentile``/``median`` keeps a value->count map of the whole
group in one final task.  Here a rank is searched by value:

1. one aggregation gives ``percentile_approx`` on a fixed grid of GRID+1
   points inside the current open interval (the sketch's size is bounded);
2. the driver picks a few grid values around the rank;
3. one aggregation counts the rows below and up to each of them exactly.

Either the rank lies among the rows equal to one of these values, and is
found, or it lies strictly between two of them.  That interval is the next
one: it holds about one grid step of rows and none of the values tried, so
ties cannot stop the search.  At most ``max_band`` values left are sorted.

Groups of at most ``SMALL`` rows never reach the driver; larger ones do in
chunks of ``CHUNK``, so its state is bounded whatever the number of groups.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRID = 1024
ACCURACY = 4_096      # rank error <= interval / 4096: a quarter of a grid step
MAX_BAND = 2_000      # values of an interval that are sorted in one task
MARGIN = 2            # grid steps on each side that are tried as well
SMALL = 100_000       # rows of a group up to which a task may hold its value counts
CHUNK = 512           # groups searched at a time


def to_long(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, v) with v double, nulls and NaN removed."""
    parts = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return (df.selectExpr(*[f"`{b}`" for b in by], f"stack({len(cols)}, {parts}) as (`column`, v)")
              .where(F.col("v").isNotNull() & ~F.isnan("v")))


def _targets(n: int, q: float) -> tuple[int, int, float]:
    pos = q * (n - 1)
    r1 = int(math.floor(pos))
    return r1, int(math.ceil(pos)), pos - r1


def _types(long: DataFrame, keys: Sequence[str]) -> str:
    types = {f.name: f.dataType.simpleString() for f in long.schema.fields}
    return ", ".join(f"`{c}` {types[c]}" for c in keys)


def _with(long: DataFrame, keys: Sequence[str], rows: list[tuple], extra: str) -> DataFrame:
    """``long`` joined with a small table of one row a key (null keys match null keys)."""
    small = long.sparkSession.createDataFrame(rows, _types(long, keys) + ", " + extra)
    small = small.withColumnsRenamed({c: f"_k{i}" for i, c in enumerate(keys)})
    on = None
    for i, c in enumerate(keys):
        same = F.col(c).eqNullSafe(F.col(f"_k{i}"))
        on = same if on is None else on & same
    return long.join(F.broadcast(small), on).drop(*[f"_k{i}" for i in range(len(keys))])


def _search(long: DataFrame, keys: list[str], families: list[dict], max_band: int) -> list[dict[tuple, float]]:
    """Values at ranks.  A family has ``counts`` (source key -> rows) and ``targets``
    ((name, source keys, rank): the rank among the rows of these sources);
    returns, per family, name -> value.  A source key belongs to one family.
    """
    grid_p = [i / GRID for i in range(GRID + 1)]
    found: list[dict[tuple, float]] = [{} for _ in families]
    # open interval, rows of the target's sources up to its low end, rows inside
    state = [{name: (-math.inf, math.inf, 0, sum(fam["counts"][s] for s in src), src, rank)
              for name, src, rank in fam["targets"]} for fam in families]
    while any(state):
        live = [i for i, s in enumerate(state) if any(x[3] > max_band for x in s.values())]
        if not live:
            break
        spans = {i: (min(x[0] for x in state[i].values()), max(x[1] for x in state[i].values())) for i in live}
        rows = [(*k, float(spans[i][0]), float(spans[i][1])) for i in live for k in families[i]["counts"]]
        inside = (F.col("v") > F.col("_lo")) & (F.col("v") < F.col("_hi"))
        grids = {tuple(r[c] for c in keys): (r["_b"], r["_m"], r["_g"]) for r in
                 _with(long, keys, rows, "_lo double, _hi double").groupBy(*keys).agg(
                     F.count_if(F.col("v") <= F.col("_lo")).alias("_b"), F.count_if(inside).alias("_m"),
                     F.percentile_approx(F.when(inside, F.col("v")), grid_p, ACCURACY).alias("_g")).collect()}
        tried = {}
        for i in live:
            points = set()
            for lo, hi, below, band, src, rank in state[i].values():
                if band <= max_band:
                    continue
                parts = [(b, m, np.asarray(g, float)) for b, m, g in (grids[k] for k in src if k in grids) if g]
                cand = np.unique(np.concatenate([g for _, _, g in parts]))
                cand = cand[(cand > lo) & (cand < hi)]
                less = sum(b + m * np.maximum(np.searchsorted(g, cand, "left") - 1, 0) / GRID for b, m, g in parts)
                step = max(1.0, sum(m for _, m, _ in parts) / GRID)
                at = int(np.searchsorted(less, rank, "right"))
                near = {at - 1, at, int(np.searchsorted(less, rank - MARGIN * step)) - 1,
                        int(np.searchsorted(less, rank + MARGIN * step))}
                points |= {float(cand[min(max(j, 0), len(cand) - 1)]) for j in near}
            tried[i] = sorted(points)
        width = max(map(len, tried.values()))
        rows = [(*k, tried[i] + [math.inf] * (width - len(tried[i]))) for i in live for k in families[i]["counts"]]
        aggs = []
        for j in range(width):
            aggs += [F.count_if(F.col("v") < F.element_at("_p", j + 1)).alias(f"_lt{j}"),
                     F.count_if(F.col("v") <= F.element_at("_p", j + 1)).alias(f"_le{j}")]
        counted = {tuple(r[c] for c in keys): r for r in
                   _with(long, keys, rows, "_p array<double>").groupBy(*keys).agg(*aggs).collect()}
        for i in live:
            for name, (lo, hi, below, band, src, rank) in list(state[i].items()):
                upto = below + band                            # rows below the high end
                for j, p in enumerate(tried[i]):
                    if not lo < p < hi:
                        continue
                    lt = sum(counted[k][f"_lt{j}"] for k in src if k in counted)
                    le = sum(counted[k][f"_le{j}"] for k in src if k in counted)
                    if le <= rank:
                        lo, below = p, le
                    elif lt <= rank:
                        found[i][name] = p
                        break
                    else:
                        hi, upto = p, lt
                        break
                if name in found[i]:
                    del state[i][name]
                else:
                    state[i][name] = (lo, hi, below, upto - below, src, rank)
    _read_off(long, keys, families, state, found)
    return found


def _read_off(long: DataFrame, keys: list[str], families: list[dict], state: list[dict], found: list[dict]) -> None:
    """Sort the few values of each remaining interval and read the ranks."""
    jobs = [(i, name, *x) for i, s in enumerate(state) for name, x in s.items()]
    for lo in range(0, len(jobs), CHUNK):
        part = jobs[lo:lo + CHUNK]
        by_source: dict[tuple, list] = {}
        for n, (_, _, a, b, _, _, src, _) in enumerate(part):
            for k in src:
                by_source.setdefault(k, []).append((n, float(a), float(b)))
        rows = [(*k, v) for k, v in by_source.items()]
        tagged = (_with(long, keys, rows, "_t array<struct<n:int,a:double,b:double>>")
                  .select("v", F.explode(F.filter("_t", lambda t: (F.col("v") > t["a"]) & (F.col("v") < t["b"]))).alias("t")))
        ranks = long.sparkSession.createDataFrame([(n, x[7] - x[4] + 1) for n, x in enumerate(part)], "n int, _i int")
        got = (tagged.groupBy("t.n").agg(F.sort_array(F.collect_list("v")).alias("_a"))
               .join(F.broadcast(ranks), "n").select("n", F.element_at("_a", F.col("_i")).alias("v")).collect())
        for r in got:
            found[part[r["n"]][0]][part[r["n"]][1]] = r["v"]


def _interpolate(values: dict[tuple, float], frac: float, name: tuple) -> float:
    v1, v2 = values[(*name, 1)], values[(*name, 2)]
    return float(v1 + frac * (v2 - v1))


def exact_quantile(long: DataFrame, q: float = 0.5, by: Sequence[str] = (),
                   max_band: int = MAX_BAND, small: int | None = None) -> DataFrame:
    """Exact q-quantile per (by..., column) of a long frame; returns (by..., column, value).

    Pairs with no values are absent from the result.
    """
    spark = long.sparkSession
    keys = [*by, "column"]
    small = SMALL if small is None else small
    sizes = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    large = [(tuple(r[c] for c in keys), r["_n"]) for r in sizes.where(F.col("_n") > small).collect()]
    rows = []
    for lo in range(0, len(large), CHUNK):
        families, fracs = [], []
        for k, n in large[lo:lo + CHUNK]:
            r1, r2, frac = _targets(n, q)
            families.append({"counts": {k: n}, "targets": [((1,), [k], r1), ((2,), [k], r2)]})
            fracs.append(frac)
        for fam, frac, values in zip(families, fracs, _search(long, keys, families, max_band)):
            rows.append((*next(iter(fam["counts"])), _interpolate(values, frac, ())))
    done = spark.createDataFrame(rows, _types(long, keys) + ", value double")
    if len(large) == 0 and not by:
        rest = long
    else:                       # one row a large group: at most one in SMALL rows
        named = done.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)])
        on = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(keys)]
        cond = on[0]
        for c in on[1:]:
            cond = cond & c
        rest = long.join(F.broadcast(named) if len(large) <= 100_000 else named, cond, "left_anti")
    few = rest.groupBy(*keys).agg(F.percentile("v", F.lit(float(q))).alias("value"))
    return few.unionByName(done)


def exact_medians(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
                  max_band: int = MAX_BAND, small: int | None = None) -> DataFrame:
    """Exact median of every column (per group): (by..., column, value)."""
    return exact_quantile(to_long(df, cols, by), 0.5, by, max_band, small)


def complement_quantile(long: DataFrame, k: int, fold: str = "fold", q: float = 0.5,
                        max_band: int = MAX_BAND) -> DataFrame:
    """Exact q-quantile of every column over the rows *outside* each fold.

    Input: long frame (fold, column, v).  Output: (train_fold, column, value).
    No row is copied per fold: counts add up, so the rows outside fold t are
    those of all other (fold, column) sources, counted once for all targets.
    """
    spark = long.sparkSession
    sizes = {(r[fold], r["column"]): r["_n"] for r in
             long.groupBy(fold, "column").agg(F.count(F.lit(1)).alias("_n")).collect()}
    families, fracs, names = [], {}, []
    for c in sorted({c for _, c in sizes}):
        counts = {s: n for s, n in sizes.items() if s[1] == c}
        targets = []
        for t in range(k):
            src = [s for s in counts if s[0] != t]
            if n := sum(counts[s] for s in src):
                r1, r2, fracs[t, c] = _targets(n, q)
                targets += [((t, 1), src, r1), ((t, 2), src, r2)]
        families.append({"counts": counts, "targets": targets})
        names.append(c)
    found = _search(long, [fold, "column"], families, max_band)
    out = [(t, c, _interpolate(v, fracs[t, c], (t,))) for c, v in zip(names, found) for t in range(k) if (t, c) in fracs]
    return spark.createDataFrame(sorted(out), f"train_fold int, {_types(long, ['column'])}, value double")
