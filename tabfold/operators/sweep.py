"""Score-weight sweep: find w on a fixed lattice maximising kappa of
``bin(score * w)`` against the real class.

Brute force scores every row once per candidate (701 passes or a 701x
explode).  Here each row's class is a step function of the candidate index
j: it changes only where ``score * w_j`` crosses a cut, so a row emits at most
1 + 2*len(cuts) (j, real, class, +-1) deltas.  Summing deltas per
(j, real, class) is one aggregation with map-side combine, and the only shuffle:
its result is bounded by lattice size x real classes x predicted classes,
whatever the number of rows.  Running sums of it along the lattice are the
confusion tables of all candidates, and kappa is a few sums of each.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabfold.functions.columns import SEVERITY_CUTS, ordinal_bin


def lattice(lo_milli: int = 800, hi_milli: int = 1500) -> list[float]:
    """w_j = (lo + j) / 1000 for j = 0..hi-lo (computed the same way everywhere)."""
    return [(lo_milli + j) / 1000.0 for j in range(hi_milli - lo_milli + 1)]


def _w(j: Column, lo_milli: int) -> Column:
    return (F.lit(lo_milli).cast("double") + j.cast("double")) / F.lit(1000.0)


def crossing_index(s: Column, cut: float, lo_milli: int) -> Column:
    """Smallest j with s * w_j >= cut (s > 0): estimate by division, fix by exact products."""
    j0 = F.ceil(F.lit(float(cut)) / s * F.lit(1000.0) - F.lit(float(lo_milli))).cast("bigint") - 1
    below = sum((s * _w(j0 + d, lo_milli) < F.lit(float(cut))).cast("bigint") for d in range(3))
    return j0 + below


def class_deltas(df: DataFrame, real: str, score: str, cuts: Sequence[float] = SEVERITY_CUTS,
                 lo_milli: int = 800, hi_milli: int = 1500) -> DataFrame:
    """(j, real, pred, delta) summed: changes of the confusion table along the lattice."""
    n_j = hi_milli - lo_milli
    s = F.col(score).cast("double")
    c0 = ordinal_bin(s * _w(F.lit(0), lo_milli), cuts)
    ev = [F.struct(F.lit(0).cast("bigint").alias("j"), c0.alias("cls"), F.lit(1).alias("d"))]
    for i, cut in enumerate(cuts):
        ji = F.when(s > 0, crossing_index(s, cut, lo_milli))
        ok = ji.isNotNull() & (ji >= 1) & (ji <= n_j)
        ev.append(F.when(ok, F.struct(ji.alias("j"), F.lit(i).alias("cls"), F.lit(-1).alias("d"))))
        ev.append(F.when(ok, F.struct(ji.alias("j"), F.lit(i + 1).alias("cls"), F.lit(1).alias("d"))))
    rows = (df.where(F.col(real).isNotNull() & s.isNotNull())
              .select(F.col(real).alias("real"), F.explode(F.filter(F.array(*ev), lambda e: e.isNotNull())).alias("e")))
    return (rows.groupBy(F.col("e.j").alias("j"), "real", F.col("e.cls").alias("pred"))
                .agg(F.sum("e.d").alias("delta")))


def kappas(deltas: Sequence[tuple], n_j: int, n_pred: int, quadratic: bool = True) -> np.ndarray:
    """Kappa at each of ``n_j`` lattice points from (j, real, pred, delta); classes ranked in the union of those present."""
    real = sorted({r for _, r, _, _ in deltas})
    every = sorted({*real, *range(n_pred)})
    place = {c: i for i, c in enumerate(every)}
    rows = np.array([place[r] for r in real], dtype=int)
    n = np.zeros((n_j, len(real), n_pred))
    at = {r: i for i, r in enumerate(real)}
    for j, r, p, d in deltas:
        n[j, at[r], p] += d
    n = n.cumsum(axis=0)
    by_real, by_pred = n.sum(2), n.sum(1)
    present = np.zeros((n_j, len(every)))
    np.maximum.at(present, (slice(None), rows), (by_real > 0).astype(float))
    np.maximum.at(present, (slice(None), [place[p] for p in range(n_pred)]), (by_pred > 0).astype(float))
    rank = present.cumsum(1) - 1
    i, k = rank[:, rows], rank[:, [place[p] for p in range(n_pred)]]
    total = by_real.sum(1)
    with np.errstate(all="ignore"):
        if quadratic:
            # sums over cells of n (i - k)^2, expanded
            cross = (n * i[:, :, None] * k[:, None, :]).sum((1, 2))
            r2, c2, r1, c1 = (by_real * i * i).sum(1), (by_pred * k * k).sum(1), (by_real * i).sum(1), (by_pred * k).sum(1)
            return 1 - (r2 + c2 - 2 * cross) / (r2 + c2 - 2 * r1 * c1 / total)
        same = (n * (rows[:, None] == np.array([place[p] for p in range(n_pred)])[None, :])).sum((1, 2))
        by_class = np.zeros((n_j, len(every)))
        by_class[:, [place[p] for p in range(n_pred)]] = by_pred
        return 1 - (total - same) / (total - (by_real * by_class[:, rows]).sum(1) / total)


def sweep(df: DataFrame, real: str, score: str, cuts: Sequence[float] = SEVERITY_CUTS,
          lo_milli: int = 800, hi_milli: int = 1500, quadratic: bool = True) -> DataFrame:
    """(j, weight, kappa) for every lattice point; classes ranked in the per-candidate union.

    ``real`` holds class codes, as many as the cuts make or a few more: the
    driver takes a number for each lattice point, real and predicted class.
    """
    n_j = hi_milli - lo_milli + 1
    deltas = [tuple(r) for r in class_deltas(df, real, score, cuts, lo_milli, hi_milli).collect()]
    curve = kappas(deltas, n_j, len(cuts) + 1, quadratic)
    return df.sparkSession.createDataFrame([(j, w, float(v)) for j, (w, v) in enumerate(zip(lattice(lo_milli, hi_milli), curve, strict=True))],
                                           "j int, weight double, kappa double")


def best_weight(curve: DataFrame) -> DataFrame:
    """Strict improvement, first wins: the smallest weight among the best kappas."""
    return curve.where(F.col("kappa").isNotNull() & ~F.isnan("kappa")).orderBy(F.col("kappa").desc(), "j").limit(1)
