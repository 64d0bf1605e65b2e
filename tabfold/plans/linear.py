"""Closed-form least squares / ridge, fitted per fold complement from one aggregation.

The executors compute, per fold, the count, means and centred cross-product
sums (``covar_pop`` is a numerically stable one-pass aggregate with
partial/final merge).  The driver receives k rows of p*(p+1)/2 + 2p numbers,
merges the k-1 other folds into each complement (Chan's parallel formula:
no subtraction, so no cancellation), solves the p x p system, and hands back
a k-row coefficient table that is broadcast-joined to score the rows.
This is the same split of work as Spark ML's normal-equation solver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Moments:
    n: float
    mean: np.ndarray          # (p+1,) features then label
    css: np.ndarray           # (p+1, p+1) centred sums of cross products


def moment_aggs(features: Sequence[str], label: str) -> list[Column]:
    cols = list(features) + [label]
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)]
    for i in range(len(cols)):
        for j in range(i, len(cols)):
            aggs.append(F.covar_pop(cols[i], cols[j]).alias(f"_c{i}_{j}"))
    return aggs


def _row_to_moments(r, q: int) -> Moments:
    n = float(r["_n"])
    mean = np.array([r[f"_m{i}"] for i in range(q)], dtype=float)
    css = np.zeros((q, q))
    for i in range(q):
        for j in range(i, q):
            v = (r[f"_c{i}_{j}"] or 0.0) * n
            css[i, j] = css[j, i] = v
    return Moments(n, mean, css)


def merge(parts: Sequence[Moments]) -> Moments:
    """Pool moments of disjoint parts (total = within + between sums)."""
    parts = [m for m in parts if m.n > 0]
    n = sum(m.n for m in parts)
    if n == 0:
        raise ValueError("no rows to fit")
    mean = sum(m.n * m.mean for m in parts) / n
    css = sum(m.css + m.n * np.outer(m.mean - mean, m.mean - mean) for m in parts)
    return Moments(n, mean, css)


def fold_moments(df: DataFrame, features: Sequence[str], label: str,
                 fold_col: str | None = "fold") -> dict:
    """{fold: Moments} from one aggregation over complete rows."""
    q = len(features) + 1
    complete = df.where(F.reduce(F.array(*[F.col(c).isNotNull() for c in [*features, label]]),
                                 F.lit(True), lambda a, b: a & b)) if features else df
    g = complete.groupBy(fold_col) if fold_col else complete.groupBy()
    rows = g.agg(*moment_aggs(features, label)).collect()   # k rows
    return {(r[fold_col] if fold_col else None): _row_to_moments(r, q) for r in rows}


def solve(m: Moments, alpha: float = 0.0) -> tuple[float, np.ndarray]:
    """Ridge with unpenalised intercept on centred sums: (Sxx + aI) b = Sxy."""
    p = len(m.mean) - 1
    sxx = m.css[:p, :p] + alpha * np.eye(p)
    sxy = m.css[:p, p]
    beta = np.linalg.lstsq(sxx, sxy, rcond=None)[0] if p else np.zeros(0)
    intercept = m.mean[p] - float(beta @ m.mean[:p]) if p else m.mean[p]
    return float(intercept), beta


@dataclass
class LinearFit:
    features: list[str]
    table: DataFrame          # (fold, intercept, b_<feature>...) ; fold null = all rows

    def predict(self, df: DataFrame, fold_col: str | None = "fold",
                out: str = "prediction") -> DataFrame:
        """Score rows with their own fold's coefficients (k-row broadcast join)."""
        coef = self.table
        terms = F.col("_intercept")
        for i, c in enumerate(self.features):
            terms = terms + F.col(f"_b{i}") * F.col(c)
        if fold_col:
            joined = df.join(F.broadcast(coef.withColumnRenamed("fold", fold_col)), fold_col, "left")
        else:   # a single all-rows model: its p+1 numbers become literals
            joined = df.withColumns({c: F.lit(v) for c, v in coef.drop("fold").first().asDict().items()})
        return joined.withColumn(out, terms).drop("_intercept", *[f"_b{i}" for i in range(len(self.features))])


def _coef_table(spark: SparkSession, fits: dict, p: int) -> DataFrame:
    schema = "fold int, _intercept double" + "".join(f", _b{i} double" for i in range(p))
    rows = [(f, a, *[float(x) for x in b]) for f, (a, b) in sorted(fits.items(), key=lambda t: (t[0] is None, t[0]))]
    return spark.createDataFrame(rows, schema)


def fit_folds(df: DataFrame, features: Sequence[str], label: str, fold_col: str = "fold",
              alpha: float = 0.0) -> LinearFit:
    """One model per fold, each trained on the rows of all other folds."""
    mom = fold_moments(df, features, label, fold_col)
    fits = {f: solve(merge([m for g, m in mom.items() if g != f]), alpha) for f in mom}
    return LinearFit(list(features), _coef_table(df.sparkSession, fits, len(features)))


def fit_all(df: DataFrame, features: Sequence[str], label: str, alpha: float = 0.0) -> LinearFit:
    mom = fold_moments(df, features, label, None)
    fits = {None: solve(merge(list(mom.values())), alpha)}
    return LinearFit(list(features), _coef_table(df.sparkSession, fits, len(features)))


def coefficients(fit: LinearFit) -> DataFrame:
    """Long form (fold, term, value)."""
    t = fit.table
    names = ["intercept", *fit.features]
    cols = ["_intercept", *[f"_b{i}" for i in range(len(fit.features))]]
    stack = ", ".join(f"'{n}', `{c}`" for n, c in zip(names, cols))
    return t.selectExpr("fold", f"stack({len(names)}, {stack}) as (term, value)")
