"""Data profiling: null profile, sparse-column dropper, duplicates, value counts,
correlations with a target, equal-width histograms, conditional shares.

Each profile is one (or two) aggregation passes with map-side partial
combine; per-column results are unpivoted with ``stack`` on the one-row
aggregate, never on the data.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabfold.llm.common import ship_package


def _stack(row_df: DataFrame, names: Sequence[str], prefix: str, value: str, key: str = "column") -> DataFrame:
    parts = ", ".join(f"'{n}', `{prefix}{i}`" for i, n in enumerate(names))
    return row_df.selectExpr(f"stack({len(names)}, {parts}) as (`{key}`, `{value}`)")


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, n_null, null_pct, n_rows): one pass, sorted by null count desc."""
    cols = list(cols or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    parts = ", ".join(f"'{c}', `_n{i}`" for i, c in enumerate(cols))
    long = agg.selectExpr("_rows", f"stack({len(cols)}, {parts}) as (`column`, n_null)")
    return (long.select("column", F.col("n_null").cast("bigint").alias("n_null"),
                        (F.col("n_null") * 100.0 / F.col("_rows")).alias("null_pct"),
                        F.col("_rows").alias("n_rows"))
                .orderBy(F.col("n_null").desc(), "column"))


def columns_with_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    return [r["column"] for r in null_profile(df, cols).where("n_null > 0").collect()]


class DropSparse(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Drop columns whose null share is strictly above ``maxNullPct`` (fitted on training rows)."""

    maxNullPct = Param(Params._dummy(), "maxNullPct", "null share limit in percent",
                       TypeConverters.toFloat)
    inputCols = Param(Params._dummy(), "inputCols", "columns to consider (default all)",
                      TypeConverters.toListString)

    def __init__(self, maxNullPct: float = 60.0, inputCols: list[str] | None = None):
        super().__init__()
        self._setDefault(maxNullPct=60.0, inputCols=[])
        self._set(maxNullPct=maxNullPct, inputCols=inputCols or [])

    def _fit(self, df: DataFrame) -> "DropSparseModel":
        cols = self.getOrDefault(self.inputCols) or df.columns
        lim = self.getOrDefault(self.maxNullPct)
        prof = null_profile(df, cols).where(F.col("null_pct") > lim).collect()
        return DropSparseModel(dropCols=[r["column"] for r in prof])


class DropSparseModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    dropCols = Param(Params._dummy(), "dropCols", "fitted columns to drop", TypeConverters.toListString)

    def __init__(self, dropCols: list[str] | None = None):
        super().__init__()
        self._setDefault(dropCols=[])
        self._set(dropCols=dropCols or [])

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.getOrDefault(self.dropCols))


def row_digest(cols: Sequence[str], nested: Sequence[str] = ()) -> Column:
    """SHA-256 of an unambiguous encoding of the row (length-prefixed values, null marker).

    ``nested`` columns (arrays, structs, maps) are written as JSON, which quotes their strings.
    """
    parts = []
    for c in cols:
        v = F.to_json(F.col(c)) if c in nested else F.col(c).cast("string")
        parts.append(F.when(v.isNull(), F.lit("N")).otherwise(F.concat(F.lit("V"), F.length(v).cast("string"),
                                                                      F.lit(":"), v)))
    return F.sha2(F.concat(*parts), 256)


def duplicate_count(df: DataFrame, cols: Sequence[str], digest: bool = True) -> DataFrame:
    """(n_rows, n_duplicates): rows beyond the first of each identical feature tuple.

    ``digest=True`` groups by a 256-bit digest of the tuple, so the shuffle
    carries 32 bytes per row instead of whole texts (a collision would need
    two different rows with equal SHA-256).  ``digest=False`` groups by the
    columns themselves.
    """
    nested = [c for c in cols if isinstance(df.schema[c].dataType, (T.ArrayType, T.StructType, T.MapType))]
    keys = [row_digest(cols, nested).alias("_d")] if digest else list(cols)
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(F.sum("_c").cast("bigint").alias("n_rows"),
                 F.sum(F.col("_c") - 1).cast("bigint").alias("n_duplicates"))


def value_counts(df: DataFrame, col: str, with_share: bool = True) -> DataFrame:
    """(value, n[, pct]) with nulls excluded, sorted by count desc.

    The share divides by the sum of the counts; the rows are not read again.
    """
    vc = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    if with_share:
        total = vc.agg(F.sum("n").cast("double"))             # one number, within the plan
        vc = vc.withColumn("pct", F.col("n") * 100.0 / total.scalar())
    return vc.orderBy(F.col("n").desc(), col)


def target_correlations(df: DataFrame, features: Sequence[str], target: str,
                        min_abs: float | None = None) -> DataFrame:
    """Pearson correlation of each feature with the target (pairwise complete), one pass.

    ``min_abs`` keeps only |r| > min_abs; sorted ascending by r.
    """
    agg = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(f"_r{i}")
                   for i, c in enumerate(features)])
    out = _stack(agg, features, "_r", "corr", "feature").where(F.col("corr").isNotNull())
    if min_abs is not None:
        out = out.where(F.abs("corr") > F.lit(float(min_abs)))
    return out.orderBy("corr", "feature")


WIDE = 30            # columns from which on pairs are summed as matrices


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All pairs (a, b, corr), pairwise complete, in one aggregation.

    Few columns: an aggregate a pair.  From ``WIDE`` columns on: a partition's
    rows become matrix products of values and of masks of what is there, one
    row of moments a column, which are merged by column (``gram_sums``).  The
    numbers are the same but for rounding.
    """
    cols = list(cols)
    if len(cols) >= WIDE:
        return _from_gram(gram_sums(df, cols), cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    agg = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_r{i}")
                   for i, (a, b) in enumerate(pairs)])
    parts = ", ".join(f"'{a}', '{b}', `_r{i}`" for i, (a, b) in enumerate(pairs))
    return agg.selectExpr(f"stack({len(pairs)}, {parts}) as (a, b, corr)")


MOMENTS = ["n", "mx", "my", "vx", "vy", "cxy"]
ORIGINS = ["ox", "oy"]         # until all is merged, means are counted from here


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of two sets of rows together: numbers, means, sums of squares and products about the means, origins.

    Means are counted from an origin, a value of the rows, so that those far from zero keep their digits.
    """
    n = a[0] + b[0]
    share = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    ox, oy = np.where(a[0] > 0, a[6], b[6]), np.where(a[0] > 0, a[7], b[7])
    dx, dy, f = b[6] - ox + b[1] - a[1], b[7] - oy + b[2] - a[2], a[0] * share
    return np.stack([n, a[1] + dx * share, a[2] + dy * share, a[3] + b[3] + dx * dx * f, a[4] + b[4] + dy * dy * f, a[5] + b[5] + dx * dy * f,
                     ox, oy])


def gram_sums(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(i, n, mx, my, vx, vy, cxy): per column, arrays over all columns j of moments of the rows that have both:
    their number, both means, sums of squares about the means, and of products.

    One pass.  The values of a batch are taken from one of its own, and
    batches are merged by their means, so no large sums are subtracted.
    NaN counts as missing.
    """
    ship_package(df.sparkSession)                 # the workers call ``_merged``
    p = len(cols)
    number = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(f"x{i}") for i, c in enumerate(cols)]

    def partial(batches):
        total = np.zeros((len(MOMENTS + ORIGINS), p, p))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            there = ~np.isnan(x)
            start = np.where(there.any(axis=1), x[np.arange(p), there.argmax(axis=1)], 0.0)      # a value that is there
            x, m = np.where(there, x - start[:, None], 0.0), there.astype(float)
            n, sx, sxx, sxy = m @ m.T, x @ m.T, (x * x) @ m.T, x @ x.T
            some = np.maximum(n, 1.0)
            here = np.stack([n, sx / some, sx.T / some, sxx - sx * sx / some, (sxx - sx * sx / some).T, sxy - sx * sx.T / some,
                             np.where(n > 0, start[:, None], 0.0), np.where(n > 0, start[None, :], 0.0)])
            total = _merged(total, here)
        if total[0].any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(p, dtype=np.int32)), *[pa.array(list(t), pa.list_(pa.float64())) for t in total]], names=["i", *MOMENTS, *ORIGINS])

    def added(key, rows):
        each = zip(*[rows[name] for name in MOMENTS + ORIGINS], strict=True)
        total = functools.reduce(_merged, [np.stack(list(r)) for r in each])
        total[1:3] += total[6:]
        return pd.DataFrame({"i": [key[0]], **{name: [total[k]] for k, name in enumerate(MOMENTS)}})
    def kind(names):
        return "i int, " + ", ".join(f"{name} array<double>" for name in names)
    # a row a column and partition meets its like
    return df.select(*number).mapInArrow(partial, kind(MOMENTS + ORIGINS)).groupBy("i").applyInPandas(added, kind(MOMENTS))


def _from_gram(sums: DataFrame, cols: Sequence[str]) -> DataFrame:
    names = F.array(*[F.lit(c) for c in cols])
    each = sums.select("i", F.posexplode(F.arrays_zip(*MOMENTS)).alias("j", "s")).where("j > i")
    spread = F.col("s.vx") * F.col("s.vy")
    corr = F.when((F.col("s.n") > 1) & (spread > 0), F.col("s.cxy") / F.sqrt(spread))
    return each.select(F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), corr.alias("corr"))


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram (bin, lo, hi, n); last bin closed; nulls ignored.

    Pass 1 is a two-number aggregate (min, max); pass 2 counts per bin.
    """
    mm = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = mm["lo"], mm["hi"]
    x = F.col(col).cast("double")
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n bigint")
    width = (float(hi) - float(lo)) or 1.0
    b = F.least(F.floor((x - F.lit(float(lo))) / F.lit(width) * bins), F.lit(bins - 1)).cast("int")
    counts = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    bins_ = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))      # empty bins count 0
    counts = bins_.join(F.broadcast(counts), "bin", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
    return counts.select("bin", (F.lit(float(lo)) + F.col("bin") * (width / bins)).alias("lo"),
                         (F.lit(float(lo)) + (F.col("bin") + 1) * (width / bins)).alias("hi"), "n")


def conditional_share(df: DataFrame, group: str, cond: Column, name: str = "share") -> DataFrame:
    """Per group, the share of rows meeting ``cond`` (null cond counts as not met)."""
    return df.groupBy(group).agg(F.avg(F.coalesce(cond, F.lit(False)).cast("double")).alias(name),
                                 F.count(F.lit(1)).alias("n"))
