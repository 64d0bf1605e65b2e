"""Median imputation as Spark ML stages, plus the fold-safe variant.

``MedianImputer.fit`` computes exact medians (``operators.quantiles``) of the
training rows; the model fills nulls and NaN with the median.  Columns
that are entirely null in training are dropped, as a median imputer does.
``fold_medians`` computes, for every fold k, medians over the rows *not* in
fold k, so validation rows never leak into their own fill values; counts
are summed across folds instead of copying rows per fold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabfold.functions.columns import numerical_cols
from tabfold.operators.quantiles import complement_quantile, exact_medians, to_long


class MedianImputer(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    inputCols = Param(Params._dummy(), "inputCols", "columns to impute (default: numeric)",
                      TypeConverters.toListString)
    exclude = Param(Params._dummy(), "exclude", "columns never imputed (keys, label)",
                    TypeConverters.toListString)

    def __init__(self, inputCols: list[str] | None = None, exclude: list[str] | None = None):
        super().__init__()
        self._setDefault(inputCols=[], exclude=[])
        self._set(inputCols=inputCols or [], exclude=exclude or [])

    def _fit(self, df: DataFrame) -> "MedianImputerModel":
        cols = self.getOrDefault(self.inputCols) or numerical_cols(df, self.getOrDefault(self.exclude))
        med = {r["column"]: r["value"] for r in exact_medians(df, cols).collect()}
        return MedianImputerModel(columns=cols, medians=[float(med[c]) if c in med else float("nan")
                                                         for c in cols])


class MedianImputerModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    columns = Param(Params._dummy(), "columns", "imputed columns", TypeConverters.toListString)
    medians = Param(Params._dummy(), "medians", "fitted medians (NaN: all null)", TypeConverters.toListFloat)

    def __init__(self, columns: list[str] | None = None, medians: list[float] | None = None):
        super().__init__()
        self._setDefault(columns=[], medians=[])
        self._set(columns=columns or [], medians=medians or [])

    def fill_values(self) -> dict[str, float]:
        return {c: m for c, m in zip(self.getOrDefault(self.columns), self.getOrDefault(self.medians))
                if m == m}

    def _transform(self, df: DataFrame) -> DataFrame:
        cols, meds = self.getOrDefault(self.columns), self.getOrDefault(self.medians)
        empty = [c for c, m in zip(cols, meds) if m != m and c in df.columns]
        fills = {c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(m)) for c, m in self.fill_values().items()
                 if c in df.columns}
        return df.withColumns(fills).drop(*empty)


def fold_medians(df: DataFrame, cols: Sequence[str], k: int, fold_col: str = "fold") -> DataFrame:
    """(train_fold, column, value): medians of the rows outside each fold.

    Uses decomposable per-fold counts (no row is copied per fold)."""
    return complement_quantile(to_long(df, cols, [fold_col]), k, fold_col, 0.5)


def impute_by_fold(df: DataFrame, cols: Sequence[str], k: int, fold_col: str = "fold") -> DataFrame:
    """Fill each row's nulls with the medians fitted without its own fold.

    The fitted table has k x len(cols) numbers; it becomes one literal
    fold -> median map per column (no join).
    """
    med = fold_medians(df, cols, k, fold_col).collect()
    by_col: dict[str, dict[int, float]] = {}
    for r in med:
        by_col.setdefault(r["column"], {})[r["train_fold"]] = r["value"]
    fills = {}
    for c in cols:
        m = by_col.get(c, {})
        if not m:
            continue
        lookup = F.create_map(*[x for f, v in sorted(m.items()) for x in (F.lit(f), F.lit(float(v)))])
        fills[c] = F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.element_at(lookup, F.col(fold_col)))
    return df.withColumns(fills)
