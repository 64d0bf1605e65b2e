"""Validation: hold-out, K-fold cross-validation with out-of-fold predictions,
cached splits with an input guard.

Folds are a column of one checkpointed frame (train = fold != k, validation
= fold == k); the k pipeline fits are submitted from a small driver thread
pool so Spark can run them side by side.  The OOF frame is the union of
the per-fold scored validation rows, keyed by the row key.
"""

from __future__ import annotations

import copy
import functools
import uuid
import weakref
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabfold.operators import folds as K
from tabfold.operators import metrics as M
from tabfold.operators.impute import MedianImputerModel, fold_medians
from tabfold.plans import learners as L
from tabfold.session import cut_lineage, scratch_path


#: an id of each row of cached folds, made when they are written: keys may be null or repeated
ROW = "_row"


@dataclass
class CVResult:
    score: float
    rounds: int
    oof: DataFrame                  # (key, fold, label, carried columns, prediction)
    per_fold: DataFrame             # (fold, <metric>, rounds)
    curves: dict = field(default_factory=dict)
    models: dict = field(default_factory=dict)


def assign_folds(df: DataFrame, key: str, k: int, seed: int = 0, groups: str | Sequence[str] | None = None,
                 stratify: str | None = None, col: str = "fold") -> DataFrame:
    """Pick the splitter from the arguments (K2-K5)."""
    if groups and stratify:
        return K.stratified_group_kfold(df, groups, stratify, k, seed, col)
    if groups:
        return K.group_kfold(df, groups, k, seed, col)
    if stratify:
        return K.stratified_kfold(df, key, stratify, k, seed, col)
    return K.kfold(df, key, k, seed, col)


def write_folds(folded: DataFrame) -> DataFrame:
    """Folds as Parquet in the shared folder, a directory a fold: reading all but one fold skips its files."""
    spark = folded.sparkSession
    path = scratch_path(spark, f"folds-{uuid.uuid4().hex}")
    folded.write.partitionBy("fold").parquet(path)
    return spark.read.schema(folded.schema).parquet(path)


def _needed(key, label, features, groups, stratify) -> list[str]:
    """The columns that splitting and fitting read, each once."""
    names = [key, label, *features, *([groups] if isinstance(groups, str) else list(groups or [])), stratify]
    return list(dict.fromkeys(c for c in names if c))


def fold_imputers(folded: DataFrame, features: Sequence[str], k: int) -> dict[int, MedianImputerModel]:
    """For each fold, the imputer of the rows outside it; all from one set of passes."""
    medians: dict[int, dict[str, float]] = {f: {} for f in range(k)}
    for r in fold_medians(folded, features, k).collect():
        medians[r["train_fold"]][r["column"]] = r["value"]
    return {f: MedianImputerModel(columns=list(features), medians=[float(m.get(c, float("nan"))) for c in features])
            for f, m in medians.items()}


def _fit_fold(learner, folded, f, features, label, params, iterations, proba, key, start, imputer, carry=(), binned=None):
    train = folded.where(F.col("fold") != f)
    val = folded.where(F.col("fold") == f)
    if iterations is None and learner.boosted:
        res = L.train_until_optimal(learner, train, val, features, label, params, start=start, imputer=imputer)
    else:
        res = L.fit(learner, train, features, label, params, iterations, imputer=imputer, binned=binned)
    own = list(dict.fromkeys([key, "fold", label, *carry]))
    # what is carried goes along under names of its own: the model may fill or drop the features
    rows = val.select(*features, *[F.col(c).alias(f"_own{i}") for i, c in enumerate(own)])
    pred = L.predict(res.model, rows, "prediction", proba)
    return f, res, pred.select(*[F.col(f"_own{i}").alias(c) for i, c in enumerate(own)], "prediction")


def cross_validate(df: DataFrame, learner: L.Learner, features: Sequence[str], label: str, key: str,
                   metric: str = "rmse", k: int = 5, seed: int = 0, groups=None, stratify=None,
                   params: Mapping | None = None, iterations: int | None = None, parallelism: int | None = None,
                   folded: DataFrame | None = None, start_rounds: int = 10,
                   folds: Sequence[int] | None = None, imputers: Mapping | None = None, carry: Sequence[str] = (), binned: dict | None = None) -> CVResult:
    """Per fold: fit the pipeline on the other folds, score the fold; OOF = union.

    ``carry``: more columns of ``folded`` that the out-of-fold rows keep.

    ``imputers``: ready-made ones by fold (``fold_imputers``), else made here.

    ``binned``: where forests leave the blocks of each fold's training rows for
    the next run over the same folds, imputers and features.

    The k fits are independent Spark jobs submitted concurrently (default
    min(k, 8) driver threads), so small per-iteration stages of one fit
    overlap with those of the others.
    """
    parallelism = parallelism or min(k, 8)
    m = M.check_compatible(metric, learner.objective)
    if folded is None:
        folded = write_folds(assign_folds(df.select(*_needed(key, label, features, groups, stratify)), key, k, seed, groups, stratify))
    proba = m is M.Metric.AUC
    imputers = imputers or fold_imputers(folded, features, k)
    run = list(folds) if folds is not None else list(range(k))     # a fold subset scores fewer folds
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        outs = list(ex.map(lambda f: _fit_fold(learner, folded, f, features, label, params, iterations,
                                               proba, key, start_rounds, imputers[f], carry,
                                               None if binned is None else binned.setdefault((f, *features), {})), run))
    oof = outs[0][2]
    for _, _, p in outs[1:]:
        oof = oof.unionByName(p)
    oof = cut_lineage(oof)          # scored once, then read by the metric and by every user of the result
    per = M.evaluate(oof, m, label, "prediction", by=["fold"])
    rounds = {f: r.rounds for f, r, _ in outs}
    spark = oof.sparkSession
    rframe = spark.createDataFrame([(int(f), rounds[f]) for f in rounds], "fold int, rounds int")
    per = per.join(rframe, "fold", "left")
    summ = M.cv_summary(per, m.value, "rounds").first()
    return CVResult(float(summ[0]), int(summ[1]), oof, per,
                    curves={f: r.curve for f, r, _ in outs}, models={f: r.model for f, r, _ in outs})


def comparison_frame(oof: DataFrame, key: str, label: str) -> DataFrame:
    """(key, real_values, predictions)."""
    return oof.select(key, F.col(label).alias("real_values"), F.col("prediction").alias("predictions"))


def validate_holdout(df: DataFrame, learner: L.Learner, features: Sequence[str], label: str, key: str,
                     metric: str = "rmse", test_size: float = 0.25, seed: int = 0,
                     params: Mapping | None = None, iterations: int | None = None):
    """(score, rounds, comparison frame) from one hash hold-out split."""
    m = M.check_compatible(metric, learner.objective)
    d = K.holdout(df, key, test_size, seed, "_valid")
    train, val = d.where(~F.col("_valid")), d.where(F.col("_valid"))
    if iterations is None and learner.boosted:
        res = L.train_until_optimal(learner, train, val, features, label, params)
    else:
        res = L.fit(learner, train, features, label, params, iterations)
    pred = L.predict(res.model, val, "prediction", m is M.Metric.AUC)
    score = M.evaluate_value(pred, m, label, "prediction")
    return score, (res.rounds or 0), comparison_frame(pred, key, label)


def _forget(binned: dict) -> None:
    for kept in binned.values():
        for _, rows, _ in kept.values():
            if rows.ctx._jsc is not None:              # else the session has ended
                rows.unpersist()
    binned.clear()


class CachedFolds:
    """Folds materialised once (checkpoint) and reused by every trial (K7),
    with an order-free fingerprint guard against a different input (K8)."""

    def __init__(self, df: DataFrame, key: str, label: str, features: Sequence[str], k: int = 5,
                 seed: int = 0, groups=None, stratify=None, carry: Sequence[str] = ()):
        cols = list(dict.fromkeys([*_needed(key, label, features, groups, stratify), *carry]))
        self.k, self.key, self.label, self.features, self.cols = k, key, label, list(features), cols
        self.carry = [ROW, *carry]
        folded = assign_folds(df.select(*cols), key, k, seed, groups, stratify)
        self.folded = write_folds(folded.withColumn(ROW, F.monotonically_increasing_id()))
        self.imputers = fold_imputers(self.folded, self.features, k)        # the same for every trial
        self.binned: dict = {}                                              # and so are the bins of a fold's training rows
        weakref.finalize(self, _forget, self.binned).atexit = False

    @functools.cached_property
    def print(self) -> tuple:
        return K.fingerprint(self.folded, self.cols)

    def check(self, df: DataFrame) -> None:
        """Refuse an input whose rows differ from the cached one (order-free)."""
        if K.fingerprint(df, self.cols) != self.print:
            raise ValueError("input differs from the cached folds")

    def only(self, features: Sequence[str]) -> CachedFolds:
        """The same folds for a learner that sees fewer features."""
        view = copy.copy(self)
        view.features, view.whole = list(features), self            # that keeps what the folds share
        return view

    def cross_validate(self, learner: L.Learner, metric: str = "rmse", params=None, iterations=None,
                       parallelism: int | None = None, df: DataFrame | None = None,
                       folds: Sequence[int] | None = None) -> CVResult:
        if df is not None:
            self.check(df)
        return cross_validate(None, learner, self.features, self.label, self.key, metric, self.k,
                              params=params, iterations=iterations, parallelism=parallelism,
                              folded=self.folded, folds=folds, imputers=self.imputers, carry=self.carry, binned=self.binned)
