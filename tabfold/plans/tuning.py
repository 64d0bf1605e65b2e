"""Hyper-parameter search: sequential (coordinate) grid, plain CV grid,
seeded random search, optimal boosting rounds.  Every trial is a
cross-validation job on cached folds; trials are recorded in a frame."""

from __future__ import annotations

import itertools
import json
import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfold.operators import metrics as M
from tabfold.plans import learners as L
from tabfold.plans.validate import CachedFolds


class MetricEvaluator(Evaluator):
    """Any metric of ``operators.metrics`` (AUC exact, from the positive class's probability) for Spark's tuners."""

    def __init__(self, metric: str, label: str):
        super().__init__()
        self.metric, self.label = M.Metric(metric), label

    def isLargerBetter(self) -> bool:
        return self.metric.maximise

    def _evaluate(self, dataset: DataFrame) -> float:
        score = "prediction"
        if self.metric is M.Metric.AUC and "probability" in dataset.columns:
            dataset, score = dataset.withColumn("_p", vector_to_array("probability")[1]), "_p"
        return M.evaluate_value(dataset, self.metric, self.label, score)


# ------------------------------------------------------------------ search spaces

@dataclass(frozen=True)
class Uniform:
    low: float
    high: float

    def sample(self, rng: random.Random):
        return rng.uniform(self.low, self.high)


@dataclass(frozen=True)
class LogUniform:
    """Natural bounds (not exponents)."""
    low: float
    high: float

    def sample(self, rng: random.Random):
        return math.exp(rng.uniform(math.log(self.low), math.log(self.high)))


@dataclass(frozen=True)
class IntStep:
    low: int
    high: int
    step: int = 1

    def sample(self, rng: random.Random):
        return int(rng.randrange(self.low, self.high + 1, self.step))


@dataclass(frozen=True)
class Choice:
    options: tuple

    def sample(self, rng: random.Random):
        return rng.choice(list(self.options))


@dataclass(frozen=True)
class Step:
    """A step of a coordinate grid; ``recalibrate``: the rounds are found again, with the best parameters so far, before it."""
    grid: Mapping[str, Sequence]
    recalibrate: bool = False


# fixed values: the default steps and spaces of boosted trees (those parameters that Spark's trees have)
BOOSTED_STEPS = (
    Step({"max_depth": tuple(range(3, 10)), "min_child_weight": tuple(range(1, 6))}),
    Step({"gamma": (0.0, 0.1, 0.2, 0.3, 0.4)}),
    Step({"subsample": (0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95), "colsample_bytree": (0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95)}, recalibrate=True),
)
BOOSTED_SPACE = {"max_depth": IntStep(3, 10), "min_child_weight": IntStep(1, 6), "gamma": Uniform(0.0, 0.5),
                 "colsample_bytree": Uniform(0.5, 1.0), "subsample": Uniform(0.5, 1.0)}


def default_steps(learner: L.Learner) -> tuple[Step, ...]:
    """The steps of a learner's coordinate grid: those of boosted trees, else its own grid as one step."""
    return BOOSTED_STEPS if learner.boosted else (Step(learner.grid),) if learner.grid else ()


def _better(score: float, best: float, maximise: bool) -> bool:
    return score > best if maximise else score < best


@dataclass
class TuneResult:
    params: dict
    score: float
    trials: DataFrame       # (step, trial, params, score[, rounds])


def optimal_rounds(cache: CachedFolds, learner: L.Learner, metric: str, params=None) -> int:
    """H4: mean early-stopped rounds over the folds."""
    return cache.cross_validate(learner, metric, params).rounds


def tune_grid(spark: SparkSession, cache: CachedFolds, learner: L.Learner, metric: str,
              steps: Sequence[Mapping[str, Sequence] | Step] | None = None, final_params: Mapping | None = None,
              recalibrate: bool = True, parallelism: int | None = None) -> TuneResult:
    """H1: coordinate grid (default: the learner's own steps).  Each step's grid is merged into the best so far;
    strict improvement, first wins; maximised metrics start at -inf.

    ``recalibrate``: a boosted learner's rounds are found by patience first,
    and again before a step that asks for it; trials then use them.  Without
    it every trial stops by its own patience.
    """
    m = M.Metric(metric)
    current = dict(learner.params)
    rows, trial, score = [], 0, float("nan")
    counted = recalibrate and learner.boosted
    rounds = max(1, optimal_rounds(cache, learner, metric, current)) if counted else None
    for si, step in enumerate(default_steps(learner) if steps is None else steps):
        step = step if isinstance(step, Step) else Step(step)
        if step.recalibrate and counted and si:
            rounds = max(1, optimal_rounds(cache, learner, metric, current))
        names = list(step.grid)
        best, best_p = (-math.inf if m.maximise else math.inf), None
        for combo in itertools.product(*[step.grid[n] for n in names]):
            p = L.merge_params(current, dict(zip(names, combo)))
            res = cache.cross_validate(learner, metric, p, iterations=rounds, parallelism=parallelism)
            rows.append((si, trial, json.dumps(p, sort_keys=True, default=str), float(res.score), rounds))
            trial += 1
            if _better(res.score, best, m.maximise):
                best, best_p = res.score, p
        if best_p is not None:
            current, score = best_p, best
    current = L.merge_params(current, final_params)
    trials = spark.createDataFrame(rows, "step int, trial int, params string, score double, rounds int")
    return TuneResult(current, score, trials)


def tune_grid_cv(df_folded: DataFrame, learner: L.Learner, features: Sequence[str], label: str,
                 metric: str, grid: Mapping[str, Sequence], parallelism: int = 2, k: int | None = None):
    """H2: Spark's CrossValidator over a ParamGridBuilder grid, folds from the ``fold`` column."""
    if k is None:
        k = int(df_folded.agg(F.max("fold")).first()[0]) + 1
    pipe = L.build_pipeline(learner, features, label)
    est = pipe.getStages()[-1]
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(est.getParam(L.spark_params({name: values[0]}).popitem()[0]), list(values))
    m = M.Metric(metric)
    ev = MetricEvaluator(m.value, label)
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=b.build(), evaluator=ev,
                        foldCol="fold", numFolds=k, parallelism=parallelism, seed=0)
    model = cv.fit(df_folded)
    return model, list(zip([{p.name: v for p, v in pm.items()} for pm in b.build()], model.avgMetrics))


def random_search(spark: SparkSession, cache: CachedFolds, learner: L.Learner, metric: str,
                  space: Mapping[str, object], trials: int = 20, seed: int = 0,
                  parallelism: int | None = None, halving: bool = False) -> TuneResult:
    """H3: seeded random search; sampled values are always merged into the starter params.

    ``halving``: every trial is first scored on a two-fold subset (step 0);
    the better half is then scored on all folds (step 1) and the best full
    score wins.
    """
    m = M.Metric(metric)
    rng = random.Random(seed)
    cands = [L.merge_params(learner.params, {k: v.sample(rng) for k, v in space.items()}) for _ in range(trials)]
    rows = []
    if halving and cache.k > 2 and trials > 1:
        scored = []
        for t, p in enumerate(cands):
            res = cache.cross_validate(learner, metric, p, parallelism=parallelism, folds=[0, 1])
            rows.append((0, t, json.dumps(p, sort_keys=True, default=str), float(res.score)))
            scored.append((res.score, t))
        scored.sort(key=lambda x: (-x[0] if m.maximise else x[0], x[1]))
        keep = sorted(t for _, t in scored[: (len(scored) + 1) // 2])
    else:
        keep = list(range(trials))
    best, best_p = (-math.inf if m.maximise else math.inf), dict(learner.params)
    for t in keep:
        p = cands[t]
        res = cache.cross_validate(learner, metric, p, parallelism=parallelism)
        rows.append((1 if halving else 0, t, json.dumps(p, sort_keys=True, default=str), float(res.score)))
        if _better(res.score, best, m.maximise):
            best, best_p = res.score, p
    return TuneResult(best_p, best, spark.createDataFrame(rows, "step int, trial int, params string, score double"))
