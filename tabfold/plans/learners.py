"""Learners: one contract around Spark ML estimators.

Boosted trees (GBT) carry the regression and binary-classification families;
random forest, linear regression, factorization machines and a multilayer
perceptron are the other registered learners.  Parameters from the common
boosted-tree vocabulary are mapped to Spark names; parameters with no Spark
counterpart are refused loudly.

Early stopping (``train_until_optimal``) uses patience: trees are grown in
blocks on a margin column (``plans.boosting``), every prefix of a block is
scored on the validation rows in one pass, and the best prefix is kept when
``patience`` rounds did not improve on it.  No tree is fitted twice.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import FMRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabfold.operators.impute import MedianImputer
from tabfold.plans import boosting as B
from tabfold.plans import factorization as FM
from tabfold.plans.boosting import patience_best  # noqa: F401

# fixed values: boosted-tree parameter names -> Spark ML names
PARAM_MAP = {
    "learning_rate": "stepSize", "eta": "stepSize",
    "max_depth": "maxDepth", "depth": "maxDepth",
    "min_child_weight": "minInstancesPerNode", "min_child_samples": "minInstancesPerNode",
    "min_data_in_leaf": "minInstancesPerNode", "min_samples_leaf": "minInstancesPerNode",
    "gamma": "minInfoGain", "min_split_gain": "minInfoGain",
    "subsample": "subsamplingRate", "bagging_fraction": "subsamplingRate",
    "colsample_bytree": "featureSubsetStrategy", "colsample_bylevel": "featureSubsetStrategy",
    "feature_fraction": "featureSubsetStrategy", "rsm": "featureSubsetStrategy",
    "max_bin": "maxBins", "max_bins": "maxBins", "border_count": "maxBins",
    "n_estimators": "maxIter", "iterations": "maxIter", "max_iter": "maxIter",
}
# fixed values: parameters with no Spark counterpart
UNSUPPORTED = {"reg_alpha", "reg_lambda", "lambda_l1", "lambda_l2", "l2_leaf_reg", "bagging_temperature",
               "random_strength", "num_leaves", "max_leaf_nodes", "scale_pos_weight"}

MAX_ROUNDS = 2000
ROUNDS_KEPT = 10                # rounds between two checkpoints of the margins, where no rows are validated


def merge_params(*dicts: Mapping | None) -> dict:
    """One dict under Spark names: later dicts win, whatever alias each uses.

    Two aliases of one parameter within a dict are refused.
    """
    out: dict = {}
    for d in dicts:
        own: dict = {}
        for k, v in (d or {}).items():
            name = PARAM_MAP.get(k, k)
            if name in own:
                raise ValueError(f"{k!r} and another name for {name!r} are both given")
            own[name] = v
        out.update(own)
    return out


def spark_params(params: Mapping) -> dict:
    """Translate a parameter dict to Spark ML names (fails on unsupported names)."""
    out = {}
    for k, v in params.items():
        if k in UNSUPPORTED:
            raise ValueError(f"parameter {k!r} has no Spark ML counterpart")
        name = PARAM_MAP.get(k, k)
        if name == "featureSubsetStrategy" and not isinstance(v, str):
            v = repr(float(v))
        if name in ("maxDepth", "minInstancesPerNode", "maxBins", "maxIter"):
            v = int(v)
        out[name] = v
    return out


_KINDS = {
    "gbt_regressor": (GBTRegressor, "regression", True),
    "gbt_classifier": (GBTClassifier, "classification", True),
    "rf_regressor": (RandomForestRegressor, "regression", False),
    "rf_classifier": (RandomForestClassifier, "classification", False),
    "linear": (LinearRegression, "regression", False),
    "fm_regressor": (FMRegressor, "regression", False),
    "mlp_classifier": (MultilayerPerceptronClassifier, "classification", False),
    "gbt_multiclass": (GBTClassifier, "classification", True),      # softmax boosting on shared margins
}


@dataclass
class Learner:
    """A Spark ML estimator with starter parameters and a search space."""
    kind: str
    params: dict = field(default_factory=dict)
    seed: int = 0
    early_stopping_rounds: int = 10
    grid: dict = field(default_factory=dict)

    @property
    def objective(self) -> str:
        return _KINDS[self.kind][1]

    @property
    def boosted(self) -> bool:
        return _KINDS[self.kind][2]

    def estimator(self, features: str = "features", label: str = "label",
                  params: Mapping | None = None, rounds: int | None = None,
                  n_features: int | None = None) -> Estimator:
        cls = _KINDS[self.kind][0]
        p = spark_params(merge_params(self.params, params))
        if rounds is not None and self.boosted:
            p["maxIter"] = int(rounds)
        if cls().hasParam("seed"):
            p.setdefault("seed", self.seed)
        if self.kind == "mlp_classifier" and "layers" not in p and n_features:
            p["layers"] = [n_features, 2 * n_features + 1, int(p.pop("numClasses", 2))]
        if self.kind == "gbt_multiclass":
            raise ValueError("several classes are boosted together: use fit or train_until_optimal")
        return cls(featuresCol=features, labelCol=label, **p)

    def with_params(self, **params) -> "Learner":
        return Learner(self.kind, merge_params(self.params, params), self.seed, self.early_stopping_rounds, self.grid)


class PresentAssembler(Estimator):
    """Fits to a ``VectorAssembler`` of those features that the imputer kept
    (it drops columns without any value in the training rows)."""

    def __init__(self, features: Sequence[str], out: str = "features"):
        super().__init__()
        self.features, self.out = list(features), out

    def _fit(self, df: DataFrame) -> VectorAssembler:
        left = [c for c in self.features if c in df.columns]
        if not left:
            raise ValueError("every feature is empty in the training rows")
        return VectorAssembler(inputCols=left, outputCol=self.out, handleInvalid="keep")


def assembler(features: Sequence[str], out: str = "features") -> PresentAssembler:
    return PresentAssembler(features, out)


def build_pipeline(learner: Learner, features: Sequence[str], label: str,
                   params: Mapping | None = None, rounds: int | None = None,
                   impute: bool = True, imputer=None) -> Pipeline:
    """imputer -> assembler -> learner (fitted together on training rows only; ``imputer``: one that is fitted already)."""
    stages = [imputer or MedianImputer(inputCols=list(features))] if impute else []
    stages += [assembler(features), learner.estimator("features", label, params, rounds, len(features))]
    return Pipeline(stages=stages)


def _loss_name(learner: Learner) -> str | None:
    return "squared" if learner.objective == "regression" else None


def iteration_curve(model, data: DataFrame, learner: Learner) -> list[float]:
    """Validation loss after each tree (one pass over the validation rows)."""
    if learner.objective == "regression":
        return list(model.evaluateEachIteration(data, _loss_name(learner)))
    return list(model.evaluateEachIteration(data))


@dataclass
class FitResult:
    model: PipelineModel
    rounds: int | None
    curve: list[float]


def _prepared(train: DataFrame, features: Sequence[str], label: str, imputer) -> tuple[list, DataFrame]:
    """Fitted imputer and assembler, and the rows as (features, label)."""
    prep = Pipeline(stages=[imputer or MedianImputer(inputCols=list(features)), assembler(features)]).fit(train)
    return list(prep.stages), _vectors(prep.stages, train, label)


def _vectors(stages: Sequence, rows: DataFrame, label: str) -> DataFrame:
    return PipelineModel(stages=list(stages)).transform(rows).select("features", F.col(label).cast("double").alias("label"))


def _n_classes(rows: DataFrame) -> int:
    """Classes are 0 .. the largest label."""
    top = rows.agg(F.max("label")).first()[0]
    return max(2, int(top) + 1) if top is not None else 2


def train_until_optimal(learner: Learner, train: DataFrame, val: DataFrame, features: Sequence[str],
                        label: str, params: Mapping | None = None, start: int = 10,
                        max_rounds: int = MAX_ROUNDS, imputer=None) -> FitResult:
    """Fit with patience-based early stopping on ``val``; boosted learners only.

    ``start``: rounds between two looks at the validation rows.
    """
    if not learner.boosted:
        return fit(learner, train, features, label, params, imputer=imputer)
    p = spark_params(merge_params(learner.params, params))
    seed, stages = int(p.pop("seed", learner.seed)), None
    stages, tr = _prepared(train, features, label, imputer)
    va, n_features = _vectors(stages, val, label), len(stages[-1].getInputCols())
    if learner.kind == "gbt_multiclass":
        n = _n_classes(tr)
        made = B.grow_classes(tr, n, p, seed, max_rounds, va, learner.early_stopping_rounds, start)
        return FitResult(PipelineModel(stages=[*stages, *B.class_stages(made, n, n_features)]), made.best, made.curve[:made.best])
    classifier = learner.objective == "classification"
    loss = "logistic" if classifier else p.get("lossType", "squared")
    made = B.grow(tr, va, loss, p, seed, learner.early_stopping_rounds, start, max_rounds)
    model = B.gbt_model(made.trees[:made.best], made.weights[:made.best], n_features, classifier)
    return FitResult(PipelineModel(stages=[*stages, model]), made.best, made.curve[:made.best])


def fit(learner: Learner, train: DataFrame, features: Sequence[str], label: str,
        params: Mapping | None = None, rounds: int | None = None, imputer=None, binned: dict | None = None) -> FitResult:
    """Fixed-round (or non-boosted) fit of the whole pipeline.

    ``binned``: where a forest leaves the blocks of its rows for the next fit
    on the same rows and features (``boosting.forest``).
    """
    if learner.kind == "gbt_multiclass":
        p = spark_params(merge_params(learner.params, params))
        rounds = int(rounds if rounds is not None else p.get("maxIter", 20))
        stages, tr = _prepared(train, features, label, imputer)
        n = _n_classes(tr)
        made = B.grow_classes(tr, n, p, int(p.pop("seed", learner.seed)), rounds)
        return FitResult(PipelineModel(stages=[*stages, *B.class_stages(made, n, len(stages[-1].getInputCols()))]), rounds, made.curve)
    p = spark_params(merge_params(learner.params, params)) if learner.boosted else {}
    if learner.boosted and p.keys() <= set(B.PARAMS):            # others are left to Spark's own estimator
        classifier = learner.objective == "classification"
        stages, tr = _prepared(train, features, label, imputer)
        made = B.grow(tr, None, "logistic" if classifier else p.get("lossType", "squared"), p, int(p.get("seed", learner.seed)), None, ROUNDS_KEPT,
                      int(rounds if rounds is not None else p.get("maxIter", 20)), binary=classifier)
        model = B.gbt_model(made.trees, made.weights, len(stages[-1].getInputCols()), classifier)
        return FitResult(PipelineModel(stages=[*stages, model]), rounds, [])
    if learner.kind == "rf_regressor" and (p := spark_params(merge_params(learner.params, params))).keys() <= set(B.FOREST_PARAMS):
        stages, tr = _prepared(train, features, label, imputer)
        trees, n_features = B.forest(tr, p, int(p.get("seed", learner.seed)), binned=binned), len(stages[-1].getInputCols())
        return FitResult(PipelineModel(stages=[*stages, B.forest_model(trees, n_features)]), None, [])
    if learner.kind == "fm_regressor" and FM.by_sums(machine := learner.estimator("features", "label", params), len(features)):
        stages, tr = _prepared(train, features, label, imputer)
        return FitResult(PipelineModel(stages=[*stages, FM.fit(machine, tr, len(stages[-1].getInputCols()))]), None, [])
    pm = build_pipeline(learner, features, label, params, rounds, imputer=imputer).fit(train)
    return FitResult(pm, rounds if learner.boosted else None, [])


def predict(model: PipelineModel, df: DataFrame, out: str = "prediction", proba: bool = False) -> DataFrame:
    """Prediction column (or positive-class probability for classifiers with ``proba``)."""
    scored = model.transform(df)
    if proba:
        told = F.col("probability") if isinstance(scored.schema["probability"].dataType, T.ArrayType) else vector_to_array("probability")
        scored = scored.withColumn(out, told[1])
    elif out != "prediction":
        scored = scored.withColumnRenamed("prediction", out)
    drop = [c for c in ("features", "rawPrediction", "probability", "_parts") if c in scored.columns]
    drop += [c for c in scored.columns if c.startswith("_margin")]
    if proba and "prediction" in scored.columns and out != "prediction":
        drop.append("prediction")
    return scored.drop(*drop)


def feature_importance(model: PipelineModel, features: Sequence[str], top: int = 50) -> DataFrame:
    """(feature, importance %) of a tree model, top-N by importance then name (both desc)."""
    trees = [s for s in model.stages if hasattr(s, "featureImportances")]         # several for several classes
    imp = sum(t.featureImportances.toArray() for t in trees) / len(trees)
    tot = float(imp.sum()) or 1.0
    spark = SparkSession.getActiveSession()
    vector = next(s for s in model.stages if isinstance(s, VectorAssembler))
    used = dict(zip(vector.getInputCols(), imp))          # features without any value were dropped
    rows = [(f, float(used.get(f, 0.0)) * 100.0 / tot) for f in features]
    return (spark.createDataFrame(rows, "feature string, importance double")
                 .orderBy(F.col("importance").desc(), F.col("feature").desc()).limit(top))


def loss_frame(spark, curves: Mapping[int, Sequence[float]], metric: str) -> DataFrame:
    """Long (fold, iteration, metric, value) table of validation curves."""
    rows = [(int(f), i + 1, metric, float(v)) for f, c in curves.items() for i, v in enumerate(c)]
    return spark.createDataFrame(rows, "fold int, iteration int, metric string, value double")


def params_json(params: Mapping) -> str:
    return json.dumps(dict(sorted(params.items())), default=str)


# starter learners; fixed values: the default grids
def default_learner(kind: str = "gbt_regressor") -> Learner:
    if kind.startswith("gbt"):
        return Learner(kind, {"maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.8},
                       grid={"maxDepth": [3, 4, 5, 6, 7, 8, 9], "minInstancesPerNode": [1, 2, 3, 4, 5],
                             "minInfoGain": [0.0, 0.1, 0.2, 0.3, 0.4],
                             "subsamplingRate": [0.6, 0.7, 0.8, 0.9, 0.95]})
    if kind.startswith("rf"):
        return Learner(kind, {"numTrees": 20, "maxDepth": 6},
                       grid={"maxDepth": [4, 6, 8], "numTrees": [20, 50]})
    if kind == "linear":
        return Learner(kind, {"regParam": 0.0}, grid={"regParam": [0.0, 0.01, 0.1]})
    if kind == "fm_regressor":
        return Learner(kind, {"factorSize": 4, "maxIter": 50}, grid={"factorSize": [2, 4, 8]})
    if kind == "mlp_classifier":
        return Learner(kind, {"maxIter": 100}, grid={"blockSize": [64, 128]})
    raise ValueError(kind)
