"""Train-and-publish and batch scoring from a saved model directory.

A model directory holds: ``pipeline/`` (a PipelineModel: preprocessor if
given, imputer, assembler, learner, all fitted on training rows only), ``data_model/`` (the frozen
input schema) and ``meta/`` (features, key, weight and cut points).
Everything is written through Spark writers, so the directory can live on
any shared file system.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabfold.functions.columns import SEVERITY_CUTS, scaled_class
from tabfold.operators import sweep as W
from tabfold.plans import learners as L
from tabfold.plans import tuning
from tabfold.plans.validate import CachedFolds
from tabfold.session import cut_lineage, input_bytes, size_for_input
from tabfold.sources import schema as S

# fixed values: the published score weight
DEFAULT_WEIGHT = 1.2525


@dataclass
class Published:
    model_dir: str
    cv_score: float
    rounds: int
    weight: float


def save_meta(spark: SparkSession, path: str, meta: dict) -> None:
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_meta(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def size_session(df: DataFrame) -> None:
    """Set shuffle and split sizes from the volume of the files that ``df`` reads, if it reads files."""
    files = df.inputFiles()
    if files:
        folders = sorted({f.rsplit("/", 1)[0] for f in files})
        size_for_input(df.sparkSession, input_bytes(df.sparkSession, folders))


def prepare(spark: SparkSession, df: DataFrame, key: str, features: Sequence[str] | None, label: str, class_col: str | None,
            model_dir: str, preprocessor: Estimator | None, groups=None, stratify: str | None = None) -> tuple[list, list[str], DataFrame]:
    """Fit the preprocessor, settle the features, save the data model of raw rows; the training frame, materialised once.

    Returns the fitted first stages, the features, and the frame.
    """
    outside = {label, class_col, stratify, *([groups] if isinstance(groups, str) else list(groups or []))} - {None, key}
    first: list = []
    raw = df
    if preprocessor is not None:
        model = preprocessor.fit(df)
        first, df = [model], model.transform(df)
    if features is None:
        features = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))
                    and f.name != key and f.name not in outside]
    wanted = [c for c in raw.columns if c not in outside] if first else [key, *features]
    S.save_data_model(spark, raw.select(*dict.fromkeys(wanted)).schema, f"{model_dir}/data_model")
    return first, list(features), cut_lineage(df.select(*dict.fromkeys([key, label, *features, *sorted(outside)])))


def tuned_weight(oof: DataFrame, class_col: str, score: str, cuts: Sequence[float]) -> float:
    """The score weight that is best for out-of-fold rows that hold their class."""
    best = W.best_weight(W.sweep(oof, class_col, score, cuts)).first()
    return float(best["weight"]) if best is not None else DEFAULT_WEIGHT


def train_job(spark: SparkSession, df: DataFrame, key: str, features: Sequence[str] | None, label: str,
              class_col: str | None, learner: L.Learner, model_dir: str, k: int = 5,
              metric: str = "rmse", params: Mapping | None = None, tune_weight: bool = True,
              cuts: Sequence[float] = SEVERITY_CUTS, preprocessor: Estimator | None = None,
              grid: Sequence[Mapping] | None = None, final_params: Mapping | None = None,
              groups=None, stratify: str | None = None, sized: bool = False) -> Published:
    """Preprocess -> tune -> CV with OOF -> weight tuned on OOF classes -> final fit -> persist.

    ``preprocessor`` (say ``SurveyPreprocessor``) is fitted on the training
    rows and saved as the pipeline's first stage, so raw rows can be scored;
    ``features`` then default to the numeric columns it gives.  ``grid``: steps
    of a coordinate grid, searched on the same folds as the validation that
    follows with the parameters found.  Classifiers get folds stratified by
    their label unless told otherwise.  ``sized`` sets the session's shuffle
    and split sizes from the input's volume first.

    The input is materialised once (reliable checkpoint): folds, weight sweep
    and final fit all read it.
    """
    if sized:
        size_session(df)
    first, features, df = prepare(spark, df, key, features, label, class_col, model_dir, preprocessor, groups, stratify)
    if stratify is None and learner.objective == "classification":
        stratify = label
    cache = CachedFolds(df, key, label, features, k, groups=groups, stratify=stratify, carry=[class_col] if class_col else [])
    if grid:
        params = tuning.tune_grid(spark, cache, learner, metric, grid, final_params).params
    elif final_params:
        params = L.merge_params(params, final_params)
    cv = cache.cross_validate(learner, metric, params)
    weight = tuned_weight(cv.oof, class_col, "prediction", cuts) if tune_weight and class_col is not None else DEFAULT_WEIGHT
    rounds = cv.rounds if learner.boosted else None
    final = L.fit(learner, df, features, label, params, rounds)
    PipelineModel(stages=[*first, *final.model.stages]).write().overwrite().save(f"{model_dir}/pipeline")
    save_meta(spark, f"{model_dir}/meta", {"key": key, "features": list(features), "label": label,
                                          "weight": weight, "cuts": list(cuts), "rounds": rounds})
    return Published(model_dir, cv.score, cv.rounds, weight)


@dataclass
class Scorer:
    model: PipelineModel
    data_model: dict
    meta: dict

    @classmethod
    def load(cls, spark: SparkSession, model_dir: str) -> "Scorer":
        return cls(PipelineModel.load(f"{model_dir}/pipeline"),
                   S.load_data_model(spark, f"{model_dir}/data_model"),
                   load_meta(spark, f"{model_dir}/meta"))

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(accepted, rejects): rows as the frozen columns; rejects have a ``reason``.

        A row is rejected if its key is missing, or a value does not fit its
        column's type.  Missing features are for the imputer.
        """
        told = S.with_reasons(df, self.data_model, required=[self.meta["key"]], reason="_reason")
        return (told.where(F.col("_reason").isNull()).drop("_reason"),
                told.where(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason"))

    def score(self, df: DataFrame, weight: float | None = None) -> DataFrame:
        """Enforce the frozen schema -> pipeline -> score -> class (key, score, class).

        Rows that cannot be scored are those of ``split(df)[1]``.
        """
        key = self.meta["key"]
        scored = self.model.transform(self.split(df)[0])
        w = float(weight if weight is not None else self.meta.get("weight", DEFAULT_WEIGHT))
        return scored.select(key, F.col("prediction").alias("score"),
                             scaled_class("prediction", w, self.meta.get("cuts", SEVERITY_CUTS)).alias("class"))
