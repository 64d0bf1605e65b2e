"""Permutation importance: metric loss when one feature's values are shuffled.

Rows go to hash buckets once, buckets of some ten thousand rows to tasks of
about two: what a task holds does not grow with the data.  For each repeat a bucket's rows are put into a
pseudo-random order (a seeded hash of the key) and every row sees the features
of the one after it, the last those of the first: one random cycle a bucket.

The pipeline up to its vector runs once; rows are then a label, their vector
and, for each repeat, the vector of another row, written to the shared folder.
A variant of a row is its vector with one slot from the other row's: a small
(slot, repeat) pair until it is scored.  Variants come in batches of
``BATCH``, so neither the plan nor a row grows with features times repeats.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabfold.operators import metrics as M
from tabfold.session import scratch_path

BATCH = 64                       # variants of a row that are scored in one pass
ROWS_PER_BUCKET = 10_000         # rows of a bucket, about: their number grows with the data
MIN_BUCKETS = 32


def with_permuted(df: DataFrame, key: str, features: Sequence[str], repeats: int, seed: int = 0,
                  buckets: int | None = None) -> DataFrame:
    """``df`` with ``_p0`` ... : for each repeat, the features of another row of the bucket."""
    kc = F.col(key).cast("string")
    buckets = buckets or max(MIN_BUCKETS, -(-df.count() // ROWS_PER_BUCKET))
    out = df.withColumn("_x", F.struct(*features)).withColumn("_bk", F.pmod(F.xxhash64(F.lit(seed), F.lit("b"), kc), F.lit(buckets)))
    out = _dealt(out, buckets)
    for r in range(repeats):
        w = Window.partitionBy("_bk").orderBy(F.xxhash64(F.lit(seed), F.lit(f"r{r}"), kc), key)
        out = out.withColumn(f"_p{r}", F.coalesce(F.lead("_x").over(w), F.first("_x").over(w)))
    return out.drop("_bk", "_x")


def _dealt(df: DataFrame, buckets: int) -> DataFrame:
    """Buckets dealt over tasks whose number grows with theirs: a task sorts its rows once a repeat, each time wider."""
    return df.repartition(min(buckets, max(MIN_BUCKETS, buckets // 2)), "_bk")


def permute_column(df: DataFrame, key: str, col: str, seed: int, buckets: int | None = None) -> DataFrame:
    """``df`` with the values of one column permuted within buckets."""
    return with_permuted(df, key, [col], 1, seed, buckets).withColumn(col, F.col("_p0").getField(col)).drop("_p0")


def permutation_importance(model: PipelineModel, df: DataFrame, key: str, features: Sequence[str],
                           label: str, metric: str = "rmse", repeats: int = 10, seed: int = 0) -> DataFrame:
    """(feature, repeat, baseline, permuted, delta); delta > 0 means the feature helps.

    ``features`` are columns of ``df`` that the pipeline's vector is assembled
    from; one that the pipeline dropped (it had no value) makes no difference.
    """
    m, spark, features = M.Metric(metric), df.sparkSession, list(features)
    at = next(i for i, s in enumerate(model.stages) if isinstance(s, VectorAssembler))
    vector = model.stages[at]
    first, rest = PipelineModel(stages=model.stages[:at + 1]), PipelineModel(stages=model.stages[at + 1:])
    slots = {c: i for i, c in enumerate(vector.getInputCols())}
    out = vector.getOutputCol()
    rows = first.transform(df.select(*dict.fromkeys([key, label, *features]))).select(
        F.col(key).alias("_key"), F.col(label).alias("_label"), vector_to_array(out).alias("_vec"))
    path = scratch_path(spark, f"permuted-{uuid.uuid4().hex}")
    with_permuted(rows, "_key", ["_vec"], repeats, seed).drop("_key").write.parquet(path)
    rows = spark.read.parquet(path)

    def scored(variants: list[tuple[int, int]]) -> dict[tuple[int, int], float]:
        """The metric by (slot, repeat); slot -1: nothing is permuted."""
        pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("slot"), F.lit(r).alias("repeat")) for i, r in variants])).alias("v")
        used = sorted({r for _, r in variants if r >= 0})
        other = F.coalesce(*[F.when(F.col("v.repeat") == r, F.get(F.col(f"_p{r}._vec"), F.col("v.slot"))) for r in used], F.lit(None).cast("double")) \
            if used else F.lit(None).cast("double")
        each = rows.select("_label", "_vec", *[f"_p{r}" for r in used], pairs).select("_label", "_vec", "v.slot", "v.repeat", other.alias("_other"))
        mixed = F.transform("_vec", lambda x, i: F.when(i == F.col("slot"), F.col("_other")).otherwise(x))
        each = each.select(F.col("_label").alias(label), "slot", "repeat", array_to_vector(mixed).alias(out))
        return {(r["slot"], r["repeat"]): float(r[m.value]) for r in
                M.evaluate(rest.transform(each), m, label, "prediction", by=["slot", "repeat"]).collect()}
    base = scored([(-1, -1)]).get((-1, -1), float("nan"))
    wanted = [(slots[f], r) for f in features if f in slots for r in range(repeats)]
    told: dict[tuple[int, int], float] = {}
    for lo in range(0, len(wanted), BATCH):
        told |= scored(wanted[lo:lo + BATCH])
    lines = []
    for f in sorted(features):
        for r in range(repeats):
            s = told.get((slots[f], r), float("nan")) if f in slots else base
            lines.append((f, r, base, s, (base - s) if m.maximise else (s - base)))
    return spark.createDataFrame(lines, "feature string, repeat int, baseline double, permuted double, delta double")
