"""Distributed metrics: MAE, MSE, RMSE, accuracy, AUC (exact), kappa, confusion.

Everything is an aggregation with map-side partial combine.  Class-based
metrics first reduce the rows to the (label, prediction) count table, whose
size is bounded by the number of classes squared; classes are ranked within
the plan, so their number is not limited.
"""

from __future__ import annotations

from collections.abc import Sequence
from enum import Enum

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyspark import StorageLevel

from tabfold.operators.prefix import running_sums_by

AUC_ROWS = 100_000            # distinct scores of a quantile bucket of the exact AUC, about


class Metric(str, Enum):
    MAE = "mae"
    MSE = "mse"
    RMSE = "rmse"
    AUC = "auc"
    ACCURACY = "accuracy"
    QWK = "qwk"
    KAPPA = "kappa"

    @property
    def maximise(self) -> bool:
        return self in (Metric.AUC, Metric.ACCURACY, Metric.QWK, Metric.KAPPA)

    @property
    def objective(self) -> str:
        return "regression" if self in (Metric.MAE, Metric.MSE, Metric.RMSE) else "classification"


def check_compatible(metric: Metric | str, objective: str) -> Metric:
    m = Metric(metric)
    if objective == "regression" and m.objective != "regression" and m not in (Metric.QWK, Metric.KAPPA):
        raise ValueError(f"metric {m.value} does not fit a regression objective")
    if objective == "classification" and m.objective == "regression":
        raise ValueError(f"metric {m.value} does not fit a classification objective")
    return m


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ------------------------------------------------------------------ regression

def regression_metrics(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """n, mae, mse, rmse per group (or overall)."""
    err = _c(label).cast("double") - _c(pred).cast("double")
    g = df.groupBy(*by) if by else df.groupBy()
    return (g.agg(F.count(err).alias("n"), F.avg(F.abs(err)).alias("mae"),
                  F.avg(err * err).alias("mse"))
             .withColumn("rmse", F.sqrt("mse")))


def accuracy(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(F.avg((_c(label) == _c(pred)).cast("double")).alias("accuracy"))


def cv_summary(per_fold: DataFrame, metric: str, rounds: str | None = None) -> DataFrame:
    """Macro mean of per-fold metrics; rounds = floor(mean(coalesce(r, 0)))."""
    aggs = [F.avg(metric).alias(f"cv_{metric}")]
    if rounds:
        aggs.append(F.floor(F.avg(F.coalesce(F.col(rounds), F.lit(0)))).cast("bigint").alias("cv_rounds"))
    return per_fold.agg(*aggs)


# ------------------------------------------------------------------ class tables

def confusion(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Long confusion table (by..., real, pred, n) of non-null pairs."""
    return (df.where(_c(label).isNotNull() & _c(pred).isNotNull())
              .groupBy(*by, _c(label).alias("real"), _c(pred).alias("pred"))
              .agg(F.count(F.lit(1)).alias("n")))


def confusion_wide(conf: DataFrame, classes: Sequence) -> DataFrame:
    """real x pred matrix with zero fill (classes given, so the pivot is bounded)."""
    return (conf.groupBy("real").pivot("pred", list(classes)).agg(F.sum("n"))
                .fillna(0))


def ranked_classes(conf: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """(within..., _class, _rank): ranks from 0 in the sorted union of real and predicted classes."""
    both = conf.select(*within, F.explode(F.array(F.col("real"), F.col("pred"))).alias("_class")).distinct()
    # numbered over the distinct classes, not the rows
    return both.withColumn("_rank", (F.row_number().over(Window.partitionBy(*within).orderBy("_class")) - 1).cast("double"))


def _with_ranks(conf: DataFrame, within: Sequence[str]) -> DataFrame:
    ranks = ranked_classes(conf, within)
    for side, name in (("real", "_i"), ("pred", "_j")):
        own = ranks.select(*[F.col(c).alias(f"_w{i}") for i, c in enumerate(within)], F.col("_class").alias("_c"), F.col("_rank").alias(name))
        on = F.col(side) == F.col("_c")
        for i, c in enumerate(within):
            on = on & F.col(c).eqNullSafe(F.col(f"_w{i}"))
        conf = conf.join(own, on).drop("_c", *[f"_w{i}" for i in range(len(within))])
    return conf


def kappa_from_confusion(conf: DataFrame, weights: str = "quadratic", by: Sequence[str] = (),
                         rank_within: Sequence[str] = ()) -> DataFrame:
    """Cohen's kappa from a long confusion table, classes ranked in the sorted union
    (of the whole table, or of each group of ``rank_within``).

    quadratic: 1 - Σ(i-j)²·O / Σ(i-j)²·E, and with row/column marginals r, c
    Σ(i-j)²·E = Σr·i² + Σc·j² - 2·(Σr·i)(Σc·j)/N, so only sums are needed.
    unweighted: 1 - (N - Σ_diag O) / (N - Σ_i r_i c_i / N).
    """
    t = _with_ranks(conf, list(rank_within))
    g = t.groupBy(*by) if by else t.groupBy()
    if weights == "quadratic":
        s = g.agg(F.sum("n").alias("_N"),
                  F.sum(F.col("n") * (F.col("_i") - F.col("_j")) ** 2).alias("_o"),
                  F.sum(F.col("n") * F.col("_i") ** 2).alias("_r2"),
                  F.sum(F.col("n") * F.col("_j") ** 2).alias("_c2"),
                  F.sum(F.col("n") * F.col("_i")).alias("_r1"),
                  F.sum(F.col("n") * F.col("_j")).alias("_c1"))
        e = F.col("_r2") + F.col("_c2") - 2 * F.col("_r1") * F.col("_c1") / F.col("_N")
        return s.select(*by, (1 - F.try_divide(F.col("_o"), e)).alias("qwk"))
    if weights in (None, "none", "unweighted"):
        keys = list(by) or ["_g"]
        t = t.withColumn("_g", F.lit(0)) if not by else t
        rows = t.groupBy(*keys, "_i").agg(F.sum("n").alias("_r"))
        cols = t.groupBy(*keys, "_j").agg(F.sum("n").alias("_c")).withColumnRenamed("_j", "_i")
        pe = rows.join(cols, [*keys, "_i"], "inner").groupBy(*keys) \
                 .agg(F.sum(F.col("_r") * F.col("_c")).alias("_rc"))
        s = t.groupBy(*keys).agg(
            F.sum("n").alias("_N"),
            F.sum(F.when(F.col("_i") == F.col("_j"), F.col("n")).otherwise(0)).alias("_d"))
        n = F.col("_N")
        return (s.join(pe, keys, "left").fillna(0, ["_rc"])
                 .select(*by, (1 - F.try_divide(n - F.col("_d"), n - F.col("_rc") / n)).alias("kappa")))
    raise ValueError(weights)


def qwk(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    return kappa_from_confusion(confusion(df, label, pred, by), "quadratic", by)


# ------------------------------------------------------------------ AUC

def auc(df: DataFrame, label: str, score: str, by_bucket: int | None = None) -> DataFrame:
    """Exact ROC AUC with ties counted one half.

    AUC = Σ_s pos(s)·(neg(<s) + neg(s)/2) / (P·N) over distinct scores s.
    Rows first collapse to one row per distinct score (partial aggregation
    absorbs any hot score).  The running count neg(<s) is a two-level prefix
    sum: distinct scores go into quantile buckets (as many as hold
    ``AUC_ROWS`` scores each, or ``by_bucket``), a per-bucket total table
    gives each bucket's offset, joined by bucket, and a window partitioned by
    bucket adds the running sum inside it.  The value is
    computed eagerly (one number), so the distinct-score table is only
    persisted while it is needed.
    """
    s = (df.where(_c(label).isNotNull() & _c(score).isNotNull())
           .groupBy(_c(score).cast("double").alias("_s"))
           .agg(F.sum((_c(label) == 1).cast("long")).alias("_pos"),
                F.sum((_c(label) != 1).cast("long")).alias("_neg")))
    s = s.persist(StorageLevel.MEMORY_AND_DISK)     # three passes below; lost blocks are recomputed
    by_bucket = by_bucket or max(2, -(-s.count() // AUC_ROWS))
    probs = [i / by_bucket for i in range(1, by_bucket)]
    cuts = sorted(set(s.approxQuantile("_s", probs, 1.0 / (4 * by_bucket))))
    splits = [float("-inf"), *cuts, float("inf")]
    s = Bucketizer(splits=splits, inputCol="_s", outputCol="_b").transform(s)
    tot = s.groupBy("_b").agg(F.sum("_neg").alias("_bn"), F.sum("_pos").alias("_bp")).collect()
    off, run = {}, 0
    for r in sorted(tot, key=lambda r: r["_b"]):
        off[r["_b"]] = run
        run += r["_bn"]
    n_neg = run
    n_pos = sum(r["_bp"] for r in tot)
    offs = df.sparkSession.createDataFrame([(float(b), int(o)) for b, o in off.items()] or [(0.0, 0)], "_ob double, _off long")
    w = Window.partitionBy("_b").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    s2 = s.withColumn("_below", F.coalesce(F.sum("_neg").over(w), F.lit(0))).join(F.broadcast(offs), F.col("_b") == F.col("_ob"))
    contrib = s2.withColumn("_c", F.col("_pos") * (F.col("_below") + F.col("_off") + F.col("_neg") / 2.0))
    denom = float(n_pos) * float(n_neg)
    total = contrib.agg(F.sum("_c")).first()[0]
    s.unpersist()
    value = (float(total) / denom) if (denom and total is not None) else float("nan")
    return df.sparkSession.createDataFrame([(value,)], "auc double")


def auc_by(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    """Exact AUC per group in one set of passes: (by..., auc).

    One row per (group, distinct score), then running counts of negatives in
    the order of the scores, range by range (``prefix.running_sums_by``): one
    group of any size and any number of small ones are the same plan, and
    nothing is broadcast.  A group without both classes has no AUC (null).
    """
    by = list(by)
    s = (df.where(_c(label).isNotNull() & _c(score).isNotNull())
           .groupBy(*by, _c(score).cast("double").alias("_s"))
           .agg(F.sum((_c(label) == 1).cast("long")).alias("_pos"),
                F.sum((_c(label) != 1).cast("long")).alias("_neg")))
    summed = running_sums_by(s, by, [F.col("_s")], ["_neg"])
    won = F.sum(F.col("_pos") * (F.col("_neg_before") + F.col("_neg") / 2.0))
    return summed.groupBy(*by).agg(F.try_divide(won, F.sum("_pos").cast("double") * F.sum("_neg").cast("double")).alias("auc"))


# ------------------------------------------------------------------ dispatch

def evaluate(df: DataFrame, metric: Metric | str, label: str = "label", pred: str = "prediction",
             by: Sequence[str] = ()) -> DataFrame:
    """One metric per group; the output column is named after the metric."""
    m = Metric(metric)
    if m in (Metric.MAE, Metric.MSE, Metric.RMSE):
        return regression_metrics(df, label, pred, by).select(*by, m.value)
    if m is Metric.ACCURACY:
        return accuracy(df, label, pred, by)
    if m is Metric.QWK:
        return qwk(df, label, pred, by)
    if m is Metric.KAPPA:
        return kappa_from_confusion(confusion(df, label, pred, by), "unweighted", by)
    if m is Metric.AUC:
        return auc_by(df, label, pred, by) if by else auc(df, label, pred)
    raise ValueError(m)


def evaluate_value(df: DataFrame, metric: Metric | str, label: str = "label",
                   pred: str = "prediction") -> float:
    return float(evaluate(df, metric, label, pred).first()[0])
