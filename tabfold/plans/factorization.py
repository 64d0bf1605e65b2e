"""Factorization machines for regression, fitted from sums that one pass over the rows makes.

A machine's prediction is linear in the products of up to two features, so the
squared loss of all rows, and its gradient, follow from the mean products of
those columns and the label.  The rows are read once for them; the steps of
Spark's own fit (the same start, updater, number of iterations and test of
convergence) then run on the driver, where Spark runs a job over all rows
each.  Its coefficients are the same but for rounding.

Cases: no rows leave the start as it is; a label or feature that is null, NaN
or infinite is refused, as Spark does.  Fits on samples of the rows
(``miniBatchFraction``) and those of many features are Spark's own: the sums
grow with the fourth power of the number of features.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.ml.regression import FMRegressionModel, FMRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabfold.llm.common import ship_package

MOST_COLUMNS = 512               # products of features, at most: 2 MB of sums
SLICE_ROWS = 10_000              # rows whose products are held at a time


def n_columns(p: int) -> int:
    return 1 + p + p * (p - 1) // 2


def by_sums(machine: FMRegressor, p: int) -> bool:
    """Whether ``fit`` takes this machine over ``p`` features."""
    return machine.getMiniBatchFraction() == 1.0 and n_columns(p) <= MOST_COLUMNS


def _sums(rows: DataFrame, p: int) -> tuple[np.ndarray, int]:
    """Sums of products of (1, features, pairs of features, label) with each other, and the number of rows."""
    first, second = np.triu_indices(p, 1)
    d = n_columns(p) + 1

    def told(batches):
        total, n = np.zeros((d, d)), 0
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            if not np.isfinite(y).all():
                raise ValueError("a label is null, NaN or infinite")
            if not np.isfinite(x).all():
                raise ValueError("a feature is NaN or infinite")
            n += len(y)
            for lo in range(0, len(y), SLICE_ROWS):
                a, b = x[lo:lo + SLICE_ROWS], y[lo:lo + SLICE_ROWS]
                z = np.column_stack([np.ones(len(b)), a, a[:, first] * a[:, second], b])
                total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([n], pa.int64())], names=["s", "n"])
    ship_package(rows.sparkSession)
    parts = rows.mapInArrow(told, "s binary, n long").rdd.map(lambda r: (np.frombuffer(bytes(r["s"])), r["n"]))
    if not parts.getNumPartitions():
        return np.zeros((d, d)), 0
    total, n = parts.treeReduce(lambda a, b: (a[0] + b[0], a[1] + b[1]))
    return total.reshape(d, d), n


def _steps(machine: FMRegressor, start: np.ndarray, p: int, means: np.ndarray) -> np.ndarray:
    """The coefficients (factors by feature, linear, intercept) after the iterations of Spark's gradient descent."""
    k, linear, rate, shrink = machine.getFactorSize(), machine.getFitLinear(), machine.getStepSize(), machine.getRegParam()
    first, second = np.triu_indices(p, 1)
    w, before, m, v = start.copy(), None, np.zeros(len(start)), np.zeros(len(start))
    for i in range(1, machine.getMaxIter() + 1):
        factors = w[:p * k].reshape(p, k)
        c = np.zeros(len(means) - 1)
        if machine.getFitIntercept():
            c[0] = w[-1]
        if linear:
            c[1:1 + p] = w[p * k:p * k + p]
        c[1 + p:] = (factors[first] * factors[second]).sum(axis=1)
        g = 2.0 * (means[:-1, :-1] @ c - means[:-1, -1])
        pairs = np.zeros((p, p))
        pairs[first, second] = pairs[second, first] = g[1 + p:]
        g = np.concatenate([(pairs @ factors).ravel(), g[1:1 + p] if linear else [], g[:1] if machine.getFitIntercept() else []])
        if machine.getSolver() == "gd":
            own = rate / np.sqrt(i)
            w = w * (1.0 - own * shrink) - own * g
        else:
            m, v = 0.9 * m + (1 - 0.9) * g, 0.999 * v + (1 - 0.999) * g * g
            w = w - (rate * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.999 ** i)) + 1e-8) + shrink * w)
        if before is not None and np.linalg.norm(before - w) < machine.getTol() * max(np.linalg.norm(w), 1.0):
            break
        before = w
    return w


def fit(machine: FMRegressor, rows: DataFrame, p: int) -> FMRegressionModel:
    """Spark's own model of ``machine`` over ``rows``, with the machine's features and label columns; ``p`` features."""
    jvm = rows.sparkSession.sparkContext._jvm
    total, n = _sums(rows.select(vector_to_array(machine.getFeaturesCol()).alias("x"), F.col(machine.getLabelCol()).cast("double").alias("y")), p)
    drawn, k = jvm.java.util.Random(machine.getSeed()), machine.getFactorSize()
    linear, intercept = machine.getFitLinear(), machine.getFitIntercept()
    w = np.array([drawn.nextGaussian() * machine.getInitStd() for _ in range(p * k)] + [0.0] * (p * linear + intercept))
    if n:
        w = _steps(machine, w, p, total / n)
    sc = rows.sparkSession.sparkContext
    made = jvm.org.apache.spark.ml.regression.FMRegressionModel(
        f"FMRegressor_{uuid.uuid4().hex[:12]}", float(w[-1]) if intercept else 0.0,
        _py2java(sc, Vectors.dense(w[p * k:p * k + p] if linear else np.zeros(p))), _py2java(sc, DenseMatrix(p, k, w[:p * k], True)))
    return machine._copyValues(FMRegressionModel(made))
