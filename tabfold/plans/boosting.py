"""Boosted trees grown in blocks on a margin column, so that no tree is fitted twice.

Every row holds its margin: the weighted sum of the trees so far.  A round
fits one tree to the negative gradient of the loss at the margin and adds it
with its weight (1 for the first tree, ``stepSize`` after it), as Spark's own
boosting does; its trees are the same where no rows are sampled.  After a
block of rounds the margins are checkpointed into the shared folder, all
prefixes of the block are scored on the validation rows in one pass, and
patience decides whether another block follows.  Stopping early keeps a
prefix of the trees.

Rows are binned once, by split values found as Spark's trees find them, dealt
out and sorted so that rows with the same bins (a cell) lie together, and kept
as blocks: the cells of some ten thousand rows, their margins, and the labels
row by row.  A level of a tree is one job: each task adds up counts, gradients
and their squares over the rows of each cell, then cells by node, feature and
bin; the sums of all tasks are added, and the driver picks the splits.  A round
thus reads some 10 bytes a row and level, follows its tree once a cell,
evaluates its own tree only, and plans no query.  A cell with many rows is
dealt to several tasks; where each row is a cell of its own, the sums are the
same and only take longer.

Two or more classes share their margins: a round fits a tree a class to
1{y = c} - softmax(margins)[c], so the probabilities of a row add up to one
all along.  Their trees grow in the same jobs.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import RDD, SparkContext, StorageLevel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabfold.llm.common import ship_package
from tabfold.session import checkpoint_dir

#: parameters of a boosted learner that its single trees take
TREE_PARAMS = ("maxDepth", "maxBins", "minInstancesPerNode", "minInfoGain", "subsamplingRate", "featureSubsetStrategy",
               "maxMemoryInMB", "cacheNodeIds", "checkpointInterval", "minWeightFractionPerNode")
#: all that ``grow`` reads
PARAMS = (*TREE_PARAMS, "stepSize", "maxIter", "lossType", "seed")
#: and ``forest``
FOREST_PARAMS = (*TREE_PARAMS, "numTrees", "bootstrap", "seed")

BLOCK_ROWS = 100_000             # rows of a block, about
TASK_ROWS = 2_000_000            # rows of a task, about: a level takes some 10 ns a row, a task some 50 ms besides
TASK_BYTES = 32 << 20            # their bins and labels, at most: a task sorts them
SPLIT_ROWS = 10_000              # rows that split values are found from, as in Spark's trees
SUM_BYTES = 16 << 20             # sums of a level that the driver adds itself, at most; more are added by Spark first
LEVEL_BYTES = 64 << 20           # sums that a task holds, at most
KEPT_BYTES = 512 << 20           # sums by tree and cell that a forest keeps, at most; else rows are drawn again at each level
KEPT_CELLS = 20_000              # cells whose sums are kept together, about


# -- losses ----------------------------------------------------------------------------------------------------------

def _shares(margins: np.ndarray) -> np.ndarray:
    parts = np.exp(margins - margins.max(axis=1, keepdims=True))
    return parts / parts.sum(axis=1, keepdims=True)


def _targets(loss: str, y: np.ndarray, margins: np.ndarray, first: bool) -> np.ndarray:
    """(rows, trees): what a round's trees are fitted to, the negative gradient at the margin."""
    if loss == "classes":
        return (y[:, None] == np.arange(margins.shape[1])) - _shares(margins)
    y = (2.0 * y - 1.0 if loss == "logistic" else y)[:, None]
    if first:
        return y
    if loss == "logistic":
        with np.errstate(over="ignore"):
            return 4.0 * y / (1.0 + np.exp(2.0 * y * margins))
    away = y - margins
    return np.sign(away) if loss == "absolute" else 2.0 * away


def _losses(loss: str, y: np.ndarray, margins: np.ndarray) -> np.ndarray:
    if loss == "classes":
        own = np.where((y >= 0) & (y < margins.shape[1]), y, -1)
        at = np.nan_to_num(own, nan=-1.0).astype(int)
        p = np.where(at >= 0, _shares(margins)[np.arange(len(y)), at], 0.0)
        return -np.log(np.maximum(p, 1e-15))
    m = margins[:, 0]
    if loss == "logistic":
        z = -2.0 * (2.0 * y - 1.0) * m
        return 2.0 * (np.maximum(z, 0.0) + np.log1p(np.exp(-np.abs(z))))
    return np.abs(y - m) if loss == "absolute" else (y - m) ** 2


# -- one tree --------------------------------------------------------------------------------------------------------

EPSILON = float(np.finfo(float).eps)


@dataclass
class Tree:
    """Nodes as lists; a leaf is its own child.  ``stats``: rows, sum and sum of squares of the target."""
    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)            # bins up to it go left
    threshold: list[float] = field(default_factory=list)
    child: list[list[int]] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    stats: list[np.ndarray] = field(default_factory=list)
    depth: int = 0

    def leaf(self, stats: np.ndarray) -> int:
        at = len(self.stats)
        self.feature.append(0)
        self.cut.append(1 << 30)
        self.threshold.append(0.0)
        self.child.append([at, at])
        self.gain.append(-1.0)
        self.stats.append(stats)
        return at

    def values(self) -> np.ndarray:
        return np.array([s[1] / s[0] if s[0] else 0.0 for s in self.stats])

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row has come to."""
        at = np.zeros(len(bins), int)
        feature, cut, child = np.array(self.feature), np.array(self.cut), np.array(self.child).reshape(-1)
        flat, start = bins.reshape(-1), np.arange(len(bins)) * bins.shape[1]
        for _ in range(self.depth):
            at = child[2 * at + (flat[start + feature[at]] > cut[at])]
        return at


def _impurity(s: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(s[..., 0] > 0, (s[..., 2] - s[..., 1] * s[..., 1] / s[..., 0]) / s[..., 0], 0.0)


def _n_tried(strategy: str, p: int) -> int:
    """Features that a node tries, by Spark's ``featureSubsetStrategy`` of one tree."""
    named = {"auto": p, "all": p, "sqrt": math.ceil(math.sqrt(p)), "log2": max(1, math.ceil(math.log2(p))), "onethird": math.ceil(p / 3)}
    s = str(strategy).lower()
    if s in named:
        return named[s]
    return min(p, int(s)) if s.isdigit() and int(s) > 0 else max(1, math.ceil(float(s) * p))


def _split(tree: Tree, at: int, sums: np.ndarray, cuts: Sequence[np.ndarray], params: Mapping, n_rows: int, rng) -> list[int]:
    """Splits node ``at`` by its sums (feature, bin, 3), if that gains; returns the children that may be split."""
    total = sums[0].sum(axis=0)
    left = sums.cumsum(axis=1)[:, :-1]
    right = total - left
    least = max(int(params.get("minInstancesPerNode", 1)), float(params.get("minWeightFractionPerNode", 0.0)) * n_rows)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = _impurity(total) - (left[..., 0] * _impurity(left) + right[..., 0] * _impurity(right)) / total[0]
    fits = (left[..., 0] >= least) & (right[..., 0] >= least) & (gain >= float(params.get("minInfoGain", 0.0)))
    fits &= np.arange(left.shape[1]) < np.array([len(c) for c in cuts])[:, None]
    tried = _n_tried(params.get("featureSubsetStrategy", "all"), len(cuts))
    if tried < len(cuts):
        fits[rng.permutation(len(cuts))[tried:]] = False
    gain = np.where(fits, gain, -np.inf)
    j, k = np.unravel_index(int(gain.argmax()), gain.shape)        # the first of equal ones
    if not gain[j, k] > 0:
        return []
    sides = [tree.leaf(left[j, k]), tree.leaf(right[j, k])]
    tree.feature[at], tree.cut[at], tree.threshold[at], tree.gain[at] = int(j), int(k), float(cuts[j][k]), float(gain[j, k])
    tree.child[at] = sides
    return [s for s in sides if abs(float(_impurity(tree.stats[s]))) >= EPSILON]


@lru_cache(maxsize=64)
def _poisson_table(rate: float) -> tuple[np.ndarray, np.ndarray]:
    """The Poisson number for each 16 leading bits of a uniform number (255: more bits decide), and the distribution function."""
    upto = np.cumsum([math.exp(k * math.log(rate) - rate - math.lgamma(k + 1)) for k in range(64)])
    low, high = (np.searchsorted(upto, (np.arange(1 << 16) + i) / (1 << 16), side) for i, side in ((0, "right"), (1, "left")))
    return np.where(low == high, low, 255).astype(np.uint8), upto


def _poisson(rng, rate: float, n: int) -> np.ndarray:
    """``n`` Poisson numbers: numpy's own take ten times as long."""
    table, upto = _poisson_table(rate)
    bits = rng.integers(0, 1 << 64, -(-n // 4), np.uint64).view(np.uint16)[:n]
    times = table[bits]
    if len(again := np.flatnonzero(times == 255)):
        times[again] = np.searchsorted(upto, (bits[again] + rng.random(len(again))) / (1 << 16), "right")
    return times


def _by_row(starts: np.ndarray, n: int, margins: np.ndarray) -> np.ndarray:
    """Margins of cells, for each of their rows."""
    return margins if len(margins) == n else np.repeat(margins, np.diff(starts, append=n), axis=0)


def _cell_sums(blocks, loss: str, first: bool, wanted: Sequence[bool], seeds: Sequence[int], rate: float, bootstrap: bool):
    """(cells, for each wanted tree the count, sum and sum of squares of its targets by cell) of some blocks."""
    for ident, cells, starts, y, margins, _ in blocks:
        targets, found = _targets(loss, y, margins if first else _by_row(starts, len(y), margins), first), []
        squares = targets * targets
        for c, seed in enumerate(seeds):
            if not wanted[c]:
                found.append(None)
                continue
            g, gg = (t[:, min(c, t.shape[1] - 1)] for t in (targets, squares))
            rng, sums = np.random.default_rng([seed & 0xFFFFFFFF, *ident]), np.empty((len(cells), 3))
            if bootstrap or rate < 1.0:
                times = _poisson(rng, rate, len(y)).astype(float) if bootstrap else (rng.random(len(y)) < rate).astype(float)
                sums[:, 0], g, gg = np.add.reduceat(times, starts), times * g, times * gg
            else:
                sums[:, 0] = np.diff(starts, append=len(y))
            sums[:, 1], sums[:, 2] = np.add.reduceat(g, starts), np.add.reduceat(gg, starts)
            found.append(sums)
        yield cells, found


def _level_sums(parts: Iterable, trees: Sequence[Tree], open_nodes: Sequence[Sequence[int]], n_bins: int):
    """((tree, node), sums by feature and bin) of some cells and their sums by tree."""
    total: dict[tuple[int, int], np.ndarray] = {}
    for cells, found in parts:
        p = cells.shape[1]
        for c, (tree, open_) in enumerate(zip(trees, open_nodes)):
            if not open_:
                continue
            slot = np.full(max(len(tree.stats), 1), -1)
            slot[list(open_)] = np.arange(len(open_))
            own = slot[tree.nodes(cells)]
            own[found[c][:, 0] == 0] = -1                # no row of the cell was drawn
            here = np.flatnonzero(own >= 0)
            base, x, each = own[here] * n_bins, cells[here], found[c][here].T
            sums = np.empty((len(open_), p, n_bins, 3))
            for j in range(p):
                at = base + x[:, j]
                for i, w in enumerate(each):
                    sums[:, j, :, i] = np.bincount(at, w, len(open_) * n_bins).reshape(len(open_), n_bins)
            for s, node in enumerate(open_):
                total[c, node] = total[c, node] + sums[s] if (c, node) in total else sums[s]
    return total.items()


def _grown(rows: RDD, loss: str, first: bool, n_trees: int, params: Mapping, seeds: Sequence[int], cuts: Sequence[np.ndarray], n_rows: int,
           bootstrap: bool = False, kept: bool = False) -> list[Tree]:
    """The trees of a round, level by level; a level of many nodes takes several jobs.  ``kept``: rows are sums by cell already."""
    trees = [Tree() for _ in range(n_trees)]
    rate, n_bins, tasks = float(params.get("subsamplingRate", 1.0)), max(map(len, cuts)) + 1, rows.getNumPartitions()
    rngs, deepest = [np.random.default_rng(s & 0xFFFFFFFF) for s in seeds], int(params.get("maxDepth", 5))
    node_bytes = len(cuts) * n_bins * 24
    level = [(c, 0) for c in range(n_trees)]
    for depth in range(max(1, deepest)):
        following = []
        for lo in range(0, len(level), most := max(1, LEVEL_BYTES // node_bytes)):
            part = level[lo:lo + most]
            open_nodes: list[list[int]] = [[] for _ in trees]
            for c, node in part:
                open_nodes[c].append(node)
            wanted = [bool(nodes) for nodes in open_nodes]
            told = rows.mapPartitions(lambda found, trees=trees, open_nodes=open_nodes, wanted=wanted: _level_sums(
                found if kept else _cell_sums(found, loss, first, wanted, seeds, rate, bootstrap), trees, open_nodes, n_bins))
            sums = _summed(told, min(tasks, len(part)) if tasks * len(part) * node_bytes > SUM_BYTES else 0)
            for c, node in part:
                if depth == 0:
                    trees[c].leaf(sums[c, node][0].sum(axis=0) if (c, node) in sums else np.zeros(3))
                if deepest and (c, node) in sums:
                    following += [(c, side) for side in _split(trees[c], node, sums[c, node], cuts, params, n_rows, rngs[c])]
        level = following
        for tree in trees:
            tree.depth = depth + 1
        if not level:
            break
    return trees


def _summed(told: RDD, tasks: int) -> dict[tuple[int, int], np.ndarray]:
    """The sums of some (tree, node) over all rows, in one job; ``tasks``: of Spark, that add them before the driver does."""
    if tasks:
        told = told.reduceByKey(add, tasks)
    sums: dict[tuple[int, int], np.ndarray] = {}
    for k, s in told.collect():
        sums[k] = sums[k] + s if k in sums else s
    return sums


# -- rows ------------------------------------------------------------------------------------------------------------

def _cuts(values: np.ndarray, n_splits: int, rows: float) -> np.ndarray:
    """Split values of a feature from those of a sample that stands for ``rows`` rows, by the rule of Spark's trees."""
    v, n = np.unique(values[values != 0.0], return_counts=True)
    n = n.astype(float)
    rest = rows - n.sum()
    v, n = v[~np.isnan(v)], n[~np.isnan(v)]
    if rest > EPSILON * len(values) * 100:
        at = int(np.searchsorted(v, 0.0))
        v, n = np.insert(v, at, 0.0), np.insert(n, at, rest)
    if len(v) < 2:
        return np.empty(0)
    middles = (v[:-1] + v[1:]) / 2.0
    if len(middles) <= n_splits:
        return middles
    stride, found = rows / (n_splits + 1), []
    goal, seen = stride, np.cumsum(n)
    for i in range(1, len(v)):
        if abs(seen[i - 1] - goal) < abs(seen[i] - goal):
            found.append(middles[i - 1])
            goal += stride
    return np.array(found)


def _columns(rows: DataFrame, label: str) -> DataFrame:
    return rows.select(vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"))


@dataclass
class Binning:
    cuts: list[np.ndarray]          # split values a feature
    rows: int
    tasks: int
    busy: dict[bytes, int]          # cells with more rows than a task should have: among how many tasks they are dealt

    @property
    def kind(self):
        return np.uint8 if max(map(len, self.cuts)) < 256 else np.int32

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(self.cuts)], axis=1).astype(self.kind)


def _binning(rows: DataFrame, params: Mapping, seed: int) -> Binning:
    n = rows.count()
    if n == 0:
        raise ValueError("no training rows")
    bins = min(int(params.get("maxBins", 32)), n)
    share = min(1.0, max(bins * bins, SPLIT_ROWS) / n)
    some = rows if share == 1.0 else rows.sample(share, seed)
    x = np.array([r["x"] for r in some.select("x").collect()], dtype=float)
    if not len(x):
        x = np.array([rows.select("x").first()["x"]], dtype=float)
    found = Binning([_cuts(x[:, j], bins - 1, share * n) for j in range(x.shape[1])], n, 1, {})
    found.tasks = max(-(-n // TASK_ROWS), -(-n * (x.shape[1] * np.dtype(found.kind).itemsize + 8) // TASK_BYTES))
    if found.tasks > 1:
        for cell, times in Counter(map(bytes, found.bins(x))).items():
            if (parts := math.ceil(2 * found.tasks * times / len(x))) > 1:
                found.busy[cell] = parts
    return found


def _hashed(cells: np.ndarray) -> np.ndarray:
    """A number a row that rows with the same bins share."""
    h = np.zeros(len(cells), np.uint64)
    for j in range(cells.shape[1]):
        h = (h ^ cells[:, j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return h


def _blocks(rows: DataFrame, by: Binning, n_margins: int, strict: bool, binary: bool = False) -> RDD:
    """(id, cells, first row of each, labels, margins of the cells, losses) of some ten thousand rows each."""
    kind, p, tasks = by.kind, len(by.cuts), by.tasks
    large = _hashed(np.array([np.frombuffer(c, kind) for c in by.busy]).reshape(-1, p))
    order, among = np.argsort(large), np.array(list(by.busy.values()), np.uint64)
    large, among = large[order], among[order]

    def dealt(x, y):
        cells = np.ascontiguousarray(by.bins(x))
        h = _hashed(cells)
        if len(large):
            at = np.minimum(np.searchsorted(large, h), len(large) - 1)
            here = np.flatnonzero(large[at] == h)
            h[here] += (here.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % among[at[here]]
        to = h % np.uint64(tasks)
        order = np.argsort(to, kind="stable")
        ends = np.cumsum(np.bincount(to.astype(int), minlength=tasks))
        for task, (lo, hi) in enumerate(zip(np.append(0, ends[:-1]), ends)):
            if lo < hi:
                here = order[lo:hi]
                yield pa.RecordBatch.from_arrays([pa.array([task], pa.int32()), pa.array([cells[here].tobytes()], pa.binary()), pa.array([y[here].tobytes()], pa.binary())],
                                                 names=["task", "x", "y"])

    def binned(batches):
        held, size = [], 0
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            if strict and np.isnan(y).any():
                raise ValueError("a training row has no label")
            if binary and not np.isin(y, (0.0, 1.0)).all():
                raise ValueError("a label is neither 0 nor 1")
            held.append((x, y))
            size += len(y)
            if size >= BLOCK_ROWS:
                yield from dealt(*map(np.concatenate, zip(*held)))
                held, size = [], 0
        if held:
            yield from dealt(*map(np.concatenate, zip(*held)))

    def laid(part, found):
        held = [(np.frombuffer(x, kind).reshape(-1, p), np.frombuffer(y)) for _, (x, y) in found]
        if not held:
            return
        x, y = map(np.concatenate, zip(*held))
        del held
        order = np.lexsort((y, _hashed(x)))            # by label too: rows are drawn by their places
        x, y = x[order], y[order]
        for i, lo in enumerate(range(0, len(y), BLOCK_ROWS)):
            own, labels = x[lo:lo + BLOCK_ROWS], y[lo:lo + BLOCK_ROWS].copy()
            starts = np.flatnonzero(np.append(True, (own[1:] != own[:-1]).any(axis=1)))
            yield (part, i), own[starts], starts, labels, np.zeros((len(starts), n_margins)), None
    made = rows.mapInArrow(binned, "task int, x binary, y binary").rdd
    return made.map(lambda r: (r["task"], (bytes(r["x"]), bytes(r["y"])))).partitionBy(tasks, int).mapPartitionsWithIndex(laid)


def _with_trees(rows: RDD, rounds: Sequence[Sequence[Tree]], weights: Sequence[float], loss: str, told: bool) -> RDD:
    """The blocks with the trees of some rounds added to the margins; ``told``: and the losses' sum and number after each round."""
    def added(block):
        ident, cells, starts, y, margins, _ = block
        margins, losses = margins.copy(), []
        for trees, w in zip(rounds, weights):
            for c, tree in enumerate(trees):
                margins[:, c] += w * tree.values()[tree.nodes(cells)]
            if told:
                each = _losses(loss, y, _by_row(starts, len(y), margins))
                each = each if loss == "classes" else each[~np.isnan(y)]
                losses.append((float(each.sum()), len(each)))
        return ident, cells, starts, y, margins, np.array(losses)
    return rows.map(added)


def _models(trees: Sequence[Tree], n_features: int):
    """Spark's own models of trees, as a Java array, made by the JVM classes' constructors.

    The sums of all nodes go to the JVM at once: a call a number takes longer than growing the trees.
    """
    sc = SparkContext._active_spark_context
    ml = sc._jvm.org.apache.spark.ml
    leaf, inner, cut, one = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit, ml.regression.DecisionTreeRegressionModel
    calculator = sc._jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    sums = _py2java(sc, DenseMatrix(3, max(1, sum(len(t.stats) for t in trees)), np.concatenate([np.concatenate(t.stats) for t in trees]))).values()
    copy = sc._jvm.java.util.Arrays.copyOfRange
    made, start = sc._gateway.new_array(one, len(trees)), 0
    for i, tree in enumerate(trees):
        values, impurities = tree.values(), _impurity(np.stack(tree.stats))

        def node(at: int):
            lo = 3 * (start + at)
            stats = calculator(copy(sums, lo, lo + 3), int(tree.stats[at][0]))
            sides = tree.child[at]
            if sides[0] == at:
                return leaf(float(values[at]), float(impurities[at]), stats)
            return inner(float(values[at]), float(impurities[at]), tree.gain[at], node(sides[0]), node(sides[1]), cut(tree.feature[at], tree.threshold[at]), stats)
        made[i] = one(f"dtr_{uuid.uuid4().hex[:12]}", node(0), n_features)
        start += len(tree.stats)
    return made


def gbt_model(trees: Sequence[Tree], weights: Sequence[float], n_features: int, classifier: bool):
    """Spark's own model of these trees: it scores, saves and tells importances like any other.

    Made by the JVM class's constructor, as Spark has no other way to keep a
    prefix of the trees that were grown.
    """
    sc = SparkContext._active_spark_context
    ml = sc._jvm.org.apache.spark.ml
    j_trees, j_weights = _models(trees, n_features), sc._gateway.new_array(sc._jvm.double, len(trees))
    for i, (_, w) in enumerate(zip(trees, weights, strict=True)):
        j_weights[i] = float(w)
    if classifier:
        return GBTClassificationModel(ml.classification.GBTClassificationModel(f"GBTClassifier_{uuid.uuid4().hex[:12]}", j_trees, j_weights, n_features, 2))
    return GBTRegressionModel(ml.regression.GBTRegressionModel(f"GBTRegressor_{uuid.uuid4().hex[:12]}", j_trees, j_weights, n_features))


@dataclass
class Boosted:
    trees: list            # a tree a round, or a list of them, one a class
    weights: list[float]
    curve: list[float]     # validation loss after each round that was tried
    best: int              # rounds kept


def patience_best(curve: Sequence[float], patience: int) -> tuple[int, bool]:
    """(trees kept, stopped): best prefix = first minimum; stopped if `patience` rounds followed it."""
    best_i, best_v = 0, float("inf")
    for i, v in enumerate(curve):
        if v < best_v:
            best_i, best_v = i, v
        elif i - best_i >= patience:
            return best_i + 1, True
    return best_i + 1, False


def _boost(train: DataFrame, val: DataFrame | None, loss: str, params: Mapping, seed: int, patience: int | None, block: int,
           max_rounds: int, label: str, n_margins: int, binary: bool = False) -> Boosted:
    """Rounds in blocks, ``n_margins`` trees each, until patience or ``max_rounds`` ends them; without ``patience`` all are kept."""
    spark = train.sparkSession
    checkpoint_dir(spark)
    ship_package(spark)
    rows = _columns(train, label)
    by = _binning(rows, params, seed)
    tr, done = _blocks(rows, by, n_margins, True, binary).persist(StorageLevel.MEMORY_AND_DISK), None
    tr.checkpoint()                 # rows stay in their blocks when they are needed again
    va = _blocks(_columns(val, label), by, n_margins, False).persist(StorageLevel.MEMORY_AND_DISK) if val is not None else None
    made, step = Boosted([], [], [], 0), float(params.get("stepSize", 0.1))
    try:
        while True:
            here, weights = [], []
            for _ in range(min(block, max_rounds - len(made.trees))):
                t = len(made.trees)
                first = t == 0 and loss != "classes"
                here.append(_grown(tr, loss, first, n_margins, params, [seed + t * n_margins + c for c in range(n_margins)], by.cuts, by.rows))
                weights.append(1.0 if first else step)
                made.trees.append(here[-1])
                made.weights.append(weights[-1])
                if done is not None:
                    done.unpersist()                    # the next margins are kept by now
                done, tr = tr, _with_trees(tr, here[-1:], weights[-1:], loss, val is None and loss == "classes").persist(StorageLevel.MEMORY_AND_DISK)
                if val is None and loss == "classes":
                    made.curve += _means(tr, 1)
            tr.checkpoint()
            if va is not None:
                before, va = va, _with_trees(va, here, weights, loss, True).persist(StorageLevel.MEMORY_AND_DISK)
                va.checkpoint()
                made.curve += _means(va, len(here))
                before.unpersist()
            stopped = False
            if patience and val is not None:
                made.best, stopped = patience_best(made.curve, patience)
            else:
                made.best = len(made.trees)
            if stopped or len(made.trees) >= max_rounds:
                return made
    finally:
        for kept in (tr, done, va):
            if kept is not None:
                kept.unpersist()


def _means(rows: RDD, n: int) -> list[float]:
    """The mean loss after each of the last ``n`` rounds."""
    told = rows.map(lambda block: block[5]).fold(np.zeros((n, 2)), add)
    return [float(s / m) if m else math.nan for s, m in told]


def grow(train: DataFrame, val: DataFrame | None, loss: str, params: Mapping, seed: int, patience: int | None,
         block: int, max_rounds: int, label: str = "label", binary: bool = False) -> Boosted:
    """Rounds in blocks until patience ends them; ``train`` and ``val`` have features and label.

    Without ``val`` all ``max_rounds`` are kept and there is no curve.
    ``binary``: labels other than 0 and 1 are refused.
    """
    made = _boost(train, val, loss, params, seed, patience, block, max_rounds, label, 1, binary)
    made.trees = [trees[0] for trees in made.trees]
    return made


# -- forests ---------------------------------------------------------------------------------------------------------

def forest(train: DataFrame, params: Mapping, seed: int, label: str = "label", binned: dict | None = None) -> list[Tree]:
    """The trees of a regression forest, grown together: each row counts for a tree as often as a Poisson number
    says (``bootstrap``), or with the given probability.

    ``binned``: where the blocks of these training rows stay for the next forest over them; whoever owns it unpersists them.
    """
    checkpoint_dir(train.sparkSession)
    ship_package(train.sparkSession)
    n_trees, own = int(params.get("numTrees", 20)), dict(params)
    if str(own.get("featureSubsetStrategy", "auto")).lower() == "auto":
        own["featureSubsetStrategy"] = "onethird" if n_trees > 1 else "all"
    key, found = (label, int(own.get("maxBins", 32)), seed), {} if binned is None else binned
    if key not in found:
        rows = _columns(train, label)
        by = _binning(rows, own, seed)
        kept = _blocks(rows, by, 1, True).persist(StorageLevel.MEMORY_AND_DISK)
        kept.checkpoint()
        found[key] = by, kept, kept.map(lambda block: len(block[1])).sum()
    by, kept, n_cells = found[key]
    seeds, rate, bootstrap = [seed + c for c in range(n_trees)], float(own.get("subsamplingRate", 1.0)), bool(own.get("bootstrap", True))
    few = n_cells * n_trees * 24 <= KEPT_BYTES
    sums = kept.mapPartitions(lambda part: _gathered(_cell_sums(part, "squared", True, [True] * n_trees, seeds, rate, bootstrap))).persist(StorageLevel.MEMORY_AND_DISK) if few else kept
    try:
        return _grown(sums, "squared", True, n_trees, own, seeds, by.cuts, by.rows, bootstrap, few)
    finally:
        if few:
            sums.unpersist()
        if binned is None:
            kept.unpersist()


def _gathered(parts: Iterable) -> Iterable:
    """Cells and their sums by tree, of several blocks together."""
    held, size = [], 0

    def joined():
        return np.concatenate([cells for cells, _ in held]), [np.concatenate(sums) for sums in zip(*(found for _, found in held))]
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= KEPT_CELLS:
            yield joined()
            held, size = [], 0
    if held:
        yield joined()


def forest_model(trees: Sequence[Tree], n_features: int) -> RandomForestRegressionModel:
    """Spark's own model of these trees (as ``gbt_model``)."""
    sc = SparkContext._active_spark_context
    kind = sc._jvm.org.apache.spark.ml.regression
    made = kind.RandomForestRegressionModel(f"rfr_{uuid.uuid4().hex[:12]}", _models(trees, n_features), n_features)
    made.set(made.getParam("numTrees"), len(trees))               # the sum of the trees is divided by it
    return RandomForestRegressionModel(made)


# -- several classes -------------------------------------------------------------------------------------------------

def grow_classes(train: DataFrame, n_classes: int, params: Mapping, seed: int, rounds: int, val: DataFrame | None = None,
                 patience: int | None = None, block: int = 10, label: str = "label") -> Boosted:
    """Softmax boosting for classes 0 .. n_classes - 1: a tree a class and round, on shared margins.

    Without ``val`` all ``rounds`` are kept and the curve is that of the
    training rows.
    """
    return _boost(train, val, "classes", params, seed, patience, block, rounds, label, n_classes)


def softmax(margins: Sequence[Column]) -> list[Column]:
    top = F.greatest(*margins) if len(margins) > 1 else margins[0]
    parts = [F.exp(m - top) for m in margins]
    total = sum(parts[1:], parts[0])
    return [p / total for p in parts]


def class_stages(made: Boosted, n_classes: int, n_features: int) -> list:
    """Pipeline stages that score: a model a class gives its margin, then the softmax: ``probability`` (an array) and ``prediction``."""
    stages = []
    for c in range(n_classes):
        trees = [grown[c] for grown in made.trees[:made.best]]
        stages.append(gbt_model(trees, made.weights[:made.best], n_features, False).setFeaturesCol("features").setPredictionCol(f"_margin{c}"))
    names = [f"_margin{c}" for c in range(n_classes)]
    top = f"greatest({', '.join(names)})" if n_classes > 1 else names[0]
    parts = ", ".join(f"exp({m} - {top})" for m in names)
    stages.append(SQLTransformer(statement=f"SELECT *, array({parts}) AS _parts FROM __THIS__"))
    stages.append(SQLTransformer(statement="SELECT *, transform(_parts, x -> x / aggregate(_parts, 0D, (a, y) -> a + y)) AS probability FROM __THIS__"))
    # the most likely class, the smallest of several
    stages.append(SQLTransformer(statement="SELECT *, CAST(array_position(probability, array_max(probability)) - 1 AS DOUBLE) AS prediction FROM __THIS__"))
    return stages
