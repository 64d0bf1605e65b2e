"""Ensembles over out-of-fold predictions: widening, leaderboard, weighted
average (simplex least squares / lattice), ridge stacking.

All fits reduce the OOF frame to Gram sums in one aggregation; the k x k
algebra runs on the driver.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabfold.functions.columns import SEVERITY_CUTS, scaled_class
from tabfold.operators import metrics as M
from tabfold.plans import learners as L
from tabfold.plans import linear
from tabfold.sources import schema as S

MIN_WEIGHT = 1e-14


def widen_oof(members: Mapping[str, DataFrame], key: str = "id", pred: str = "prediction",
              label: str | None = None, label_df: DataFrame | None = None) -> DataFrame:
    """(key, <member>...) from per-member (key, prediction) frames: one union, one shuffle.

    The first member fixes the row set (left semantics); the label, if given,
    is attached by key (never by position) within the same grouping.
    """
    names = list(members)
    none = F.lit(None)
    parts = [df.select(key, F.lit(n).alias("_member"), F.col(pred).cast("double").alias("_p"), F.lit(n == names[0]).alias("_first"))
             for n, df in members.items()]
    with_label = label is not None and label_df is not None
    if with_label:
        kind = label_df.schema[label].dataType
        parts = [p.withColumn("_y", none.cast(kind)) for p in parts]
        parts.append(label_df.select(key, F.lit("").alias("_member"), none.cast("double").alias("_p"), F.lit(False).alias("_first"), F.col(label).alias("_y")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    own = [F.max(F.when((F.col("_member") == n) & (F.col("_first") | (n != names[0])), F.col("_p"))).alias(n) for n in names]
    wide = u.groupBy(key).agg(F.bool_or("_first").alias("_keep"), *own, *([F.max("_y").alias(label)] if with_label else []))
    return wide.where("_keep").drop("_keep")


def leaderboard(scores: DataFrame, metric: str) -> DataFrame:
    """Order a (member, <metric>, rounds) frame by the metric's own direction."""
    m = M.Metric(metric)
    order = F.col(m.value).desc() if m.maximise else F.col(m.value).asc()
    return scores.orderBy(order, "member")


def error_gram(df: DataFrame, cols: Sequence[str], label: str) -> dict:
    """n and E_ij = Σ (p_i - y)(p_j - y) over complete rows, in one aggregation.

    With weights that sum to one the blend error is Σ v_i (p_i - y), so the
    blend's squared error is v'Ev exactly: no large sums are subtracted.
    """
    ok = F.lit(True)
    for c in [*cols, label]:
        ok = ok & F.col(c).isNotNull()
    e = [F.col(c).cast("double") - F.col(label).cast("double") for c in cols]
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.sum(e[i] * e[j]).alias(f"e{i}_{j}") for i in range(len(cols)) for j in range(i, len(cols))]
    r = df.where(ok).agg(*aggs).first()
    k = len(cols)
    E = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            E[i, j] = E[j, i] = r[f"e{i}_{j}"] or 0.0
    return {"n": r["n"], "E": E}


def simplex_least_squares(G: np.ndarray, b: np.ndarray) -> np.ndarray:
    """argmin_v v'Gv - 2b'v on the probability simplex, exact by an active set of members."""
    k = len(b)
    start = int(np.argmin(np.diag(G) - 2 * b))
    v, own = np.zeros(k), [start]
    v[start] = 1.0
    tol = 1e-10 * max(1.0, float(np.abs(G).max()))
    for _ in range(50 * k):
        while True:
            n = len(own)
            A = np.zeros((n + 1, n + 1))
            A[:n, :n] = 2 * G[np.ix_(own, own)]
            A[:n, n] = A[n, :n] = 1
            z = np.zeros(k)
            z[own] = np.linalg.lstsq(A, np.concatenate([2 * b[own], [1.0]]), rcond=None)[0][:n]
            if (z[own] >= -1e-12).all():
                v = np.clip(z, 0, None)
                break
            # go towards z until the first member's weight is gone, and leave that member out
            share = [v[i] / (v[i] - z[i]) if z[i] < 0 else np.inf for i in own]
            v = v + min(share) * (z - v)
            own.pop(int(np.argmin(share)))
        grad = 2 * (G @ v - b)
        out = [i for i in range(k) if i not in own]
        if not out or min(grad[i] for i in out) >= max(grad[i] for i in own) - tol:
            break
        own.append(min(out, key=lambda i: grad[i]))
    return v / v.sum()


def simplex_lattice(members: int, steps: int) -> list[tuple[float, ...]]:
    """All weights that are multiples of 1/steps and add up to one, in lexicographic order."""
    bars = itertools.combinations(range(steps + members - 1), members - 1)
    cuts = ([-1, *b, steps + members - 1] for b in bars)
    return [tuple((c[i + 1] - c[i] - 1) / steps for i in range(members)) for c in cuts]


def blend_lattice(oof_wide: DataFrame, members: Sequence[str], label: str, metric: str, steps: int = 10) -> DataFrame:
    """(point, weights, <metric>) of every lattice point, for any metric and number of members.

    Rows are blended at all points at once and scored in one grouped
    aggregation; the lattice is part of the plan, its size set by ``steps``.
    """
    m = M.Metric(metric)
    lattice = simplex_lattice(len(members), steps)
    points = F.array(*[F.struct(F.lit(i).alias("point"), F.array(*[F.lit(w) for w in ws]).alias("weights")) for i, ws in enumerate(lattice)])
    blended = (oof_wide.select(label, *members, F.explode(points).alias("_t"))
               .withColumn("_blend", sum((F.col(c) * F.get("_t.weights", F.lit(i)) for i, c in enumerate(members)), F.lit(0.0)))
               .select(label, "_blend", "_t.point"))
    named = oof_wide.sparkSession.createDataFrame([(i, list(ws)) for i, ws in enumerate(lattice)], "point int, weights array<double>")
    return named.join(M.evaluate(blended, m, label, "_blend", by=["point"]), "point")


LATTICE_POINTS = 300          # blends that a full lattice may have; beyond, edges of the simplex are searched
SHARES = (1.0, 0.75, 0.5, 0.35, 0.25, 0.15, 0.1, 0.05, 0.025, 0.01)


def scored_blends(oof_wide: DataFrame, members: Sequence[str], label: str, metric: str, weights: Sequence[Sequence[float]]) -> list[float]:
    """The metric of each blend (weights that add up to one); all in one grouped aggregation."""
    m = M.Metric(metric)
    points = F.array(*[F.struct(F.lit(i).alias("point"), F.array(*[F.lit(float(w)) for w in ws]).alias("weights")) for i, ws in enumerate(weights)])
    rows = (oof_wide.select(label, F.array(*[F.col(c).cast("double") for c in members]).alias("_all"), F.explode(points).alias("_t"))
            .select(label, "_t.point", F.aggregate(F.zip_with("_all", "_t.weights", lambda p, w: p * w), F.lit(0.0), lambda a, x: a + x).alias("_blend")))
    told = {r["point"]: r[m.value] for r in M.evaluate(rows, m, label, "_blend", by=["point"]).collect()}
    return [float(told[i]) if told.get(i) is not None else float("nan") for i in range(len(weights))]


def search_weights(oof_wide: DataFrame, members: Sequence[str], label: str, metric: str, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Weights found along the edges from the best blend so far to each member, and away from it.

    A round tries ``SHARES`` of the way to every member, and of its own weight
    away from it: candidates grow with the members, not with their
    combinations.  The best strictly better one is taken; without one, the
    search ends.  It starts from the best single member or the equal blend, so
    the result is never worse than any of them.
    """
    m, k = M.Metric(metric), len(members)
    sign = -1.0 if m.maximise else 1.0
    worth = lambda scores: [sign * x if x == x else float("inf") for x in scores]
    starts = [*np.eye(k), np.full(k, 1 / k)]
    scores = worth(scored_blends(oof_wide, members, label, metric, starts))
    best = int(np.argmin(scores))
    v, at = starts[best], scores[best]
    for _ in range(rounds):
        tried = []
        for i in range(k):
            tried += [(1 - t) * v + t * np.eye(k)[i] for t in SHARES]
            if 0 < v[i] < 1:
                for t in SHARES:                        # the member keeps 1 - t of its weight, the others share the rest
                    w = v.copy()
                    w[i] *= 1 - t
                    tried.append(w / w.sum())
        scores = worth(scored_blends(oof_wide, members, label, metric, tried))
        best = int(np.argmin(scores))
        if not scores[best] < at:
            break
        v, at = tried[best], scores[best]
    return v, sign * at


def fit_weighted_metric(oof_wide: DataFrame, members: Sequence[str], label: str, metric: str, steps: int = 10) -> WeightedEnsemble:
    """Weights best for ``metric``: exact for squared error, else the best point of a lattice (first wins), if it has
    ``LATTICE_POINTS`` points at most; for more members, by a search along the simplex's edges."""
    m = M.Metric(metric)
    if m in (M.Metric.RMSE, M.Metric.MSE):
        return fit_weighted(oof_wide, members, label)
    if math.comb(steps + len(members) - 1, len(members) - 1) > LATTICE_POINTS:
        w = search_weights(oof_wide, members, label, metric)[0]
    else:
        order = F.col(m.value).desc() if m.maximise else F.col(m.value).asc()
        w = blend_lattice(oof_wide, members, label, metric, steps).where(F.col(m.value).isNotNull()).orderBy(order, "point").first()["weights"]
    w = np.maximum(np.array(w), MIN_WEIGHT)
    return WeightedEnsemble(list(members), w / w.max())


def ensemble_score(oof_wide: DataFrame, ens: WeightedEnsemble, label: str, metric: str) -> DataFrame:
    """(member_mean, ensemble): mean of the members' scores, and the score of the blend itself."""
    m = M.Metric(metric)
    both = oof_wide.withColumn("_blend", ens.predict_col())
    names = [*ens.members, "_blend"]
    long = both.select(label, F.explode(F.array(*[F.struct(F.lit(n).alias("_who"), F.col(n).cast("double").alias("_p")) for n in names])).alias("_s"))
    scored = M.evaluate(long.select(label, "_s._who", "_s._p"), m, label, "_p", by=["_who"])
    return scored.agg(F.avg(F.when(F.col("_who") != "_blend", F.col(m.value))).alias("member_mean"),
                      F.max(F.when(F.col("_who") == "_blend", F.col(m.value))).alias("ensemble"))


@dataclass
class WeightedEnsemble:
    members: list[str]
    weights: np.ndarray

    def predict_col(self):
        from tabfold.functions.columns import weighted_average
        return weighted_average(self.members, list(self.weights))

    def frame(self, spark) -> DataFrame:
        return spark.createDataFrame([(m, float(w), float(w / self.weights.sum()))
                                      for m, w in zip(self.members, self.weights)],
                                     "member string, weight double, share double")


def fit_weighted(oof_wide: DataFrame, members: Sequence[str], label: str) -> WeightedEnsemble:
    """Weights minimising the MSE of Σ w_i p_i / Σ w_i (exact, RMSE/MSE objective)."""
    g = error_gram(oof_wide, members, label)
    v = simplex_least_squares(g["E"] / g["n"], np.zeros(len(members)))
    w = np.maximum(v, MIN_WEIGHT)
    return WeightedEnsemble(list(members), w / w.max())


def blend_lattice_rmse(oof_wide: DataFrame, a: str, b: str, label: str, steps: int = 100) -> DataFrame:
    """RMSE of t*a + (1-t)*b for t = i/steps: every lattice point from one Gram aggregation."""
    g = error_gram(oof_wide, [a, b], label)
    n, E = g["n"], g["E"]
    rows = []
    for i in range(steps + 1):
        t = i / steps
        v = np.array([t, 1 - t])
        mse = (v @ E @ v) / n
        rows.append((i, t, float(np.sqrt(max(mse, 0.0)))))
    return oof_wide.sparkSession.createDataFrame(rows, "i int, t double, rmse double")


def fit_stacked(oof_wide: DataFrame, members: Sequence[str], label: str, alpha: float = 0.1):
    """Ridge (alpha, unpenalised intercept) of the label on member predictions."""
    return linear.fit_all(oof_wide, list(members), label, alpha)


def member_predictions(df: DataFrame, models: Mapping[str, object], key: str, proba: bool = False) -> DataFrame:
    """Every member's prediction (or positive-class probability) of the same rows -> (key, <member>...).

    Row by row: each member's pipeline is a projection over the rows as they
    came in, so nothing is shuffled and null or repeated keys are rows like
    any other.
    """
    made = {"features", "rawPrediction", "probability", "prediction"}      # names that pipelines write
    rows, done = df.select(F.struct(*df.columns).alias("_own")), []
    for i, model in enumerate(models.values()):
        seen = [F.col("_own").getField(c).alias(c) for c in df.columns if c not in made]
        scored = L.predict(model, rows.select(*seen, "_own", *done), f"_member{i}", proba)
        done.append(f"_member{i}")
        rows = scored.select("_own", *done)
    return rows.select(F.col("_own").getField(key).alias(key), *[F.col(c).cast("double").alias(n) for c, n in zip(done, models, strict=True)])


def stacked_coefficients(fit) -> DataFrame:
    """Meta-learner coefficients, largest first (intercept excluded)."""
    return linear.coefficients(fit).where(F.col("term") != "intercept").orderBy(F.col("value").desc(), "term")


def memoised_leaderboard(spark, path: str, compute):
    """E1 memoisation: (leaderboard, oof_wide) read from ``path`` if written
    before, else computed by ``compute()`` and written there (parquet)."""
    from tabfold.session import path_exists
    if not (path_exists(spark, f"{path}/leaderboard") and path_exists(spark, f"{path}/oof")):
        lb, oof = compute()
        lb.write.mode("overwrite").parquet(f"{path}/leaderboard")
        oof.write.mode("overwrite").parquet(f"{path}/oof")
    return spark.read.parquet(f"{path}/leaderboard"), spark.read.parquet(f"{path}/oof")


def features_of(features: Sequence[str] | Mapping[str, Sequence[str]], member: str) -> list[str]:
    """A member's features: its own, if they are given by member."""
    return list(features[member] if isinstance(features, Mapping) else features)


def leaderboard_job(df: DataFrame, learners: Mapping[str, L.Learner], features: Sequence[str] | Mapping[str, Sequence[str]],
                    label: str, key: str, metric: str = "rmse", k: int = 5, grids: Mapping[str, Sequence[Mapping]] | None = None,
                    groups=None, stratify=None, carry: Sequence[str] = (), callback=None) -> tuple[DataFrame, DataFrame, dict]:
    """Tune (if a grid is given) and validate every member on the same folds.

    ``features``: of all members, or by member.  Returns the leaderboard
    (member, <metric>, rounds) in the metric's order, the wide out-of-fold
    frame (key, <member>..., label, carried columns; a row for each row of
    ``df``, whatever its key), and each member's parameters.  ``callback`` is
    called with the first two when all members are validated.
    """
    from tabfold.plans import tuning
    from tabfold.plans.validate import ROW, CachedFolds
    spark = df.sparkSession
    every = list(dict.fromkeys(f for name in learners for f in features_of(features, name)))
    folds = CachedFolds(df, key, label, every, k, groups=groups, stratify=stratify, carry=carry)
    rows, oofs, chosen = [], {}, {}
    for name, learner in learners.items():
        cache = folds.only(features_of(features, name))
        chosen[name] = dict(learner.params)
        if grids and name in grids:
            chosen[name] = tuning.tune_grid(spark, cache, learner, metric, grids[name]).params
        cv = cache.cross_validate(learner, metric, chosen[name])
        rows.append((name, float(cv.score), int(cv.rounds)))
        oofs[name] = cv.oof.select(ROW, "prediction")
    scores = spark.createDataFrame(rows, f"member string, {M.Metric(metric).value} double, rounds int")
    # a row is told by the id it got when the folds were written, never by its key
    own = [F.col(c).alias(f"o{i}") for i, c in enumerate(dict.fromkeys([key, label, *carry]))]
    wide = widen_oof(oofs, key=ROW, label="_own", label_df=folds.folded.select(ROW, F.struct(*own).alias("_own")))
    wide = wide.select(*[F.col(f"_own.o{i}").alias(c) for i, c in enumerate(dict.fromkeys([key, label, *carry]))], *learners)
    board = leaderboard(scores, metric)
    if callback is not None:
        callback(board, wide)
    return board, wide, chosen


def train_ensemble_job(df: DataFrame, learners: Mapping[str, L.Learner], features: Sequence[str] | Mapping[str, Sequence[str]] | None,
                       label: str, key: str, model_dir: str, metric: str = "rmse", k: int = 5, kind: str = "weighted", steps: int = 10,
                       grids: Mapping[str, Sequence[Mapping]] | None = None, groups=None, stratify=None,
                       preprocessor=None, class_col: str | None = None, cuts: Sequence[float] = SEVERITY_CUTS,
                       required: Sequence[str] = (), callback=None, sized: bool = False) -> dict:
    """Leaderboard, weights (or a ridge stack) on its out-of-fold frame, members refitted on all
    rows with the leaderboard's rounds, everything saved below ``model_dir``: preprocessor, the data model of
    raw rows, members, weights.

    ``class_col``: the real classes; the score weight is then tuned on the
    blend's out-of-fold scores, and scoring gives classes, too.  For a metric
    of AUC the members' probabilities are blended, in the fit as in scoring.
    ``required``: columns without which a raw row is rejected.
    """
    from pyspark.ml import PipelineModel
    from tabfold.plans.scoring import prepare, save_meta, size_session, tuned_weight
    from tabfold.session import cut_lineage
    spark, names = df.sparkSession, list(learners)
    if sized:
        size_session(df)
    every = features if features is None else list(dict.fromkeys(f for n in names for f in features_of(features, n)))
    first, every, df = prepare(spark, df, key, every, label, class_col, model_dir, preprocessor, groups, stratify)
    features = every if features is None else features
    if stratify is None and all(x.objective == "classification" for x in learners.values()):
        stratify = label
    board, wide, chosen = leaderboard_job(df, learners, features, label, key, metric, k, grids, groups, stratify,
                                          [class_col] if class_col else [], callback)
    wide = cut_lineage(wide)
    rounds = {r["member"]: r["rounds"] for r in board.collect()}
    meta = {"key": key, "members": names, "kind": kind, "features": {n: features_of(features, n) for n in names}, "metric": M.Metric(metric).value,
            "proba": M.Metric(metric) is M.Metric.AUC, "preprocessed": bool(first), "required": list(required), "n_rows": wide.count()}
    if kind == "stacked":
        fit = fit_stacked(wide, names, label)
        meta["coefficients"] = {r["term"]: r["value"] for r in linear.coefficients(fit).collect()}
    else:
        ens = fit_weighted_metric(wide, names, label, metric, steps)
        meta["weights"] = [float(w) for w in ens.weights]
        score = ensemble_score(wide, ens, label, metric).first()
        meta["member_mean"], meta["ensemble"] = score["member_mean"], score["ensemble"]
    if class_col is not None:
        meta["cuts"] = list(cuts)
        meta["weight"] = tuned_weight(wide.withColumn("_blend", blended(meta)), class_col, "_blend", cuts)
    if first:
        PipelineModel(stages=first).write().overwrite().save(f"{model_dir}/preprocessor")
    for name, learner in learners.items():
        final = L.fit(learner, df, features_of(features, name), label, chosen[name], max(rounds[name], 1) if learner.boosted else None)
        final.model.write().overwrite().save(f"{model_dir}/members/{name}")
    save_meta(spark, f"{model_dir}/meta", meta)
    return meta


def blended(meta: Mapping) -> Column:
    """The ensemble's score from its members' columns."""
    names = meta["members"]
    if meta["kind"] == "stacked":
        c = meta["coefficients"]
        return sum((F.col(n) * F.lit(float(c[n])) for n in names), F.lit(float(c["intercept"])))
    return WeightedEnsemble(names, np.array(meta["weights"])).predict_col()


@dataclass
class EnsembleScorer:
    """A saved ensemble: frozen schema, preprocessor, members, weights."""
    members: dict
    data_model: dict
    meta: dict
    first: object | None = None

    @classmethod
    def load(cls, spark, model_dir: str) -> EnsembleScorer:
        from pyspark.ml import PipelineModel
        from tabfold.plans.scoring import load_meta
        meta = load_meta(spark, f"{model_dir}/meta")
        return cls({n: PipelineModel.load(f"{model_dir}/members/{n}") for n in meta["members"]},
                   S.load_data_model(spark, f"{model_dir}/data_model"), meta,
                   PipelineModel.load(f"{model_dir}/preprocessor") if meta["preprocessed"] else None)

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(accepted, rejects): rows as the frozen columns; rejects have a ``reason``.  Together they are ``df``'s rows."""
        told = S.with_reasons(df, self.data_model, required=self.meta["required"], reason="_reason")
        return (told.where(F.col("_reason").isNull()).drop("_reason"),
                told.where(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason"))

    def score(self, df: DataFrame, weight: float | None = None) -> DataFrame:
        """(key, <member>..., prediction[, class]) of every accepted row; no shuffle."""
        rows = self.split(df)[0]
        if self.first is not None:
            rows = self.first.transform(rows)
        out = member_predictions(rows, self.members, self.meta["key"], self.meta["proba"]).withColumn("prediction", blended(self.meta))
        if "cuts" not in self.meta:
            return out
        return out.withColumn("class", scaled_class("prediction", float(weight if weight is not None else self.meta["weight"]), self.meta["cuts"]))


def score_ensemble(spark, model_dir: str, df: DataFrame) -> DataFrame:
    """(key, <member>..., prediction) of a saved ensemble."""
    return EnsembleScorer.load(spark, model_dir).score(df)
