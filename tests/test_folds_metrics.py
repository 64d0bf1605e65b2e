import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from tabfold.operators import folds as K
from tabfold.operators import metrics as M
from tabfold.operators import sweep as W
from tabfold.sources.tables import read_table


def test_kfold_partitions_and_is_stable_under_repartition(spark):
    o = read_table(spark, SF01, "orders").select("o_orderkey")
    a = K.kfold(o, "o_orderkey", 5)
    b = K.kfold(o.repartition(13), "o_orderkey", 5)
    assert a.count() == o.count() and a.where("fold < 0 or fold > 4").count() == 0
    assert a.exceptAll(b).count() == 0
    sizes = [r[1] for r in a.groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) < 0.1 * max(sizes)


def test_group_folds_never_split_groups(spark):
    e = read_table(spark, SF01, "events").select("event_id", "user_id")
    for balanced in (False, True):
        f = K.group_kfold(e, "user_id", 5, balanced=balanced)
        assert f.groupBy("user_id").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0
        assert f.count() == e.count()


def test_balanced_group_kfold_with_giant_group(spark):
    rows = [(i, 0) for i in range(3000)] + [(3000 + i, 1 + i % 400) for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, g long")
    f = K.group_kfold(df, "g", 3, balanced=True)
    sizes = dict(f.groupBy("fold").count().collect())
    giant_fold = f.where("g = 0").select("fold").distinct().collect()
    assert len(giant_fold) == 1 and sizes[giant_fold[0][0]] == 3000     # the giant group sits alone
    others = [v for k, v in sizes.items() if k != giant_fold[0][0]]
    assert sum(sizes.values()) == 9000 and min(others) > 0.7 * max(others)
    assert f.groupBy("g").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0


def test_stratified_matches_plain_row_number(spark):
    o = read_table(spark, SF01, "orders").select("o_orderkey", "o_orderstatus")
    got = K.stratified_kfold(o, "o_orderkey", "o_orderstatus", 5)
    from pyspark.sql import Window
    w = Window.partitionBy("o_orderstatus").orderBy(K.key_md5("o_orderkey"), "o_orderkey")
    ref = o.withColumn("fold", ((F.row_number().over(w) - 1) % 5).cast("int"))
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0
    per = got.groupBy("o_orderstatus", "fold").count().groupBy("o_orderstatus") \
        .agg((F.max("count") - F.min("count")).alias("d")).collect()
    assert all(r.d <= 1 for r in per)


def test_stratified_group(spark):
    e = read_table(spark, SF01, "events").select("event_id", "user_id", "event_type")
    f = K.stratified_group_kfold(e, "user_id", "event_type", 5)
    assert f.count() == e.count()
    assert f.groupBy("user_id").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0


def test_fewer_groups_than_k(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(10)], "id long, g long")
    f = K.group_kfold(df, "g", 5, balanced=True)
    assert f.select("fold").distinct().count() <= 2


def test_holdout_share(spark):
    o = read_table(spark, SF01, "orders").select("o_orderkey")
    share = K.holdout(o, "o_orderkey").agg(F.avg(F.col("is_valid").cast("double"))).first()[0]
    assert 0.22 < share < 0.28


def brute_kappa(y, p, quadratic=True):
    labels = sorted(set(y) | set(p))
    idx = {v: i for i, v in enumerate(labels)}
    n = len(labels)
    cm = np.zeros((n, n))
    for a, b in zip(y, p):
        cm[idx[a], idx[b]] += 1
    r = np.arange(n)
    w = (r[:, None] - r[None, :]) ** 2 if quadratic else (r[:, None] != r[None, :]).astype(float)
    e = np.outer(cm.sum(1), cm.sum(0)) / cm.sum()
    return 1 - (w * cm).sum() / (w * e).sum()


CASES = {
    "perfect": ([0, 1, 2, 3, 2], [0, 1, 2, 3, 2]),
    "ties": ([0, 0, 1, 1, 2, 2], [0, 1, 1, 2, 2, 0]),
    "missing_class": ([0, 1, 1, 3], [0, 1, 3, 3]),
    "label_gap": ([0, 5, 5, 9], [0, 5, 9, 9]),
}


@pytest.mark.parametrize("case", list(CASES))
def test_kappa_against_brute_force(spark, case):
    y, p = CASES[case]
    df = spark.createDataFrame(list(zip(range(len(y)), y, p)), "id long, y long, p long")
    q = M.qwk(df, "y", "p").first()[0]
    k = M.kappa_from_confusion(M.confusion(df, "y", "p"), "unweighted").first()[0]
    assert q == pytest.approx(brute_kappa(y, p, True))
    assert k == pytest.approx(brute_kappa(y, p, False))


def test_constant_prediction_kappa_is_zero(spark):
    df = spark.createDataFrame([(i, i % 3, 1) for i in range(9)], "id long, y long, p long")
    assert M.qwk(df, "y", "p").first()[0] == pytest.approx(0.0)


def brute_auc(y, s):
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a != 1]
    tot = sum((1.0 if p > n else 0.5 if p == n else 0.0) for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_auc_exact_with_ties_and_many_buckets(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 3000).tolist()
    s = (np.round(rng.normal(size=3000) + np.array(y) * 0.7, 1)).tolist()
    df = spark.createDataFrame(list(zip(y, s)), "y long, s double")
    assert M.auc(df, "y", "s", by_bucket=16).first()[0] == pytest.approx(brute_auc(y, s))


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 1.0)], "y double, p double")
    r = M.regression_metrics(df, "y", "p").first()
    assert (r.mae, r.mse, r.rmse) == pytest.approx((1.5, 2.5, 2.5 ** 0.5))
    with pytest.raises(ValueError):
        M.check_compatible("auc", "regression")


def test_sweep_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    s = np.concatenate([rng.uniform(-10, 110, 2000), [30 / 0.8, 50 / 1.2, 80 / 1.5, 0.0, 25.0]])
    real = np.digitize(s * 1.1 + rng.normal(0, 8, len(s)), [30, 50, 80])
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(real, s)], "real long, score double")
    curve = {r.j: r.kappa for r in W.sweep(df, "real", "score").collect()}
    for j in range(0, 701, 7):
        w = (800 + j) / 1000.0
        pred = np.digitize(s * w, [30, 50, 80])
        assert curve[j] == pytest.approx(brute_kappa(real.tolist(), pred.tolist()), abs=1e-12)


def test_grouped_auc_matches_per_group(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 4000).tolist()
    s = np.round(rng.normal(size=4000) + np.array(y) * 0.5, 2).tolist()
    g = (np.arange(4000) % 3).tolist()
    df = spark.createDataFrame(list(zip(g, y, s)), "g int, y long, s double")
    got = {r.g: r.auc for r in M.auc_by(df, "y", "s", ["g"]).collect()}
    for k in range(3):
        ys = [a for a, b in zip(y, g) if b == k]
        ss = [a for a, b in zip(s, g) if b == k]
        assert got[k] == pytest.approx(brute_auc(ys, ss))
