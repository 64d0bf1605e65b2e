"""Stratified group folds by greedy placement, and AUC by group, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from tabfold.operators import folds as K
from tabfold.operators import metrics as M


def made(sizes, seed=0):
    rand, rows = random.Random(seed), []
    for g, (n, lean) in enumerate(sizes):
        rows += [(len(rows) + j, None if g == 0 else f"g{g}", "ABC"[min(2, int(rand.random() * 3 * lean))]) for j in range(n)]
    return rows


def shares(rows, fold_of, k):
    total, part, sizes = {}, {}, [0] * k
    for _, g, c in rows:
        f = fold_of[g]
        total[c] = total.get(c, 0) + 1
        part[f, c] = part.get((f, c), 0) + 1
        sizes[f] += 1
    return sum((part.get((f, c), 0) / total[c] - 1 / k) ** 2 for f in range(k) for c in total), max(sizes) - min(sizes)


@pytest.mark.parametrize("k", [3, 5])
def test_shares_and_sizes_beat_the_dominant_class(spark, k):
    rand = random.Random(k)
    rows = made([(rand.choice([3, 5, 8, 60, 150, 400]), rand.uniform(0.3, 1.2)) for _ in range(60)])
    df = spark.createDataFrame(rows, "id long, g string, c string")
    folds = {}
    for name, rule in (("greedy", K.stratified_group_kfold), ("dominant", K.dominant_class_group_kfold)):
        out = rule(df, "g", "c", k)
        assert out.count() == len(rows)
        pairs = {(r["g"], r["fold"]) for r in out.select("g", "fold").distinct().collect()}
        assert len(pairs) == 60 and {f for _, f in pairs} == set(range(k))              # groups are whole, the null group too
        folds[name] = shares(rows, dict(pairs), k)
    assert folds["greedy"][0] < 0.2 * folds["dominant"][0] and folds["greedy"][1] < folds["dominant"][1]


def test_one_huge_group_and_many_small_ones(spark):
    rows = made([(4000, 1.0)] + [(4, 1.0)] * 1500)
    df = spark.createDataFrame(rows, "id long, g string, c string")
    out = K.stratified_group_kfold(df, "g", "c", 2)
    sizes = {r["fold"]: r["count"] for r in out.groupBy("fold").count().collect()}
    assert abs(sizes[0] - sizes[1]) < 500
    assert K.stratified_group_kfold(df.where("false"), "g", "c", 2).count() == 0
    two = K.stratified_group_kfold(df.withColumn("h", F.col("id") % 2), ["g", "h"], "c", 2)
    assert two.groupBy("g", "h").agg(F.count_distinct("fold").alias("n")).where("n <> 1").count() == 0


def test_auc_of_groups_of_any_size(spark):
    rand = random.Random(1)
    rows = [("big", round(rand.random(), 4), int(rand.random() < 0.4)) for _ in range(4000)]
    rows += [(f"s{i % 700}" if i % 700 else None, rand.choice([0.1, 0.5, 0.9]), rand.randrange(2)) for i in range(2800)]
    rows += [("all one", 0.3, 1), ("all one", 0.4, 1), ("big", None, 1), ("big", 0.5, None)]
    got = {r["g"]: r["auc"] for r in M.auc_by(spark.createDataFrame(rows, "g string, s double, y int"), "y", "s", ["g"]).collect()}
    by = {}
    for g, s, y in rows:
        if s is not None and y is not None:
            by.setdefault(g, ([], []))[y].append(s)
    assert set(got) == set(by)
    for g, (neg, pos) in by.items():
        if not neg or not pos:
            assert got[g] is None
        elif g != "big":
            assert got[g] == pytest.approx(sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg))
    neg, pos = (sorted(v) for v in by["big"])
    import bisect
    won = sum(bisect.bisect_left(neg, p) + (bisect.bisect_right(neg, p) - bisect.bisect_left(neg, p)) / 2 for p in pos)
    assert got["big"] == pytest.approx(won / len(pos) / len(neg))
