"""CSV with line breaks in quoted fields, read by many tasks, against Python's own reader."""

import csv
import io
import random

import pytest

from tabfold.sources import csv as S

VALUES = ["plain", "with, comma", 'say "hi"', "line\nbreak", "two\n\nbreaks\n", "\n", '"', '""\n"', "x\r\ny", " spaced ", "é🙂\n日本", "a" * 300, "1,2\n3,4", "end\\", "\n\n\n\n"]


def written(rows, newline="\n"):
    out = io.StringIO(newline="")
    w = csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator=newline)
    w.writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("split", [700, 1 << 20])
@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_any_splits_give_the_same_rows(spark, tmp_path, split, newline):
    rand = random.Random(split)
    want = []
    for f in range(3):
        rows = [(str(1000 * f + i), rand.choice(VALUES), rand.choice(VALUES)) for i in range(60)]
        want += rows
        text = written([("id", "first name", "second")] + rows, newline)
        (tmp_path / f"{f}.csv").write_text(text[:-len(newline)] if f == 1 else text, newline="")     # no line break at the end
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        df = S.read_csv(spark, str(tmp_path))
        got = df.collect()
        if split < 1 << 20:
            assert S.csv_records(spark, str(tmp_path)).rdd.getNumPartitions() > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert df.columns == ["id", "first name", "second"]
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == sorted(want)


def test_empty_files_headers_alone_and_blank_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert S.read_csv(spark, str(tmp_path / "a.csv")).count() == 0
    (tmp_path / "b.csv").write_text('id,"two\nlines"\n')
    df = S.read_csv(spark, str(tmp_path / "b.csv"))
    assert df.columns == ["id", "two\nlines"] and df.count() == 0
    (tmp_path / "c.csv").write_text("﻿id,v\n\n1,NA\n\n2,x\n3\n4,y,z\n\n", encoding="utf-8")
    got = S.read_csv(spark, str(tmp_path / "c.csv")).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, None), (2, "x"), (3, None), (4, "y")]


def test_schema_and_corrupt_rows(spark, tmp_path):
    (tmp_path / "d.csv").write_text('id,v\n1,"a\nb"\nx,c\n3,d\n')
    got = S.read_csv(spark, str(tmp_path / "d.csv"), S.T.StructType().add("id", "integer").add("v", "string"), corrupt="_bad").collect()
    assert sorted(((r["id"], r["v"], r["_bad"]) for r in got), key=str) == sorted([(1, "a\nb", None), (None, "c", "x,c"), (3, "d", None)], key=str)
    left = S.load_unlabelled(spark, str(tmp_path / "d.csv"), S.T.StructType().add("id", "integer").add("v", "string"), corrupt="_bad")
    assert left.where("_bad IS NOT NULL").count() == 1


def test_write_and_read_again(spark, tmp_path):
    rows = [(i, v) for i, v in enumerate(VALUES)]
    S.write_csv(spark.createDataFrame(rows, "id long, v string").repartition(4), str(tmp_path / "o"), quote_all=True)
    assert sorted(map(tuple, S.read_csv(spark, str(tmp_path / "o")).collect())) == rows
