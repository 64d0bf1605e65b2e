"""Running sums in a global order, without a stage that all rows pass through.

Rows are dealt to ranges of the order and written; each range's total is one
row; a window within a range adds what the ranges before it hold.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabfold.session import scratch_path


def running_sum(rows: DataFrame, order: Sequence[Column], value: str, ranges: int | None = None, out: str = "before") -> tuple[DataFrame, int]:
    """``rows`` with ``out``: the sum of ``value`` (whole numbers) over all rows earlier in ``order``; and the sum over all rows.

    ``order`` must tell rows apart, or rows alike in it get sums in any order
    among them.  ``ranges`` defaults to the session's shuffle partitions; the
    driver holds a number for each.
    """
    spark = rows.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, f"ranges-{uuid.uuid4().hex}")
    rows.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.parquet(path)
    starts, total = [], 0
    for r in dealt.groupBy("_range").agg(F.sum(value).alias("s")).orderBy("_range").collect():
        starts.append((r["_range"], total))
        total += int(r["s"] or 0)
    # a row for each range
    offsets = spark.createDataFrame(starts or [(0, 0)], "_of int, _start long")
    own = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = (dealt.withColumn("_own", F.coalesce(F.sum(value).over(own), F.lit(0)))
              .join(F.broadcast(offsets), F.col("_range") == F.col("_of"))
              .withColumn(out, F.col("_own") + F.col("_start")))
    return summed.drop("_range", "_of", "_start", "_own"), total


def running_sums_by(rows: DataFrame, by: Sequence[str], order: Sequence[Column], values: Sequence[str],
                    ranges: int | None = None) -> DataFrame:
    """``rows`` with ``<value>_before`` for each of ``values``: its sum over the earlier rows of the same group.

    Ranges are cut across groups: a group of any size is spread over many of
    them, and many small groups share one.  Null groups are groups like any
    other.  Nothing comes to the driver.
    """
    spark, by = rows.sparkSession, list(by)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, f"ranges-{uuid.uuid4().hex}")
    rows.repartitionByRange(ranges, *by, *order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.parquet(path)
    totals = dealt.groupBy(*by, "_range").agg(*[F.sum(v).alias(f"_t{i}") for i, v in enumerate(values)])
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], F.col("_range").alias("_of"),
                           *[F.coalesce(F.sum(f"_t{i}").over(earlier), F.lit(0)).alias(f"_s{i}") for i in range(len(values))])
    own = Window.partitionBy("_range", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("_range") == F.col("_of")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    summed = dealt.withColumns({f"_o{i}": F.coalesce(F.sum(v).over(own), F.lit(0)) for i, v in enumerate(values)}).join(starts, same)
    return summed.select(*rows.columns, *[(F.col(f"_o{i}") + F.col(f"_s{i}")).alias(f"{v}_before") for i, v in enumerate(values)])
