"""Hot keys: a class or group holding a third of all rows."""

from pyspark.sql import functions as F

from tabfold.operators import folds as K
from tabfold.operators import metrics as M
from tabfold.operators.profile import duplicate_count


def skewed(spark, n=60_000):
    # class 0 holds a third of the rows, the rest spread over 50 classes
    return spark.range(n).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(0))
                                 .otherwise(1 + F.col("id") % 50).alias("label"))


def test_stratified_hot_class_slices_are_small_and_folds_exact(spark):
    df = skewed(spark)
    salted = df.withColumn("_salt", F.substring(K.key_md5("id"), 1, K.SALT_HEX_DIGITS))
    biggest = salted.groupBy("label", "_salt").count().agg(F.max("count")).first()[0]
    assert biggest < 20                      # 20,000 hot rows spread over 65,536 slices
    f = K.stratified_kfold(df, "id", "label", 5)
    per = f.groupBy("label", "fold").count().groupBy("label") \
        .agg((F.max("count") - F.min("count")).alias("d")).agg(F.max("d")).first()[0]
    assert per <= 1 and f.count() == df.count()


def test_hot_score_and_hot_duplicate_collapse(spark):
    df = skewed(spark).withColumn("score", F.when(F.col("label") == 0, F.lit(0.5))
                                  .otherwise(F.col("id") % 97 / 97.0)) \
        .withColumn("y", (F.col("id") % 2).cast("int"))
    a = M.auc(df, "y", "score").first()[0]
    assert 0.0 <= a <= 1.0
    d = duplicate_count(df.select(F.when(F.col("label") == 0, F.lit("same")).otherwise(F.col("id").cast("string"))
                                  .alias("t")), ["t"]).first()
    assert d.n_rows == 60_000 and d.n_duplicates == 20_000 - 1


def test_group_hot_group_kept_whole_and_alone(spark):
    df = skewed(spark).withColumn("g", F.when(F.col("label") == 0, F.lit(-1)).otherwise(F.col("id") % 4000))
    f = K.group_kfold(df, "g", 3, balanced=True)
    assert f.where("g = -1").select("fold").distinct().count() == 1
    sizes = dict(f.groupBy("fold").count().collect())
    assert max(sizes.values()) <= 1.15 * 20_000
