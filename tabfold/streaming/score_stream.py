"""Stateless stream scoring: new files in a folder -> the saved pipeline -> classes and rejects.

The fitted state (medians, drop list, trees) comes from training and is
loaded once; a micro-batch never refits anything.  No aggregation, so the
query runs in append mode without a watermark.

Every row of a micro-batch is scored or rejected with the reason.  Both go to
folders of their own, a folder a batch (``batch=<id>``): a batch that is run
again after a failure overwrites what it had written, so neither is lost nor
doubled, and readers see the id as a column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tabfold.plans.scoring import Scorer
from tabfold.sources import schema as S


def start_scoring(spark: SparkSession, src_dir: str, model_dir: str, out_dir: str, checkpoint: str,
                  available_now: bool = True, max_files_per_trigger: int | None = None, rejects_dir: str | None = None) -> StreamingQuery:
    """Score the files of ``src_dir`` as they come; rejected rows go to ``rejects_dir`` (default: ``rejects_of(out_dir)``)."""
    scorer = Scorer.load(spark, model_dir)
    rejects_dir = rejects_dir or rejects_of(out_dir)
    # raw text where files hold it: a value that does not fit its column is a reject, not an error
    reader = spark.readStream.schema(raw_schema(spark, src_dir, scorer))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def write(batch: DataFrame, batch_id: int) -> None:
        rejects = scorer.split(batch)[1]
        scorer.score(batch).write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")
        rejects.write.mode("overwrite").parquet(f"{rejects_dir}/batch={batch_id}")
    w = reader.parquet(src_dir).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def rejects_of(out_dir: str) -> str:
    return f"{out_dir.rstrip('/')}-rejects"


def raw_schema(spark: SparkSession, src_dir: str, scorer: Scorer) -> T.StructType:
    """The columns of the data model, each of the type that the files have there (the model's own where they have none)."""
    there = {f.name: f.dataType for f in spark.read.parquet(src_dir).schema.fields}
    return T.StructType([T.StructField(f.name, there.get(f.name, f.dataType), True) for f in S.to_struct(scorer.data_model).fields])


def score_stream(spark: SparkSession, src_dir: str, model_dir: str, out_dir: str, checkpoint: str, rejects_dir: str | None = None):
    """Process everything available now, wait, and return the scored output as a batch frame."""
    q = start_scoring(spark, src_dir, model_dir, out_dir, checkpoint, available_now=True, rejects_dir=rejects_dir)
    q.awaitTermination()
    return spark.read.parquet(out_dir).drop("batch")
