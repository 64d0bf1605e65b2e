"""Readers for the parquet tables a job works on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst pushes filters and prunes columns into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NaN means missing: turn it into SQL NULL so medians/sorts ignore it."""
    fractional = {f.name for f in df.schema.fields
                  if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    cols = [c for c in (cols or df.columns) if c in fractional]
    if not cols:
        return df
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in cols})
