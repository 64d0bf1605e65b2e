"""Frozen data model: export a schema as {column: int|float|str}, enforce it on new rows."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPARK_TYPE = {"int": "bigint", "float": "double", "str": "string"}


def map_dtype(dt: T.DataType) -> str:
    """int / float / str; booleans, dates, timestamps and the rest are str."""
    if isinstance(dt, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return "int"
    if isinstance(dt, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "float"
    return "str"


def data_model(schema: T.StructType, nullable_int_as_float: bool = False) -> dict[str, str]:
    """{column: type}; optionally report nullable ints as float (pandas' view)."""
    out = {}
    for f in schema.fields:
        t = map_dtype(f.dataType)
        if nullable_int_as_float and t == "int" and f.nullable:
            t = "float"
        out[f.name] = t
    return out


def infer_data_model(df: DataFrame) -> dict[str, str]:
    """{column: type} where an integer column holding any null is reported as
    float (how a CSV reader without nullable ints types it).  One aggregation."""
    ints = [f.name for f in df.schema.fields if map_dtype(f.dataType) == "int"]
    has_null = {}
    if ints:
        r = df.agg(*[F.max(F.col(c).isNull().cast("int")).alias(c) for c in ints]).first()
        has_null = {c: bool(r[c]) for c in ints}
    return {f.name: ("float" if has_null.get(f.name) else map_dtype(f.dataType)) for f in df.schema.fields}


def save_data_model(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """Write ``{"fields": {...}}`` as a one-line JSON text file (any Hadoop path)."""
    doc = json.dumps({"fields": data_model(schema)})
    spark.createDataFrame([(doc,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_data_model(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def to_struct(model: dict) -> T.StructType:
    fields = model["fields"] if "fields" in model else model
    return T.StructType([T.StructField(c, T._parse_datatype_string(_SPARK_TYPE[t]), True)
                         for c, t in fields.items()])


def enforce(df: DataFrame, model: dict, required: Sequence[str] | None = None,
            flag: str | None = None) -> DataFrame:
    """Project to the model's columns with ``try_cast`` (bad values -> null).

    ``required`` (default: every model column) must be non-null; with ``flag``
    the check is a boolean column, otherwise failing rows are dropped.
    Columns missing from ``df`` appear as nulls (and fail if required).
    """
    fields = model["fields"] if "fields" in model else model
    cols = []
    for c, t in fields.items():
        src = F.col(c) if c in df.columns else F.lit(None)
        cols.append(src.try_cast(_SPARK_TYPE[t]).alias(c))
    out = df.select(*cols)
    req = list(required) if required is not None else list(fields)
    ok = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in req], F.lit(True))
    return out.withColumn(flag, ok) if flag else out.where(ok)


def split_rejects(df: DataFrame, model: dict, required: Sequence[str] | None = None):
    """(accepted, rejects) frames from one enforced projection."""
    flagged = enforce(df, model, required, flag="_ok")
    return flagged.where("_ok").drop("_ok"), flagged.where("NOT _ok").drop("_ok")


def with_reasons(df: DataFrame, model: dict, required: Sequence[str] | None = None, reason: str = "reason") -> DataFrame:
    """Every row of ``df`` as the model's columns, with why it cannot be used (null: it can).

    ``missing:c`` for a required column without a value, ``uncastable:c`` for a
    value of any column that its type cannot hold; several are joined by ``;``.
    """
    fields = model["fields"] if "fields" in model else model
    req = set(required if required is not None else fields)
    cols, why = [], []
    for c, t in fields.items():
        src = F.col(c) if c in df.columns else F.lit(None).cast("string")
        cast = src.try_cast(_SPARK_TYPE[t])
        cols.append(cast.alias(c))
        bad = src.isNotNull() & cast.isNull()
        tell = F.when(bad, F.lit(f"uncastable:{c}"))
        why.append(tell.when(src.isNull(), F.lit(f"missing:{c}")) if c in req else tell)
    told = F.concat_ws(";", *why) if why else F.lit("")
    return df.select(*cols, F.when(told != "", told).alias(reason))
