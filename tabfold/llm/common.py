"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfold.session import scratch_path

#: ASCII white space: what separates words in every operator of this package.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stash(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage with columnar, compressed files that outlive any executor.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()
_SHIPPING = threading.Lock()


BATCH_BYTES = 4 << 20         # of texts that a Python worker holds at a time, about


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application (as ``--py-files`` would),
    and keep the batches of texts that they get small."""
    sc = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    with _SHIPPING:                 # folds are fitted in threads
        if sc.applicationId in _SHIPPED:
            return
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        name = os.path.basename(top)
        archive = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), f"{name}.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, files in os.walk(top):
                for f in files:
                    if f.endswith(".py"):
                        z.write(os.path.join(folder, f), os.path.join(name, os.path.relpath(os.path.join(folder, f), top)))
        sc.addPyFile(archive)
        _SHIPPED.add(sc.applicationId)


BROADCAST_BYTES = 32 << 20    # of rows that are sent to every executor, at most


def few_bytes(df: DataFrame, size: Column) -> DataFrame:
    """``df`` to be broadcast, if its rows (of ``size`` bytes each) are few enough; else as it is."""
    total = df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def spent() -> None:
    """Give back what a task of a Python worker does not need any more: the worker itself lives on, idle, beside other stages."""
    import pyarrow
    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):        # another C library
        pass


class Remembered(dict):
    """Values made once for each key; about twice ``limit`` keys stay, those used last."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

    def forget(self) -> None:
        self.clear()
        self.old.clear()


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, also where body uses it within a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def utf8(col: str = "text") -> Column:
    """The text's UTF-8 bytes (null: none)."""
    return F.encode(text_or_empty(col), "UTF-8")
