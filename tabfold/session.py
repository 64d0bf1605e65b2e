"""Session helpers: local sessions for tests/bench, shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

_LOCAL_CKPT: dict[str, str] = {}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tabfold", extra: dict | None = None) -> SparkSession:
    """A local[N] session configured like the cluster one (AQE on, UI off)."""
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.driver.memory", os.environ.get("TABFOLD_DRIVER_MEMORY", "16g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local-mode session without that setting gets a private folder
    (tests, bench); on a cluster an unset folder is an error, because a
    machine-local path would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    key = sc.applicationId
    if key not in _LOCAL_CKPT:
        _LOCAL_CKPT[key] = tempfile.mkdtemp(prefix="tabfold-ckpt-")
    sc.setCheckpointDir(_LOCAL_CKPT[key])
    return _LOCAL_CKPT[key]


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return base.rstrip("/") + "/tables/" + name


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (Hadoop FileSystem API, any scheme)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return int(total)


def size_for_input(spark: SparkSession, n_bytes: int, partition_bytes: int = 256 << 20,
                   min_partitions: int = 200) -> int:
    """Size shuffles and scans for an input of ``n_bytes`` so each task's share
    fits executor memory: scan splits and post-shuffle partitions target
    ``partition_bytes``; AQE coalesces small partitions and splits skewed ones
    above five times the median.  Returns the shuffle partition count."""
    parts = max(min_partitions, -(-n_bytes // partition_bytes))
    for k, v in {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
    }.items():
        spark.conf.set(k, v)
    return parts


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists (Hadoop FileSystem API, any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))
