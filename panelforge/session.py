"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str = "local[8]", app: str = "panelforge",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster the launcher owns these settings."""
    b = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", (extra or {}).get("spark.sql.session.timeZone", "UTC"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there and it is used as is.  Only when it
    is unset (local runs, tests) a fresh private folder is created.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        d = tempfile.mkdtemp(prefix="panelforge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


_scratch: list = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder; what is written there is deleted when the process ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pf-{name}-{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(_drop_scratch)
    _scratch.append((spark, path))
    return path


def _drop_scratch() -> None:
    while _scratch:
        spark, path = _scratch.pop()
        try:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001  the session may already have ended
            return


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the input files (Hadoop FileSystem content summary, any
    filesystem; no data is read)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    total = 0
    for p in ([paths] if isinstance(paths, str) else paths):
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return int(total)


def size_shuffles(spark: SparkSession, paths, target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Size shuffles for the input so a shuffle partition holds about
    ``target_bytes`` (fits executor memory, spills little): sets
    ``spark.sql.shuffle.partitions`` and AQE's advisory size; AQE then
    coalesces small partitions and splits skewed ones at run time.  Returns
    the partition count (at least the default parallelism)."""
    n = max(spark.sparkContext.defaultParallelism, -(-input_bytes(spark, paths) // target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes // 4))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(min(target_bytes, 512 * 1024 * 1024)))
    return n
