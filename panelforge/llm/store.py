"""Helpers that several operators share: frozen tables and connected components."""

from __future__ import annotations

import atexit
import gc
import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelforge.session import ensure_checkpoint_dir

_written: list = []


def read_documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_shipped: list = []


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package (once per application): Spark's file server hands a zip of the sources to
    every executor, so they need no installation and no shared folder."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.join(tempfile.mkdtemp(prefix="pf-ship-"), "panelforge_sources.zip")
    with zipfile.ZipFile(name, "w") as z:
        for folder, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    p = os.path.join(folder, f)
                    z.write(p, os.path.relpath(p, os.path.dirname(top)))
    sc.addPyFile(name)
    _shipped.append(sc.applicationId)


def map_batches(df: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow`` with the package shipped."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


ROWS_PER_TASK = 100_000


def freeze(df: DataFrame, name: str, compact: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder of ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with a columnar, compressed table that every executor can
    read, so later stages survive lost executors.  :func:`release` (called
    at exit) deletes the tables of this process.  ``compact`` is for narrow tables that may be far smaller than
    the corpus: they are read by one task per 100,000 rows, so small ones cost no thousand tiny tasks and files.
    """
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"pf-{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    if not _written:
        atexit.register(release)
    _written.append((spark, path))
    found = spark.read.schema(df.schema).parquet(path)
    return found.coalesce(1 + found.count() // ROWS_PER_TASK) if compact else found


def release() -> None:
    """Delete the frozen tables of this process (results read from them must be stored by then)."""
    while _written:
        spark, path = _written.pop()
        try:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001  the session may already have ended
            return


def tidy(spark: SparkSession) -> None:
    """Between long steps: let go of what the finished one left in the driver.  Spark's cleaner removes broadcasts
    and shuffle files once the JVM has collected their handles, which Python's own references hold until then."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    spark._jvm.System.gc()


def parallelism(spark: SparkSession) -> int:
    """Number of shuffle partitions the session is sized for."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` (counted, narrow) rows, else as it is:
    the join then shuffles."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges(a, b)``: one row ``(node, root)`` per node,
    ``root`` the smallest node of its component.

    Alternating large-star / small-star rounds: every round is a few joins and
    aggregations over at most as many rows as there are edges, so no component is ever
    gathered in one task.  Rounds are frozen; raises if they do not settle.
    """
    e = freeze(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .where("u <> v").distinct(), "edges", compact=True)
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small_ = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*")
        e = freeze(small_.where("u <> v").distinct(), "edges", compact=True)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == before:
            roots = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
