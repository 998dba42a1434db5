"""Sinks and ad-hoc SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, header: bool = True) -> None:
    """Write a stage output (Parquet by default; CSV only at the edges)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.options(header=header, quote='"', escape='"')
    w.format(fmt).save(path)


def write_run_summary(records: DataFrame, path: str) -> None:
    """Audit rows of a run (counts, columns) as JSON lines.  Audit frames hold
    one row per dataset, so a single output file is fine."""
    records.coalesce(1).write.mode("overwrite").json(path)


def sql_over(spark: SparkSession, frames: dict[str, DataFrame], sql: str) -> DataFrame:
    """Run SQL text over DataFrames registered as temporary views."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)
