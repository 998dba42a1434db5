"""File-stream landing: CSV files in -> typed, required-field-filtered Parquet out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from panelforge.functions.coerce import to_double
from panelforge.operators.clean import require_fields


def land_stream(spark: SparkSession, landing_dir: str, text_schema: T.StructType, out_dir: str,
                checkpoint: str, required: Sequence[str] = (), numeric: Sequence[str] = (),
                group_tag: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Start a stream that lands every new CSV of ``landing_dir``: numeric
    columns coerced leniently, rows missing a required field dropped, file
    provenance added, appended to Parquet at ``out_dir``."""
    src = (spark.readStream.schema(text_schema).options(header=True, quote='"', escape='"')
           .option("maxFilesPerTrigger", 1000).csv(landing_dir))
    src = src.withColumns({c: to_double(c) for c in numeric})
    src = require_fields(src, list(required))
    src = src.withColumn("source_file", F.col("_metadata.file_name"))
    if group_tag is not None:
        src = src.withColumn("source_group", F.lit(group_tag))
    w = (src.writeStream.format("parquet").option("path", out_dir)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
