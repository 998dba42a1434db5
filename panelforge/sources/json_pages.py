"""Flatten landed JSON API pages ``[meta, [record, ...]]`` into rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions.coerce import utc_wall_clock

RECORD_SCHEMA = ("array<struct<countryiso3code: string, country: struct<value: string>, date: string, "
                 "value: string, obs_status: string, decimal: string>>")


def flatten_pages(pages: DataFrame, text_col: str, indicator_id: str, indicator_label: str,
                  fetched_at=None) -> DataFrame:
    """One row per record; nested ``country.value`` lifted; missing values
    become '' (as the landed CSV has them); constant indicator columns and an
    ingest timestamp (ISO text with offset) added.  Pages are independent, so
    this is a narrow (shuffle-free) transformation."""
    recs = F.from_json(F.get_json_object(F.col(text_col), "$[1]"), RECORD_SCHEMA)
    ts = fetched_at if fetched_at is not None else F.current_timestamp()
    exploded = pages.select(F.explode_outer(recs).alias("r")).where(F.col("r").isNotNull())
    return exploded.select(
        F.lit(indicator_id).alias("indicator_id"),
        F.lit(indicator_label).alias("indicator_label"),
        F.coalesce(F.col("r.countryiso3code"), F.lit("")).alias("country_iso3"),
        F.coalesce(F.col("r.country.value"), F.lit("")).alias("country_name"),
        F.coalesce(F.col("r.date"), F.lit("")).alias("year"),
        F.coalesce(F.col("r.value"), F.lit("")).alias("value"),
        F.coalesce(F.col("r.obs_status"), F.lit("")).alias("obs_status"),
        F.coalesce(F.col("r.decimal"), F.lit("")).alias("decimal"),
        F.date_format(utc_wall_clock(ts), "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("fetched_at_utc"))


def page_count(pages: DataFrame, text_col: str) -> DataFrame:
    """Declared page totals from the meta element (for paging checks)."""
    return pages.select(F.get_json_object(F.col(text_col), "$[0].pages").cast("int").alias("pages"))
