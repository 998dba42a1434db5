"""Column-name handling at the ingestion boundary."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name; two names that collide is an error, not a silent merge."""
    lowered = [c.lower() for c in df.columns]
    if len(set(lowered)) != len(lowered):
        dup = sorted({c for c in lowered if lowered.count(c) > 1})
        raise ValueError(f"column names collide after lower-casing: {dup}")
    return df.toDF(*lowered)


def resolve(columns: Iterable[str], wanted: Iterable[str]) -> dict[str, str]:
    """Case-insensitive lookup: {wanted name: actual name} for the names present."""
    by_lower = {}
    for c in columns:
        by_lower.setdefault(c.lower(), c)
    return {w: by_lower[w.lower()] for w in wanted if w.lower() in by_lower}


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df
