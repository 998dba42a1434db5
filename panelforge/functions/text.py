"""Text helpers: cleaning, classification, hashing, list joining."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """null -> '', trimmed, '|' escaped as '\\|' (safe inside a Markdown table cell)."""
    s = F.trim(_c(c).cast("string"))
    return F.coalesce(F.replace(s, F.lit("|"), F.lit("\\|")), F.lit(""))


# Dataset-name substrings and the source label each one maps to.
SOURCE_BY_NAME = (("world_bank", "World Bank WDI"), ("fred", "FRED"))
DEFAULT_SOURCE = "JODI"


def source_label(name) -> Column:
    n = F.lower(_c(name))
    expr = None
    for needle, label in SOURCE_BY_NAME:
        cond = n.contains(needle)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(DEFAULT_SOURCE))


def file_year(path) -> Column:
    """Four-digit year from a file name ending in '<yyyy>.csv' (empty text if absent)."""
    return F.regexp_extract(_c(path), r"(\d{4})\.csv$", 1)


def sha256(c) -> Column:
    return F.sha2(_c(c), 256)


def with_default(c, default) -> Column:
    return F.coalesce(_c(c), F.lit(default))


def join_list(c, sep: str = "; ") -> Column:
    return F.array_join(_c(c), sep)
