"""Table-level date handling: standardise date-like columns by name, and pick
one canonical ``date`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions.coerce import standardize_date_text, timestamp_to_date_text, year_to_date_text

# Which column names are dates and how each is standardised.
DATE_NAMES = ("date", "time_period")
YEAR_NAMES = ("year",)
TIMESTAMP_NAMES = ("fetched_at_utc",)
# Candidates for the canonical date column, in priority order.
CANONICAL_CANDIDATES = ("date", "time_period", "year")


STANDARDISERS = {n: f for names, f in ((DATE_NAMES, standardize_date_text), (YEAR_NAMES, year_to_date_text),
                                       (TIMESTAMP_NAMES, timestamp_to_date_text)) for n in names}


def standardize_date_columns(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Every column whose lower-cased name is a date/period, year or ingest
    timestamp is rewritten as 'yyyy-MM-dd' text (unparseable: null for dates,
    unchanged for years and timestamps); other columns untouched, order kept.
    Returns (frame, standardised column names)."""
    found = {c: STANDARDISERS[c.lower()] for c in df.columns if c.lower() in STANDARDISERS}
    return df.withColumns({c: f(F.col(f"`{c}`")) for c, f in found.items()}), list(found)


def harmonize_date_column(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """The first present of date / time_period / year (case-insensitive)
    becomes ``date`` and moves to the front; ``fetched_at_utc`` becomes
    ``fetched_date``; all other columns keep their order.  A second column
    already called ``date`` would collide and is an error.  Returns (frame,
    rename log)."""
    rank = {name: i for i, name in enumerate(CANONICAL_CANDIDATES)}
    canonical = min((c for c in df.columns if c.lower() in rank), key=lambda c: rank[c.lower()], default=None)
    target = {c: "date" if c == canonical else "fetched_date" if c.lower() in TIMESTAMP_NAMES else c for c in df.columns}
    order = sorted(target, key=lambda c: c != canonical)
    clash = [c for c in order if c.lower() == "date" and c != canonical]
    if clash:
        raise ValueError(f"column {clash[0]!r} would collide with the canonical date column")
    return (df.select(*[F.col(f"`{c}`").alias(target[c]) for c in order]),
            [f"{c}->{target[c]}" for c in order if c != target[c]])
