"""Numeric and date coercion: failures become null, never errors (ANSI safe)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Accepted date layouts, tried in this order (first match wins).
# Spark's single-letter month/day fields also accept zero-padded input.
DATE_LAYOUTS = (
    ("yyyy-M-d", False),   # %Y-%m-%d
    ("yyyy-M", True),      # %Y-%m  -> first day of month
    ("yyyy/M/d", False),   # %Y/%m/%d
    ("yyyy/M", True),      # %Y/%m  -> first day of month
)
OFFSET_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ssXXX"
# Timestamp layouts accepted by the plain-cast fallback.
PLAIN_TIMESTAMPS = ("yyyy-M-d H:m:s", "yyyy-M-d'T'H:m:s", "yyyy-M-d")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN and +-inf become null (Spark keeps NaN distinct from null)."""
    c = _c(c)
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None).cast("double")).otherwise(c)


def to_double(c, from_text: bool = True) -> Column:
    """Lenient numeric coercion: trim, '-' -> null, unparseable -> null, NaN -> null."""
    c = _c(c)
    if from_text:
        t = F.trim(c.cast("string"))
        # Java's parser also takes a type suffix ('1.5d', '2f') and hex floats
        # ('0x1p3'); pandas and SQL engines do not.  Cheap character tests
        # instead of a regex per value ('inf' keeps its final 'f').
        last = F.substring(t, -1, 1)
        suffixed = last.isin("d", "D", "f", "F") & ~F.lower(t).isin("inf", "+inf", "-inf")
        c = F.when(~suffixed & ~t.contains("p") & ~t.contains("P"), t)
    v = c.try_cast("double")
    return F.nanvl(v, F.lit(None).cast("double"))


def coerce_double(df: DataFrame, name: str) -> Column:
    """``to_double`` that skips the text round trip for numeric columns."""
    dt = df.schema[name].dataType
    if isinstance(dt, T.NumericType):
        return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))
    return to_double(F.col(name))


def to_date_lenient(c, fmt: str | None = None) -> Column:
    c = _c(c)
    return F.try_to_date(c.cast("string"), fmt) if fmt else F.try_to_date(c.cast("string"))


def standardize_date(c) -> Column:
    """First layout of DATE_LAYOUTS that parses the whole text, as a date; else null."""
    s = F.trim(_c(c).cast("string"))
    return F.coalesce(*[F.try_to_date(s, fmt) for fmt, _ in DATE_LAYOUTS])


def standardize_date_text(c) -> Column:
    return F.date_format(standardize_date(c), "yyyy-MM-dd")


def year_to_date_text(c) -> Column:
    """'2020' (after trim) -> '2020-01-01'; any other text is returned unchanged."""
    s = _c(c).cast("string")
    t = F.trim(s)
    return F.when(t.rlike("^[0-9]{4}$"), F.concat(t, F.lit("-01-01"))).otherwise(s)


def timestamp_to_date_text(c) -> Column:
    """ISO timestamp with offset -> 'yyyy-MM-dd'; then a plain timestamp cast; else the text."""
    s = _c(c).cast("string")
    with_offset = F.try_to_timestamp(s, F.lit(OFFSET_TIMESTAMP))
    plain = F.coalesce(*[F.try_to_timestamp(F.trim(s), F.lit(f)) for f in PLAIN_TIMESTAMPS])
    return F.coalesce(F.date_format(utc_wall_clock(with_offset), "yyyy-MM-dd"),
                      F.date_format(plain, "yyyy-MM-dd"), s)


def utc_wall_clock(ts) -> Column:
    """An instant as its UTC wall-clock time (timestamp_ntz), whatever the
    session time zone."""
    ts = _c(ts)
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))


def year_of(c) -> Column:
    return F.year(_c(c))


def normalize_nulls(df: DataFrame, tokens: Iterable[str] = ("",),
                    columns: Iterable[str] | None = None) -> DataFrame:
    """Turn explicit null tokens in text columns into null (explicit list, no guessing)."""
    tokens = list(tokens)
    cols = list(columns) if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({
        c: F.when(F.col(c).isin(tokens), F.lit(None).cast("string")).otherwise(F.col(c))
        for c in cols})
