"""Result formatting as native expressions (no row-wise Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Significance thresholds and their markers.
STAR_LEVELS = ((0.01, "***"), (0.05, "**"), (0.10, "*"))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stars(p) -> Column:
    p = _c(p)
    expr = None
    for level, mark in STAR_LEVELS:
        cond = p < F.lit(level)
        expr = F.when(cond, F.lit(mark)) if expr is None else expr.when(cond, F.lit(mark))
    return F.coalesce(expr.otherwise(F.lit("")), F.lit(""))


def fmt_fixed(c, decimals: int = 4) -> Column:
    c = _c(c)
    return F.when(c.isNull() | F.isnan(c), F.lit("")).otherwise(
        F.format_string(f"%.{decimals}f", c))


def fmt_coef(coef, p, decimals: int = 4) -> Column:
    """'%.4f' plus stars; '' when the coefficient or p-value is missing."""
    coef, p = _c(coef), _c(p)
    missing = coef.isNull() | p.isNull() | F.isnan(coef) | F.isnan(p)
    return F.when(missing, F.lit("")).otherwise(
        F.concat(F.format_string(f"%.{decimals}f", coef), stars(p)))


def fmt_se(se, decimals: int = 4) -> Column:
    se = _c(se)
    return F.when(se.isNull() | F.isnan(se), F.lit("")).otherwise(
        F.concat(F.lit("("), F.format_string(f"%.{decimals}f", se), F.lit(")")))
