"""Regular time series per series key: shifts, calendar densification, linear
interpolation, additive seasonal decomposition, lag-correlation profiles.

Windows run over one series (:mod:`panelforge.operators.series`): partitioned by
the series key as long as a series fits a task, over blocks of it beyond."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelforge.operators.series import around_known, as_keys, over_series
from panelforge.operators.stats import safe_corr

LAGS = (0, 1, 2, 3, 6, 12)


def shift(df: DataFrame, col: str, k: int, order: str, key=None, out: str | None = None, cut: str = "auto") -> DataFrame:
    """``col`` of ``k`` rows before (after, if negative) in each series."""
    return over_series(df, key, order, lambda w, _: {out or f"{col}_shift{k}": F.lag(col, k).over(w)}, max(k, 0), max(-k, 0), cut)


def densify_monthly(df: DataFrame, key, date_col: str, value_cols: Sequence[str],
                    span: str = "per_key", fill=None) -> DataFrame:
    """One row per series and month between the first and last month (of the
    series with ``span='per_key'``, of all data with ``span='global'``, which
    gives a balanced panel); months without data get null values, or ``fill``.
    Input: at most one row per series and month."""
    keys = as_keys(key)
    month = F.trunc(F.col(date_col), "month")
    src = df.select(*keys, month.alias(date_col), *value_cols)
    step = F.expr("INTERVAL 1 MONTH")
    if span == "global":
        # two scalars (first and last month) read once; every key gets the same calendar
        lo, hi = src.agg(F.min(date_col), F.max(date_col)).first()
        grid = src.select(*keys).distinct().select(
            *keys, F.explode(F.sequence(F.lit(lo), F.lit(hi), step)).alias(date_col))
    else:
        sp = src.groupBy(*keys).agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
        grid = sp.select(*keys, F.explode(F.sequence("_lo", "_hi", step)).alias(date_col))
    out = grid.join(src, on=keys + [date_col], how="left")
    if fill is not None:
        out = out.fillna(fill, subset=list(value_cols))
    return out


def interpolate_linear(df: DataFrame, key, order: str, col: str, out: str | None = None, cut: str = "auto") -> DataFrame:
    """Linear interpolation over row positions.  Leading nulls stay null;
    trailing nulls carry the last value (pandas ``interpolate()``)."""
    d = around_known(df, key, order, col, cut)
    val = (F.when(F.col(col).isNotNull(), F.col(col))
           .when(F.col("_y0").isNull(), F.lit(None))
           .when(F.col("_y1").isNull(), F.col("_y0"))
           .otherwise(F.col("_y0") + (F.col("_i") - F.col("_i0")) * (F.col("_y1") - F.col("_y0"))
                      / (F.col("_i1") - F.col("_i0"))))
    return d.withColumn(out or col, val).drop("_i", "_y0", "_i0", "_y1", "_i1")


def seasonal_decompose(df: DataFrame, key, order: str, col: str, period: int = 12, cut: str = "auto") -> DataFrame:
    """Additive decomposition: centred moving-average trend (2 x period for an
    even period, null where the window is not full), seasonal = mean of the
    detrended values per phase minus the mean of those phase means, resid."""
    keys = as_keys(key)
    h = period // 2

    def trend(w, position):
        full = F.count(col).over(w.rowsBetween(-h, h)) == (2 * h + 1)
        if period % 2 == 0:
            ma = (F.avg(col).over(w.rowsBetween(-h, h - 1)) + F.avg(col).over(w.rowsBetween(-h + 1, h))) / 2
        else:
            ma = F.avg(col).over(w.rowsBetween(-h, h))
        return {"trend": F.when(full, ma), "_phase": F.pmod(position, F.lit(period))}

    d = over_series(df, key, order, trend, h, h, cut)
    # ``period`` rows per series: partial sums by phase, then centred on their mean
    phases = d.groupBy(*keys, "_phase").agg(F.avg(F.col(col) - F.col("trend")).alias("_pm"))
    phases = phases.withColumn("seasonal", F.col("_pm") - F.avg("_pm").over(Window.partitionBy(*keys))).drop("_pm")
    d = d.join(phases if keys else F.broadcast(phases), on=[*keys, "_phase"], how="left").drop("_phase")
    return d.select(*[c for c in d.columns if c != "seasonal"], "seasonal").withColumn("resid", F.col(col) - F.col("trend") - F.col("seasonal"))


def lag_corr_profile(df: DataFrame, y: str, x: str, order: str, lags: Sequence[int] = LAGS,
                     key=None, cut: str = "auto") -> DataFrame:
    """corr(y_t, x_{t-k}) for each lag k over one ordered pass (positional lags),
    pairwise-complete; returns (key..., lag, corr) long."""
    keys = as_keys(key)
    narrow = df.select(*dict.fromkeys([*keys, order, y, x]))
    d = over_series(narrow, key, order, lambda w, _: {f"_x{k}": F.lag(x, k).over(w) for k in lags}, max(0, *lags), max(0, *(-k for k in lags)), cut)
    agg = d.groupBy(*keys).agg(*[safe_corr(y, f"_x{k}").alias(f"_c{k}") for k in lags])
    stack = F.explode(F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"_c{k}").alias("corr"))
                                for k in lags])).alias("_s")
    return agg.select(*keys, stack).select(*keys, "_s.lag", "_s.corr")


def best_lag(profile: DataFrame, key=None) -> DataFrame:
    """Lag with the largest |corr| (ties -> smaller lag), ignoring undefined corr."""
    keys = as_keys(key)
    p = profile.where(F.col("corr").isNotNull())
    rank = F.struct(F.abs("corr"), -F.col("lag"))
    return p.groupBy(*keys).agg(F.max_by("lag", rank).alias("best_lag"),
                                F.max_by("corr", rank).alias("best_corr"))
