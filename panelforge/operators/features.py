"""Per-entity features on a panel keyed by (entity, time): growth rates, lags,
median split, treatment flags, inf cleanup.

A panel has one row per (entity, time), so an entity window holds at most T
rows whatever the data size; windows here are partitioned by the entity unless
``cut`` asks for blocks of long series (:mod:`panelforge.operators.series`)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.operators.quantiles import grouped_quantiles
from panelforge.operators.series import over_series


def pct_change(df: DataFrame, entity, time: str, col: str, out: str, scale: float = 100.0,
               calendar: bool = False, step: int = 1, cut: str = "whole") -> DataFrame:
    """(x / previous x - 1) * scale per entity.  The previous row is positional
    (the row before in time order), not previous period, unless
    ``calendar=True``: then a gap of more than ``step`` gives null.  Null in
    either row gives null (no padding); division by zero gives null."""
    def growth(w, _):
        g = (F.try_divide(F.col(col), F.lag(col, 1).over(w)) - F.lit(1.0)) * F.lit(scale)
        return {out: F.when(F.col(time) - F.lag(time, 1).over(w) == step, g) if calendar else g}

    return over_series(df, entity, time, growth, before=1, cut=cut)


def lags(df: DataFrame, entity, time: str, col: str, ks: Sequence[int],
         name: str = "{col}_lag{k}", cut: str = "whole") -> DataFrame:
    return over_series(df, entity, time, lambda w, _: {name.format(col=col, k=k): F.lag(col, k).over(w) for k in ks}, before=max(ks), cut=cut)


def inf_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols) if cols is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(F.col(c))
                           for c in cols})


def median_split(df: DataFrame, entity: str, value: str, out: str, method: str = "auto") -> DataFrame:
    """``out`` = 1.0 if the entity's median of ``value`` is >= the median of
    all entity medians, else 0.0 (also 0.0 for an entity without a median).

    With ``method='auto'`` one profiling pass sizes both levels: the per-entity
    level by the largest entity's distinct values, the median of medians by
    the number of entities (its only group holds one value per entity)."""
    from panelforge.operators.quantiles import HASH_DISTINCT_LIMIT, choose_method
    m2 = method
    if method == "auto":
        v = F.col(value).cast("double")
        probe = df.select(entity, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
        method, n_entities = choose_method(probe, [entity])
        m2 = "hash" if n_entities <= HASH_DISTINCT_LIMIT else "refined"
    per = grouped_quantiles(df, value, [entity], [0.5], method=method, out_names=["_m"])
    overall = grouped_quantiles(per, "_m", [], [0.5], method=m2, out_names=["_mm"]).first()
    mm = F.lit(overall["_mm"] if overall is not None else None).cast("double")   # one scalar
    flags = per.select(entity, F.coalesce((F.col("_m") >= mm).cast("double"), F.lit(0.0)).alias(out))
    return df.join(flags, on=entity, how="left").withColumn(out, F.coalesce(F.col(out), F.lit(0.0)))


def treatment_flags(df: DataFrame, time: str, t0, treat: str | None = None,
                    post: str = "post", interaction: str | None = None) -> DataFrame:
    """post = 1.0 if time >= t0 else 0.0 (null time -> 0.0); interaction = treat * post."""
    out = df.withColumn(post, F.coalesce((F.col(time) >= F.lit(t0)).cast("double"), F.lit(0.0)))
    if treat and interaction:
        out = out.withColumn(interaction, F.col(treat) * F.col(post))
    return out


def products(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    return df.withColumns({o: F.col(a) * F.col(b) for o, (a, b) in pairs.items()})


def sums(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    return df.withColumns({o: F.col(a) + F.col(b) for o, (a, b) in pairs.items()})


def col_or(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
