"""Exploratory statistics as aggregations: safe correlation, correlation
matrix, grouped correlation, frequency top-k, box-plot statistics, simple
regression line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.operators.quantiles import grouped_quantiles


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_corr(a, b) -> Column:
    """Pearson correlation over pairwise-complete rows; null (never an error)
    when fewer than two pairs or a side has zero variance."""
    a, b = _c(a), _c(b)
    both = a.isNotNull() & b.isNotNull() & ~F.isnan(a) & ~F.isnan(b)
    am, bm = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(am, bm), F.stddev_pop(am) * F.stddev_pop(bm))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise Pearson matrix in long form (var1, var2, corr), one aggregation."""
    cols = list(cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    row = df.agg(*[safe_corr(cols[i], cols[j]).alias(f"_c{i}_{j}") for i, j in pairs])
    cells = []
    for i, j in pairs:
        cells.append(F.struct(F.lit(cols[i]).alias("var1"), F.lit(cols[j]).alias("var2"), F.col(f"_c{i}_{j}").alias("corr")))
        if i != j:
            cells.append(F.struct(F.lit(cols[j]).alias("var1"), F.lit(cols[i]).alias("var2"), F.col(f"_c{i}_{j}").alias("corr")))
    return row.select(F.explode(F.array(*cells)).alias("_s")).select("_s.*")


def grouped_corr(df: DataFrame, group: str | Sequence[str], a: str, b: str, out: str = "corr",
                 drop_undefined: bool = True) -> DataFrame:
    groups = [group] if isinstance(group, str) else list(group)
    g = df.groupBy(*groups).agg(safe_corr(a, b).alias(out))
    return g.where(F.col(out).isNotNull()) if drop_undefined else g


def topk_counts(df: DataFrame, col: str, k: int, drop_null: bool = True) -> DataFrame:
    """The k most frequent values (ties broken by value); a top-k report, so
    the limit is the feature."""
    src = df.where(F.col(col).isNotNull()) if drop_null else df
    return src.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(col)).limit(k)


def boxplot_stats(df: DataFrame, group: str, value: str, whis: float = 1.5,
                  method: str = "auto") -> DataFrame:
    """Per group: n, q1, median, q3, whiskers (most extreme data inside
    q1 - whis*iqr / q3 + whis*iqr, never inside the box) and outlier count."""
    src = df.where(F.col(value).isNotNull() & ~F.isnan(value))
    q = grouped_quantiles(src, value, [group], [0.25, 0.5, 0.75], method=method,
                          out_names=["q1", "median", "q3"])
    q = q.withColumn("_lo", F.col("q1") - F.lit(whis) * (F.col("q3") - F.col("q1"))) \
         .withColumn("_hi", F.col("q3") + F.lit(whis) * (F.col("q3") - F.col("q1")))
    j = src.select(group, value).join(q, on=group)
    v = F.col(value)
    w = j.groupBy(group, "q1", "median", "q3").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(v >= F.col("_lo"), v)).alias("_wl"),
        F.max(F.when(v <= F.col("_hi"), v)).alias("_wh"),
        F.count_if((v < F.col("_lo")) | (v > F.col("_hi"))).alias("n_outliers"))
    return w.select(group, "n", "q1", "median", "q3",
                    F.least(F.col("_wl"), F.col("q1")).alias("whisker_low"),
                    F.greatest(F.col("_wh"), F.col("q3")).alias("whisker_high"), "n_outliers")


def regression_line(df: DataFrame, x: str, y: str, group: str | Sequence[str] | None = None) -> DataFrame:
    """slope, intercept, r2 and n of y on x (aggregates only; null on zero variance)."""
    groups = [] if group is None else ([group] if isinstance(group, str) else list(group))
    xs, ys = F.col(x), F.col(y)
    both = xs.isNotNull() & ys.isNotNull()
    xm, ym = F.when(both, xs), F.when(both, ys)
    sxy, sxx = F.covar_pop(ym, xm), F.var_pop(xm)
    slope = F.try_divide(sxy, sxx)
    return df.groupBy(*groups).agg(
        slope.alias("slope"),
        (F.avg(ym) - slope * F.avg(xm)).alias("intercept"),
        F.pow(safe_corr(xm, ym), 2).alias("r2"),
        F.count(ym).alias("n"))


def corr_from_moments(n="n", sa="sum_a", sb="sum_b", saa="sum_aa", sbb="sum_bb", sab="sum_ab",
                      ref_a="ref_a", ref_b="ref_b", rel_tol: float = 1e-12) -> Column:
    """Pearson correlation from pair moments (see ``reshape.pair_moments``);
    null for fewer than two pairs or a (numerically) constant side."""
    n, sa, sb, saa, sbb, sab, ref_a, ref_b = map(_c, (n, sa, sb, saa, sbb, sab, ref_a, ref_b))
    cov = n * sab - sa * sb
    va = n * saa - sa * sa
    vb = n * sbb - sb * sb

    def varies(v, ss, ref):
        # beyond the rounding of the moments and of the means they are taken from
        return (v > F.lit(rel_tol) * n * ss) & (v > F.pow(F.lit(rel_tol) * n * ref, 2))
    ok = (n >= 2) & varies(va, saa, ref_a) & varies(vb, sbb, ref_b)
    return F.when(ok, cov / F.sqrt(va * vb))
