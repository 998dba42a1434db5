"""Sufficient statistics as matrix products of Arrow batches: pairwise-complete moments of many columns, and a Poisson
bootstrap of a regression line.  Tasks add up fixed-size arrays, so what is shuffled does not grow with the rows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A variance this small against its raw moment (and a deviation against the mean) is rounding.
REL_TOL = 1e-12
TASKS_PER_CORE = 4


def _finite(c: str) -> Column:
    """The column as double; null where it is null, NaN or infinite."""
    x = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def _packed(df: DataFrame) -> DataFrame:
    """Few tasks of many splits each: every task sends its arrays once.  No shuffle."""
    return df.coalesce(TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism)


def pairwise_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(i, j, n, s_i, s_j, q_i, q_j, p)`` for every pair ``i <= j`` of column places: over the rows where both columns are finite
    numbers, their count, the sums and squared sums of both and the sum of products, all of values less the
    column's mean (``reference_i``, ``reference_j``).

    With the mask M of finite values these are M'M, Z'M, (Z*Z)'M and Z'Z, four products a batch for all pairs, where aggregates by
    pair would need as many expressions as there are pairs.  An empty table gives pairs with n = 0 or no rows."""
    cols = list(cols)
    k = len(cols)
    x = df.select(*[_finite(c).alias(f"x{i}") for i, c in enumerate(cols)])
    means = x.agg(*[F.avg(c).alias(c) for c in x.columns]).first()
    centre = np.array([0.0 if m is None else m for m in means])  # one number a column
    upper = np.triu_indices(k)

    def run(batches):
        n, s, q, p = (np.zeros((k, k)) for _ in range(4))
        for b in batches:
            z = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], axis=1).astype(np.float64) - centre
            m = np.isfinite(z)
            z = np.where(m, z, 0.0)
            m = m.astype(np.float64)
            n += m.T @ m
            s += z.T @ m
            q += (z * z).T @ m
            p += z.T @ z
        i, j = upper
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (i, j, n[i, j], s[i, j], s[j, i], q[i, j], q[j, i], p[i, j])],
                                         names=["i", "j", "n", "s_i", "s_j", "q_i", "q_j", "p"])

    parts = _packed(x).mapInArrow(run, "i bigint, j bigint, n double, s_i double, s_j double, q_i double, q_j double, p double")
    total = parts.groupBy("i", "j").agg(F.sum("n").cast("bigint").alias("n"), *[F.sum(c).alias(c) for c in ("s_i", "s_j", "q_i", "q_j", "p")])
    reference = F.array(*[F.lit(float(c)) for c in centre])
    return total.withColumns({"reference_i": F.get(reference, F.col("i").cast("int")), "reference_j": F.get(reference, F.col("j").cast("int"))})


def pairwise_corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(var1, var2, n, corr)`` of all ordered pairs of columns over pairwise-complete rows, by :func:`pairwise_moments`.

    Null, NaN and infinite values are missing.  ``corr`` is null for fewer than two pairs or a side that is constant over
    the pairs."""
    m = pairwise_moments(df, cols)

    def spread(s, q, reference):
        v = F.col(q) / F.col("n") - F.pow(F.col(s) / F.col("n"), 2)
        return F.when((F.col("n") >= 2) & (v > REL_TOL * F.col(q) / F.col("n")) & (v > F.pow(F.lit(REL_TOL) * F.col(reference), 2)), v)

    cov = F.col("p") / F.col("n") - F.col("s_i") / F.col("n") * F.col("s_j") / F.col("n")
    m = m.select("i", "j", "n", F.when(F.col("n") >= 2, cov / F.sqrt(spread("s_i", "q_i", "reference_i") * spread("s_j", "q_j", "reference_j"))).alias("corr"))
    names = F.array(*[F.lit(c) for c in cols])
    both = m.unionByName(m.where("i <> j").select(F.col("j").alias("i"), F.col("i").alias("j"), "n", "corr"))
    return both.select(F.get(names, F.col("i").cast("int")).alias("var1"), F.get(names, F.col("j").cast("int")).alias("var2"), "n", "corr")


# ---------------------------------------------------------------- bootstrap

#: Replicates that one digest serves, two bytes each.
PER_DIGEST = 8


def poisson_steps() -> list[int]:
    """Least two-byte numbers for which a Poisson(1) weight is at least 1, 2, ..: the distribution function times 65536."""
    out, term, total = [], np.exp(-1.0), 0.0
    for k in range(1, 9):
        total += term
        out.append(int(np.floor(total * 65536)))
        term /= k
    return out


def bootstrap_sums(df: DataFrame, key: Column, x: str, y: str, replicates: int, seed: int = 1) -> DataFrame:
    """``(replicate, w, wx, wy, wxx, wxy)``: weighted sums of each replicate over the rows with finite x and y.

    A row's weight in a replicate is a Poisson(1) draw from the MD5 of ``seed:block:key``, so it depends on the row alone: any
    partitioning, retry or order gives the same replicates.  Rows that share a key share their weights; a null key counts as the
    empty text."""
    blocks = -(-replicates // PER_DIGEST)
    name = F.coalesce(key.cast("string"), F.lit(""))
    rows = df.select(_finite(x).alias("x"), _finite(y).alias("y"),
                     *[F.unhex(F.md5(F.concat(F.lit(f"{seed}:{b}:"), name).cast("binary"))).alias(f"d{b}") for b in range(blocks)])
    steps = np.array(poisson_steps())

    def run(batches):
        total = np.zeros((blocks * PER_DIGEST, 5))
        for b in batches:
            x, y = (b.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            digest = [np.frombuffer(b"".join(b.column(2 + i).to_pylist()), ">u2").reshape(-1, PER_DIGEST) for i in range(blocks)]
            weight = np.searchsorted(steps, np.concatenate(digest, axis=1), "right").astype(np.float64)
            total += weight.T @ np.stack([np.ones(len(x)), x, y, x * x, x * y], axis=1)
        t = total[:replicates]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(replicates)), *(pa.array(np.ascontiguousarray(c)) for c in t.T)],
                                         names=["replicate", "w", "wx", "wy", "wxx", "wxy"])

    kept = rows.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    parts = _packed(kept).mapInArrow(run, "replicate bigint, w double, wx double, wy double, wxx double, wxy double")
    return parts.groupBy("replicate").agg(*[F.sum(c).alias(c) for c in ("w", "wx", "wy", "wxx", "wxy")])


def line_band(df: DataFrame, key: Column, x: str, y: str, points: Sequence[float], replicates: int = 200, level: float = 0.95, seed: int = 1) -> DataFrame:
    """``(x, fit, low, high, replicates)``: the least-squares line of y on x at ``points`` and the band that holds the middle ``level`` of
    the bootstrap replicates' lines (quantiles interpolated linearly).

    x and y are taken less their means before they are summed.  Replicates without a line (no spread of x) are
    left out of the band and of ``replicates``; without any line, or any row, fit and band are null."""
    spark = df.sparkSession
    src = df.select(key.cast("string").alias("key"), _finite(x).alias("x"), _finite(y).alias("y")).where("x is not null and y is not null")
    whole = src.agg(F.count("*").alias("n"), F.avg("x").alias("mx"), F.avg("y").alias("my"), F.var_pop("x").alias("vx"), F.covar_pop("x", "y").alias("cxy")).first()
    mx, my = (0.0 if v is None else v for v in (whole["mx"], whole["my"]))
    slope = whole["cxy"] / whole["vx"] if whole["vx"] else None
    sums = bootstrap_sums(src.select("key", (F.col("x") - mx).alias("x"), (F.col("y") - my).alias("y")), F.col("key"), "x", "y", replicates, seed)
    spread = F.col("w") * F.col("wxx") - F.col("wx") * F.col("wx")
    lines = (sums.where(spread > REL_TOL * F.col("w") * F.col("wxx"))
             .select("w", "wx", "wy", ((F.col("w") * F.col("wxy") - F.col("wx") * F.col("wy")) / spread).alias("b")))
    at = F.explode(F.array(*[F.lit(float(p)) for p in points]))
    values = lines.select(at.alias("x"), "b", ((F.col("wy") - F.col("b") * F.col("wx")) / F.col("w")).alias("a")).select(
        "x", (F.lit(my) + F.col("a") + F.col("b") * (F.col("x") - mx)).alias("v"))
    tail = (1 - level) / 2
    band = values.groupBy("x").agg(F.percentile("v", F.lit(tail)).alias("low"), F.percentile("v", F.lit(1 - tail)).alias("high"), F.count("*").alias("replicates"))
    fits = spark.createDataFrame([(float(p), None if slope is None else my + slope * (p - mx)) for p in points], "x double, fit double")  # the given points
    return fits.join(band, "x", "left").select("x", "fit", "low", "high", F.coalesce("replicates", F.lit(0)).alias("replicates"))
