"""Grouped quantiles with linear interpolation (pandas ``quantile`` /
DuckDB ``quantile_cont`` / Spark ``percentile`` semantics).

Strategies, same numbers for the exact ones, plus ``"auto"``:

* ``"refined"`` - exact and skew-safe without a sort.  A histogram of up to 65,536
  bins over a group's range says which bin holds a wanted rank, the next one
  refines that bin between its least and greatest value, until it holds a single
  value (two or three rounds as a rule).  The first round's bins have equal widths,
  later ones equal ratios where an interval spans more than a factor of two, so that
  values of all magnitudes settle in few rounds too.
  Each round reads the values once and shuffles counts alone, which tasks combine
  first, so neither a hot group nor a hot value makes an uneven task.
* ``"sorted"`` - exact and skew-safe.  Values are range-partitioned
  and sorted by (group, value), so a hot group is spread over many tasks.
  Per (partition, group) block counts give each block's starting rank; only the
  (at most two per quantile) rows at the interpolation ranks are fetched.  No
  task ever holds a whole group.
* ``"hash"`` - Spark's exact ``percentile`` aggregate.  One pass with partial
  aggregation, but the final state of a group is a map of its distinct values,
  so it suits groups of bounded cardinality only.
* ``"approx"`` - ``percentile_approx`` (bounded-memory sketch), relative rank
  error about 1/accuracy.
* ``"split"`` - ``refined`` for the groups of more than ``HASH_DISTINCT_LIMIT``
  rows, ``hash`` for the others.
* ``"auto"`` (default) - one cheap pass estimates the distinct values of the
  largest group (HyperLogLog, bounded memory).  Under ``HASH_DISTINCT_LIMIT``
  the exact hash aggregate is safe and used; above it ``sorted``.
  A group that holds a third of all rows but few distinct values stays on the
  fast path; one with many distinct values is sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelforge.session import ensure_checkpoint_dir

# Above this many interpolation-rank rows the pick step uses a shuffle join
# instead of a broadcast one.
BROADCAST_TARGET_ROWS = 200_000
# Largest per-group distinct-value count for which the exact hash aggregate's
# final value->count map (one task per group) is considered safe.
HASH_DISTINCT_LIMIT = 1_000_000
# Bins of a refining histogram, and rounds after which something must be wrong.
BINS = 1 << 16
MOST_ROUNDS = 300
_LARGEST = 1.7976931348623157e308


def group_profile(base: DataFrame, groups: Sequence[str], value: str = "_v") -> tuple[int, int]:
    """(estimated distinct values of the largest group, number of groups) in
    one bounded-memory aggregation."""
    row = base.groupBy(*groups).agg(F.approx_count_distinct(value, 0.05).alias("_d")).agg(
        F.max("_d").alias("_m"), F.count(F.lit(1)).alias("_g")).first()
    return int(row["_m"] or 0), int(row["_g"] or 0)


def choose_method(base: DataFrame, groups: Sequence[str], value: str = "_v") -> tuple[str, int]:
    """('hash' or 'sorted', number of groups)."""
    mx, n_groups = group_profile(base, groups, value)
    return ("hash" if mx <= HASH_DISTINCT_LIMIT else "sorted"), n_groups


def _qname(i: int) -> str:
    return f"_q{i}"


def grouped_quantiles(df: DataFrame, value: Column | str, groups: Sequence[str],
                      probs: Sequence[float], method: str = "auto",
                      accuracy: int = 10000, out_names: Sequence[str] | None = None,
                      num_partitions: int | None = None) -> DataFrame:
    """One row per group that has at least one non-null value:
    ``groups..., <out_names[i]> = quantile(value, probs[i])``.  Null group keys
    form their own group (as ``groupBy`` does)."""
    groups = list(groups)
    probs = [float(p) for p in probs]
    names = list(out_names) if out_names else [_qname(i) for i in range(len(probs))]
    v = F.col(value) if isinstance(value, str) else value
    base = df.select(*[F.col(g) for g in groups], v.cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v"))

    if method == "auto":
        method, _ = choose_method(base, groups)
    if method in ("refined", "split"):
        return _refined_quantiles(base, groups, probs, names, HASH_DISTINCT_LIMIT if method == "split" else 0)
    if method == "hash":
        agg = base.groupBy(*groups).agg(F.percentile("_v", F.array(*[F.lit(p) for p in probs])).alias("_qs"))
        return agg.select(*groups, *[F.col("_qs")[i].alias(n) for i, n in enumerate(names)])
    if method == "approx":
        agg = base.groupBy(*groups).agg(
            F.percentile_approx("_v", F.array(*[F.lit(p) for p in probs]), accuracy).alias("_qs"))
        return agg.select(*groups, *[F.col("_qs")[i].cast("double").alias(n) for i, n in enumerate(names)])
    if method != "sorted":
        raise ValueError(f"unknown quantile method {method!r}")
    return _sorted_quantiles(base, groups, probs, names, num_partitions)


def _sorted_blocks(base: DataFrame, groups: list[str], num_partitions: int | None):
    """Range-partition and sort ``base`` by (groups, _v); return the frozen
    sorted rows (with partition id and position) and the per (partition, group)
    blocks with their starting rank and the group size."""
    spark = base.sparkSession
    ensure_checkpoint_dir(spark)
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = groups + ["_v"]
    # The tie-break lets the range cut through a value that many rows share.
    srt = (base.withColumn("_tie", F.rand(17)).repartitionByRange(n_parts, *keys, "_tie")
           .sortWithinPartitions(*keys).drop("_tie")
           .withColumn("_pid", F.spark_partition_id())
           .withColumn("_idx", F.monotonically_increasing_id()))
    # Positions must not change between the uses below: freeze them in the
    # shared checkpoint folder (also cuts the lineage for executor loss).
    srt = srt.checkpoint(eager=True)

    gk = [F.col(g) for g in groups]
    blocks = srt.groupBy("_pid", *groups).agg(F.count(F.lit(1)).alias("_c"),
                                               F.min("_idx").alias("_i0"))
    wg = Window.partitionBy(*gk).orderBy("_pid")
    blocks = blocks.withColumns({
        "_start": F.coalesce(F.sum("_c").over(wg.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_n": F.sum("_c").over(Window.partitionBy(*gk)),
    })
    return srt, blocks


def with_group_rank(df: DataFrame, value: str, groups: Sequence[str] = (),
                    num_partitions: int | None = None, rank: str = "rank", size: str = "n") -> DataFrame:
    """Rows with a non-null ``value`` plus their 0-based rank within the group
    (ascending ``value``) and the group size, without gathering any group in
    one task: a block table (one row per partition and group) carries each
    block's starting rank."""
    groups = list(groups)
    base = df.withColumn("_v", F.col(value).cast("double")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    srt, blocks = _sorted_blocks(base, groups, num_partitions)
    b = blocks.select(*[F.col(g).alias(f"_bg{i}") for i, g in enumerate(groups)],
                      F.col("_pid").alias("_bpid"), "_i0", "_start", "_n")
    cond = F.col("_pid") == F.col("_bpid")
    for i, g in enumerate(groups):
        cond = cond & F.col(g).eqNullSafe(F.col(f"_bg{i}"))
    n_blocks = blocks.count()
    side = F.broadcast(b) if n_blocks <= BROADCAST_TARGET_ROWS else b
    out = srt.join(side, on=cond).withColumn(rank, F.col("_start") + F.col("_idx") - F.col("_i0"))
    out = out.withColumn(size, F.col("_n"))
    return out.drop("_v", "_pid", "_idx", "_bpid", "_i0", "_start", "_n",
                    *[f"_bg{i}" for i in range(len(groups))])


def _sorted_quantiles(base: DataFrame, groups: list[str], probs: list[float],
                      names: list[str], num_partitions: int | None) -> DataFrame:
    srt, blocks = _sorted_blocks(base, groups, num_partitions)
    # Interpolation ranks per group: lo = floor((n-1)p), hi = ceil((n-1)p).
    rank_rows = F.explode(F.array(*[
        F.struct(F.lit(i).alias("_qi"), F.lit(side).alias("_side"),
                 (F.floor if side == 0 else F.ceil)((F.col("_n") - 1) * F.lit(p)).cast("long").alias("_r"),
                 ((F.col("_n") - 1) * F.lit(p) - F.floor((F.col("_n") - 1) * F.lit(p))).alias("_frac"))
        for i, p in enumerate(probs) for side in (0, 1)])).alias("_t")
    per_group = blocks.where(F.col("_start") == 0).select(*groups, "_n")
    targets = per_group.select(*groups, rank_rows).select(*groups, "_t.*")
    bsel = blocks.select(*[F.col(g).alias(f"_bg{i}") for i, g in enumerate(groups)],
                         F.col("_pid").alias("_bpid"), F.col("_c").alias("_bc"),
                         F.col("_i0").alias("_bi0"), F.col("_start").alias("_bstart"))
    # both sides are small: per group at most 2 * len(probs) targets and one
    # block per partition the group spans
    cond = F.lit(True)
    for i, g in enumerate(groups):
        cond = cond & F.col(g).eqNullSafe(F.col(f"_bg{i}"))
    located = (targets.join(bsel, on=cond)
               .where((F.col("_r") >= F.col("_bstart")) & (F.col("_r") < F.col("_bstart") + F.col("_bc")))
               .select(*groups, "_qi", "_side", "_frac", F.col("_bpid").alias("_pid"),
                       (F.col("_bi0") + F.col("_r") - F.col("_bstart")).alias("_idx")))

    # The pick side holds 2 rows per (group, quantile).  Broadcast it only when
    # that count is proven small; otherwise use a shuffle join.
    n_groups = per_group.count()
    n_targets = n_groups * 2 * len(probs)
    pick = F.broadcast(located) if n_targets <= BROADCAST_TARGET_ROWS else located
    picked = srt.select("_pid", "_idx", "_v").join(pick, on=["_pid", "_idx"])
    per_q = picked.groupBy(*groups, "_qi").agg(
        F.max(F.when(F.col("_side") == 0, F.col("_v"))).alias("_lo"),
        F.max(F.when(F.col("_side") == 1, F.col("_v"))).alias("_hi"),
        F.max("_frac").alias("_frac"))
    # The arithmetic of ``percentile``, so that both exact methods agree to the last bit.
    per_q = per_q.withColumn("_q", F.when((F.col("_frac") == 0) | (F.col("_lo") == F.col("_hi")), F.col("_lo")).otherwise(
        (1 - F.col("_frac")) * F.col("_lo") + F.col("_frac") * F.col("_hi")))
    return per_q.groupBy(*groups).agg(*[
        F.max(F.when(F.col("_qi") == i, F.col("_q"))).alias(n) for i, n in enumerate(names)])


def _match(groups: Sequence[str], left: DataFrame, right: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Inner join by null-safe ``groups`` and ``more``, columns of ``right`` beside those of ``left``."""
    names = [*groups, *more]
    r = right.select(*[F.col(c).alias(f"_r{i}") for i, c in enumerate(names)], *[c for c in right.columns if c not in names])
    cond = F.lit(True)
    for i, c in enumerate(names):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_r{i}"))
    return left.join(r, cond).drop(*[f"_r{i}" for i in range(len(names))])


def _octave(v: Column) -> Column:
    """Rises with ``v``: 1 to 2099 by the binary logarithm of a positive number, 0 for 0, the opposite for negative ones."""
    return F.when(v == 0, F.lit(0.0)).otherwise(F.signum(v) * (F.log2(F.abs(v)) + 1075))


def _bin(v: Column, lo: Column, hi: Column, by_octave: bool) -> Column:
    """Bin of ``v`` in [lo, hi]: rises with v, differs for lo and hi; infinities have bins of their own.  The others are of
    equal width, or of equal ratio with ``by_octave`` where the interval spans more than a factor of two."""
    low, high = F.greatest(lo, F.lit(-_LARGEST)), F.least(hi, F.lit(_LARGEST))
    width = high / 2 - low / 2  # halved, as the difference may exceed the range
    share = (v / 2 - low / 2) / width
    if by_octave:
        span = _octave(high) - _octave(low)
        share = F.when(span > 1, (_octave(v) - _octave(low)) / span).otherwise(share)
    place = F.floor(share * F.lit(float(BINS - 1)))
    return (F.when(v > _LARGEST, F.lit(BINS)).when(v < -_LARGEST, F.lit(-1))
            .when(v >= high, F.lit(BINS - 1)).when(width > 0, F.least(place, F.lit(BINS - 2))).otherwise(F.lit(0)).cast("int"))


def _refined_quantiles(base: DataFrame, groups: list[str], probs: list[float], names: list[str], least_rows: int = 0) -> DataFrame:
    """Quantiles of the groups of more than ``least_rows`` rows by refining histograms, of the others by the hash aggregate.

    A target is a rank within an interval of values; all targets of a group that lie in the same interval share its
    histogram.  ``base`` is read once a round: freeze a costly one before.
    """
    ensure_checkpoint_dir(base.sparkSession)
    own = groups or ["_one"]
    rows = base if groups else base.withColumn("_one", F.lit(1))
    sizes = rows.groupBy(*own).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")).checkpoint(eager=True)
    large = sizes.where(F.col("_n") > least_rows)
    at = lambda p: (F.col("_n") - 1) * F.lit(p)
    wanted = F.explode(F.array(*[F.struct(F.lit(2 * i + side).alias("_j"), (F.floor if side == 0 else F.ceil)(at(p)).cast("long").alias("_off"))
                                 for i, p in enumerate(probs) for side in (0, 1)])).alias("_t")
    targets = large.select(*own, "_lo", "_hi", wanted).select(*own, "_lo", "_hi", "_t._j", "_t._off")
    open_ = F.col("_lo") < F.col("_hi")
    done, todo = targets.where(~open_).drop("_off"), targets.where(open_)
    for step in range(MOST_ROUNDS):
        n_open = todo.count()
        if not n_open:
            break
        same = Window.partitionBy(*own, "_lo", "_hi")  # the few targets of a group
        todo = todo.withColumn("_k", F.min("_j").over(same))
        intervals = todo.groupBy(*own).agg(F.collect_set(F.struct("_k", "_lo", "_hi")).alias("_x"))
        side = F.broadcast(intervals) if n_open <= BROADCAST_TARGET_ROWS else intervals
        v = F.col("_v")
        inside = _match(own, rows, side).select(*own, "_v", F.explode(F.filter("_x", lambda x: (v >= x["_lo"]) & (v <= x["_hi"]))).alias("_i"))
        counts = inside.groupBy(*own, F.col("_i._k").alias("_k"), _bin(v, F.col("_i._lo"), F.col("_i._hi"), step > 0).alias("_bin")).agg(
            F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        up = Window.partitionBy(*own, "_k").orderBy("_bin")  # at most BINS + 2 bins
        counts = counts.withColumn("_cum", F.sum("_c").over(up.rowsBetween(Window.unboundedPreceding, 0)))
        hit = _match(own, todo.select(*own, "_j", "_k", "_off"), counts, ["_k"]).where(
            (F.col("_off") < F.col("_cum")) & (F.col("_off") >= F.col("_cum") - F.col("_c")))
        hit = hit.select(*own, "_lo", "_hi", "_j", (F.col("_off") - (F.col("_cum") - F.col("_c"))).alias("_off")).checkpoint(eager=True)
        done, todo = done.unionByName(hit.where(~open_).drop("_off")), hit.where(open_)
    else:
        raise RuntimeError(f"quantiles did not settle in {MOST_ROUNDS} rounds")
    found = done.groupBy(*own).agg(*[F.max(F.when(F.col("_j") == j, F.col("_lo"))).alias(f"_q{j}") for j in range(2 * len(probs))])
    found = _match(own, found, large.select(*own, "_n"))

    def value(i, p):
        lo, hi, frac = F.col(f"_q{2 * i}"), F.col(f"_q{2 * i + 1}"), at(p) - F.floor(at(p))
        return F.when((frac == 0) | (lo == hi), lo).otherwise((1 - frac) * lo + frac * hi)

    out = found.select(*groups, *[value(i, p).alias(n) for i, (p, n) in enumerate(zip(probs, names))])
    if least_rows:
        few = sizes.where(F.col("_n") <= least_rows).select(*own)
        rest = _match(own, rows, few).groupBy(*groups).agg(F.percentile("_v", F.array(*[F.lit(p) for p in probs])).alias("_qs"))
        out = out.unionByName(rest.select(*groups, *[F.col("_qs")[i].alias(n) for i, n in enumerate(names)]))
    return out
