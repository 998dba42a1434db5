"""Windows over ordered series of any length.

A series that fits a task is an ordinary window partitioned by its key.  A longer one (or one without a key, which would be
a single task) is cut into blocks: rows are range-partitioned by (key, order), so a series is as many tasks as its
share of the rows.  Blocks of one series need their neighbours' rows at the seams: the few rows that a frame
reaches over a seam are copied to the block beyond it (halo), and what must come from further away, the position in the series
and the last and next known value, is combined from one summary row per block (carry).  Only series that span
several partitions have seams, at most two per partition, so the tables of seams are small whatever the data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelforge.session import ensure_checkpoint_dir

#: Rows of one series that a task may hold.
WHOLE_ROWS = 1_000_000

BLOCK, HALO = "_block", "_halo"


def as_keys(key) -> list[str]:
    if key is None:
        return []
    return [key] if isinstance(key, str) else list(key)


def longest(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the longest series (one partial aggregation over the key columns alone)."""
    if not keys:
        return df.count()
    return int(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).agg(F.max("_c")).first()[0] or 0)


def _same(keys: Sequence[str], left: str, right: str) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`"))
    return cond


def _blocks(df: DataFrame, keys: list[str], order: str, parts: int | None, known: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows range-partitioned and sorted by (keys, order), frozen with their partition ``_block`` and place ``_at``
    (ascending over all rows), and the seams: one row per block of each series that spans several.

    A seam has its number ``_b`` among the blocks of its series, first place ``_i0`` and rows ``_c``, ``_start`` rows of the series before
    it and, for a column ``known``, the last known value and position before the block and the next ones behind it.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (df.repartitionByRange(parts, *keys, order).sortWithinPartitions(*keys, order)
            .withColumn(BLOCK, F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()).checkpoint(eager=True))
    aggs = [F.count(F.lit(1)).alias("_c"), F.min("_at").alias("_i0")]
    if known:
        there = F.when(F.col(known).isNotNull(), F.col("_at"))
        aggs += [F.min(there).alias("_kf"), F.max(there).alias("_kl"), F.min_by(known, there).alias("_vf"), F.max_by(known, there).alias("_vl")]
    per = rows.groupBy(BLOCK, *keys).agg(*aggs)
    if keys:
        many = per.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        per = per.alias("b").join(many.alias("m"), _same(keys, "b", "m"), "left_semi")
    w = Window.partitionBy(*keys).orderBy(BLOCK)  # over blocks, not rows
    before, behind = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    per = per.withColumns({"_b": F.row_number().over(w), "_start": F.coalesce(F.sum("_c").over(before), F.lit(0))})
    if known:
        per = per.withColumns({"_pf": F.col("_start") + F.col("_kf") - F.col("_i0"), "_pl": F.col("_start") + F.col("_kl") - F.col("_i0")})
        per = per.withColumns({"_in_v": F.last("_vl", ignorenulls=True).over(before), "_in_p": F.last("_pl", ignorenulls=True).over(before),
                               "_out_v": F.first("_vf", ignorenulls=True).over(behind), "_out_p": F.first("_pf", ignorenulls=True).over(behind)})
    return rows, per.checkpoint(eager=True)


def _with_seams(rows: DataFrame, seams: DataFrame, keys: list[str], cols: Sequence[str]) -> DataFrame:
    side = seams.select(BLOCK, *keys, *cols).alias("s")
    mine = rows.alias("r").join(F.broadcast(side), (F.col(f"r.{BLOCK}") == F.col(f"s.{BLOCK}")) & _same(keys, "r", "s"), "left")  # two rows a partition at most
    return mine.select("r.*", *[F.col(f"s.{c}") for c in cols])


def _halo_rows(rows: DataFrame, seams: DataFrame, keys: list[str], before: int, after: int) -> DataFrame:
    """Copies of the ``before`` rows ahead of each seam's first row and the ``after`` rows behind its last, from as
    many blocks as hold them, as rows of that block."""
    least = seams.agg(F.min("_c")).first()[0] or 1
    reach = lambda n: min(n, -(-n // least) + 1)  # noqa: E731  blocks that hold n rows
    steps = [j for j in range(-reach(before), reach(after) + 1) if j]
    t = seams.withColumn("_to", F.col(BLOCK)).withColumn("_step", F.explode(F.array(*[F.lit(j) for j in steps])))
    t = t.withColumn("_b", F.col("_b") + F.col("_step")).drop("_step").alias("t")
    s = seams.alias("s")
    low, high = F.col("t._start") - before, F.col("t._start") + F.col("t._c") + after
    first = F.greatest(low, F.col("s._start")) - F.col("s._start") + F.col("s._i0")
    last = F.least(high, F.col("s._start") + F.col("s._c")) - 1 - F.col("s._start") + F.col("s._i0")
    copies = s.join(t, (F.col("s._b") == F.col("t._b")) & _same(keys, "s", "t")).select(
        F.col(f"s.{BLOCK}").alias("_from"), F.col("t._to").alias("_to"), first.alias("_lo"), last.alias("_hi")).where("_lo <= _hi")
    got = rows.join(F.broadcast(copies), (F.col(BLOCK) == F.col("_from")) & F.col("_at").between(F.col("_lo"), F.col("_hi")))
    return got.withColumn(BLOCK, F.col("_to")).select(*rows.columns)


def _cut(df: DataFrame, keys: list[str], cut: str) -> bool:
    if cut not in ("auto", "whole", "blocks"):
        raise ValueError(f"unknown cut {cut!r}")
    return cut == "blocks" or cut == "auto" and longest(df, keys) > WHOLE_ROWS


def over_series(df: DataFrame, key, order: str, make: Callable[[Window, Column], dict[str, Column]], before: int = 0, after: int = 0,
                cut: str = "auto", parts: int | None = None) -> DataFrame:
    """``df`` with the columns of ``make(window, position)``: window expressions over a series in ``order`` whose frames
    reach at most ``before`` rows back and ``after`` rows ahead; ``position`` is a row's place in its series from 0.

    ``cut``: 'whole' windows by key, 'blocks' cuts series as described above, 'auto' measures the longest series and
    cuts beyond ``WHOLE_ROWS``.  Both give the same rows; rows that tie in ``order`` have no defined order in either.
    """
    keys = as_keys(key)
    if not _cut(df, keys, cut):
        w = Window.partitionBy(*keys).orderBy(order)
        return df.withColumns(make(w, F.row_number().over(w).cast("long") - 1))
    rows, seams = _blocks(df, keys, order, parts)
    mine = rows.withColumn(HALO, F.lit(False))
    if before or after:
        mine = mine.unionByName(_halo_rows(rows, seams, keys, before, after).withColumn(HALO, F.lit(True)))
    mine = _with_seams(mine, seams, keys, ["_start"])
    w = Window.partitionBy(BLOCK, *keys).orderBy("_at")
    own = F.sum((~F.col(HALO)).cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    out = mine.withColumns(make(w, F.coalesce(F.col("_start"), F.lit(0)) + own - 1))
    return out.where(~F.col(HALO)).drop(HALO, BLOCK, "_at", "_start")


def around_known(df: DataFrame, key, order: str, col: str, cut: str = "auto", parts: int | None = None) -> DataFrame:
    """``df`` with each row's position ``_i`` in its series, the last known value of ``col`` up to it (``_y0``, at
    position ``_i0``) and the next one from it on (``_y1``, ``_i1``); null where there is none."""
    keys = as_keys(key)
    blocks = _cut(df, keys, cut)
    if blocks:
        carried = ["_start", "_in_v", "_in_p", "_out_v", "_out_p"]
        d = _with_seams(*_blocks(df, keys, order, parts, col), keys, carried)
        group, by, start = [BLOCK, *keys], "_at", F.coalesce(F.col("_start"), F.lit(0))
    else:
        d, carried, group, by, start = df, [], keys, order, F.lit(0)
    # Running frames in both directions: one that reaches to the end would be added up anew for every row.
    back = Window.partitionBy(*group).orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*group).orderBy(F.col(by).desc()).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_i", start + F.row_number().over(Window.partitionBy(*group).orderBy(by)).cast("long") - 1)
    at = F.when(F.col(col).isNotNull(), F.col("_i"))
    for value, place, frame, far in (("_y0", "_i0", back, ("_in_v", "_in_p")), ("_y1", "_i1", ahead, ("_out_v", "_out_p"))):
        v, p = F.last(col, ignorenulls=True).over(frame), F.last(at, ignorenulls=True).over(frame)
        d = d.withColumns({value: F.coalesce(v, F.col(far[0])) if blocks else v, place: F.coalesce(p, F.col(far[1])) if blocks else p})
    return d.drop(*carried, *([BLOCK, "_at"] if blocks else []))
