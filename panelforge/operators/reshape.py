"""Reshaping and joining: grouped means, pivots, series assembly, sparse unions,
panel joins, lookups and semi/anti splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def grouped_mean(df: DataFrame, keys: Sequence[str], value: str, out: str | None = None) -> DataFrame:
    """Mean of ``value`` per key (null keys dropped, as pandas ``groupby`` does)."""
    keys = list(keys)
    src = df.where(F.lit(True) if not keys else _all_not_null(keys))
    return src.groupBy(*keys).agg(F.avg(value).alias(out or value))


def _all_not_null(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def pivot_mean(df: DataFrame, keys: Sequence[str], pivot_col: str, codes: Sequence[str],
               value: str, names: Mapping[str, str] | None = None) -> DataFrame:
    """Long -> wide: one row per key, one mean column per code.  The code list
    is explicit, so the output schema is fixed and no extra job finds codes."""
    keys = list(keys)
    src = df.where(_all_not_null(keys + [pivot_col]))
    wide = src.groupBy(*keys).pivot(pivot_col, list(codes)).agg(F.avg(value))
    names = names or {}
    return wide.select(*keys, *[F.col(f"`{c}`").alias(names.get(c, c)) for c in codes])


def assemble_series(df: DataFrame, key: str, series_col: str, value: str, codes: Sequence[str],
                    seq: str, names: Mapping[str, str] | None = None) -> DataFrame:
    """(key, series, value) -> one row per key, one column per series code.
    Several values for one cell: the one with the largest ``seq`` wins (a later
    observation overwrites an earlier one).  Full outer by construction."""
    names = names or {}
    wide = df.groupBy(key).pivot(series_col, list(codes)).agg(F.max_by(value, seq))
    return wide.select(key, *[F.col(f"`{c}`").alias(names.get(c, c)) for c in codes])


# Most decimal digits of each integer type.
_INT_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _common_type(types: list[T.DataType]) -> T.DataType:
    uniq = {t.simpleString(): t for t in types}
    if len(uniq) == 1:
        return types[0]
    if all(isinstance(t, T.IntegralType) for t in types):
        return T.LongType()
    if all(isinstance(t, (T.IntegralType, T.DecimalType)) for t in types):
        scale = max(t.scale for t in types if isinstance(t, T.DecimalType))
        whole = max(t.precision - t.scale if isinstance(t, T.DecimalType) else _INT_DIGITS[type(t)] for t in types)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    if all(isinstance(t, T.NumericType) for t in types):
        return T.DoubleType()
    return T.StringType()


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column absent from a frame is null there.
    Column order is first-seen; a name with differing types is widened:
    integers to bigint, integers and decimals to a decimal that holds both, other
    numbers to double, the rest to string."""
    order: list[str] = []
    types: dict[str, list[T.DataType]] = {}
    for f in frames:
        for fld in f.schema.fields:
            if fld.name not in types:
                order.append(fld.name)
                types[fld.name] = []
            types[fld.name].append(fld.dataType)
    target = {c: _common_type(ts) for c, ts in types.items()}
    out = None
    for f in frames:
        present = set(f.columns)
        aligned = f.select(*[
            (F.col(f"`{c}`").cast(target[c]) if c in present else F.lit(None).cast(target[c])).alias(c)
            for c in order])
        out = aligned if out is None else out.unionByName(aligned)
    return out


def panel_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join of two panels on their (entity, time) keys.  Both sides are
    aggregated panels; Catalyst/AQE picks broadcast vs sort-merge by size."""
    return left.join(right, on=list(keys), how=how)


def flow_pair(df: DataFrame, keys: Sequence[str], flow_col: str, a_code: str, b_code: str,
              value: str, a_name: str, b_name: str) -> DataFrame:
    """Two flows of one long table side by side, one row per key: the mean of
    each flow per key (conditional aggregation; keys where either flow is
    missing are dropped, as an inner join would).  For statistics over the
    many-to-many pairing of the raw rows use :func:`pair_moments`."""
    keys = list(keys)
    agg = df.where(F.col(flow_col).isin(a_code, b_code)).groupBy(*keys).agg(
        F.avg(F.when(F.col(flow_col) == a_code, F.col(value))).alias(a_name),
        F.avg(F.when(F.col(flow_col) == b_code, F.col(value))).alias(b_name))
    return agg.where(F.col(a_name).isNotNull() & F.col(b_name).isNotNull())


def pair_moments(df: DataFrame, keys: Sequence[str], group: Sequence[str], flow_col: str,
                 a_code: str, b_code: str, value: str) -> DataFrame:
    """Moments of the many-to-many inner pairing of flow-a rows with flow-b
    rows that share ``keys``, summed per ``group`` (a subset of ``keys``),
    without materialising a single pair.

    For a key with n_a a-values of mean m_a and squared deviation D_a (b alike),
    the n_a * n_b pairs contribute count n_a*n_b, sum_a n_a*n_b*m_a, sum_aa
    n_b*(D_a + n_a*m_a^2) and sum_ab n_a*n_b*m_a*m_b.  Each flow is first
    reduced to (n, m, D) per key (partial aggregation), the two per-key
    tables are joined one row to one row, and the products are summed per
    group: a hot key costs one row, not n_a * n_b.  The means are taken from
    the group's references ``ref_a`` and ``ref_b`` (means over its keys), and
    so are the moments: values far from zero lose no digits."""
    keys, group = list(keys), list(group)

    def per_key(code, p):
        v = F.col(value).cast("double")
        return (df.where((F.col(flow_col) == code) & v.isNotNull() & ~F.isnan(v))
                .groupBy(*keys).agg(F.count(v).cast("double").alias(f"{p}n"), F.avg(v).alias(f"{p}m"),
                                    (F.var_pop(v) * F.count(v)).alias(f"{p}d")))
    j = per_key(a_code, "_a").join(per_key(b_code, "_b"), on=keys)
    refs = j.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)]).agg(
        F.avg("_am").alias("ref_a"), F.avg("_bm").alias("ref_b"))
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
    j = j.join(refs, on=same)
    pairs, a, b = F.col("_an") * F.col("_bn"), F.col("_am") - F.col("ref_a"), F.col("_bm") - F.col("ref_b")
    return j.groupBy(*group).agg(
        F.sum(pairs).alias("n"),
        F.sum(pairs * a).alias("sum_a"),
        F.sum(pairs * b).alias("sum_b"),
        F.sum(F.col("_bn") * F.col("_ad") + pairs * a * a).alias("sum_aa"),
        F.sum(F.col("_an") * F.col("_bd") + pairs * b * b).alias("sum_bb"),
        F.sum(pairs * a * b).alias("sum_ab"),
        F.first("ref_a").alias("ref_a"), F.first("ref_b").alias("ref_b"))


def outer_merge(left: DataFrame, right: DataFrame, on: Sequence[str], order: bool = True) -> DataFrame:
    out = left.join(right, on=list(on), how="full_outer")
    return out.orderBy(*on) if order else out


def lookup(df: DataFrame, key: str, crosswalk: DataFrame, cw_key: str, cw_value: str,
           out: str, fallback: Mapping[str, str] | None = None) -> DataFrame:
    """Attach ``crosswalk[cw_value]`` by key; keys missing from the crosswalk use
    the literal ``fallback`` map, else null.  A key listed twice takes its smallest value."""
    cw = crosswalk.select(F.col(cw_key).alias("_lk"), F.col(cw_value).alias("_lv")).groupBy("_lk").agg(F.min("_lv").alias("_lv"))
    value_type = cw.schema["_lv"].dataType
    joined = df.join(cw, df[key] == cw["_lk"], "left")
    fb = F.lit(None).cast(value_type)
    if fallback:
        m = F.create_map(*[x for kv in fallback.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
        fb = F.try_element_at(m, F.col(key).cast("string")).try_cast(value_type)
    return joined.withColumn(out, F.coalesce(F.col("_lv"), fb)).drop("_lk", "_lv")


def lookup_with_default(df: DataFrame, key: str, meta: DataFrame, meta_key: str,
                        defaults: Mapping[str, object]) -> DataFrame:
    """Left join of a metadata table; columns missing for a key take ``defaults``.
    A key listed twice takes the smallest of its rows, so no row of ``df`` is multiplied."""
    rest = [c for c in meta.columns if c != meta_key]
    m = meta.groupBy(F.col(meta_key).alias("_mk")).agg(F.min(F.struct(*rest)).alias("_m")).select("_mk", "_m.*")
    joined = df.join(m, df[key] == m["_mk"], "left").drop("_mk")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def semi_anti_split(df: DataFrame, ref: DataFrame, key: str, ref_key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows of ``df`` whose key is in ``ref``, rows whose key is not)."""
    rk = ref.select(F.col(ref_key or key).alias(key)).distinct()
    return df.join(rk, on=key, how="left_semi"), df.join(rk, on=key, how="left_anti")


def position_order(df: DataFrame, col: str, names: Sequence[str], out: str = "_order") -> DataFrame:
    """Add the position of ``col`` in a literal list (unknown -> after the list)."""
    m = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])
    return df.withColumn(out, F.coalesce(F.try_element_at(m, F.col(col)), F.lit(len(names))))


def sort_all_nulls_last(df: DataFrame) -> DataFrame:
    """Order by every column, ascending, nulls last (a range-partitioned sort)."""
    return df.orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in df.columns])
