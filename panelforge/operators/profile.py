"""Column profiles and data dictionaries, computed over the whole table in one
scan: counts of all columns and the few least values of each as examples."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions.coerce import to_double

EXAMPLES = 3
EXAMPLE_SEP = "; "


def dtype_label(dt: T.DataType) -> str:
    return dt.simpleString()


_ORDERED = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _comparable(df: DataFrame, name: str):
    """The column as it is if Arrow and Spark order it alike, else as text."""
    c = F.col(f"`{name}`")
    return c if isinstance(df.schema[name].dataType, _ORDERED) else c.cast("string")


def profile_parts(df: DataFrame, order_key: Sequence[str], k: int, infer_text: bool = True) -> DataFrame:
    """One row per task over ``df``, read once: ``_n`` rows and, for column i, ``nn{i}`` non-null values, ``num{i}``
    that parse as numbers (text columns) and ``ex{i}``, the ``k`` least (order key, value) of its non-null values.

    The parts merge: counts add up and the least of all is among the least of the parts.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    cols, keys = df.columns, list(order_key)
    text = [i for i, c in enumerate(cols) if infer_text and isinstance(df.schema[c].dataType, T.StringType)]
    src = df.select(*[_comparable(df, c).alias(f"k{j}") for j, c in enumerate(keys)], *[_comparable(df, c).alias(f"c{i}") for i, c in enumerate(cols)],
                    *[to_double(F.col(f"`{cols[i]}`")).isNotNull().alias(f"t{i}") for i in text])
    names = [f.name for f in src.schema.fields]
    kinds = {f.name: f.dataType.simpleString() for f in src.schema.fields}
    fields = "".join(f"_k{j}: {kinds[f'k{j}']}, " for j in range(len(keys)))
    least = "".join(f", nn{i} bigint, num{i} bigint, ex{i} array<struct<{fields}_v: {kinds[f'c{i}']}>>" for i in range(len(cols)))

    def run(batches):
        n, nn, num = 0, [0] * len(cols), [0] * len(cols)
        best: list = [None] * len(cols)
        for b in batches:
            if not b.num_rows:
                continue
            at = {x: b.column(j) for j, x in enumerate(names)}
            n += b.num_rows
            for i in text:
                num[i] += pc.sum(at[f"t{i}"]).as_py() or 0
            order = None
            for i in range(len(cols)):
                valid = b.num_rows - at[f"c{i}"].null_count
                nn[i] += valid
                if not valid or not keys or not k:
                    continue
                if order is None:
                    keyed = pa.table([at[f"k{j}"] for j in range(len(keys))], names=[f"_k{j}" for j in range(len(keys))])
                    order = pc.sort_indices(keyed, [(x, "ascending") for x in keyed.column_names], null_placement="at_start").to_numpy()
                rows = order[pc.is_valid(at[f"c{i}"]).to_numpy(zero_copy_only=False)[order]]
                if len(rows) > k:
                    own = [at[f"k{j}"] for j in range(len(keys))]
                    last = [c[int(rows[k - 1])].as_py() for c in own]
                    if [c[int(rows[k])].as_py() for c in own] != last:
                        rows = rows[:k]
                    else:  # all that tie with the k-th key go on to the order by value
                        tie = np.ones(len(rows), bool)
                        for c, x in zip(own, last):
                            c = c.take(pa.array(rows))
                            tie &= (pc.is_null(c) if x is None else pc.fill_null(pc.equal(c, pa.scalar(x, c.type)), False)).to_numpy(zero_copy_only=False)
                        rows = np.concatenate([rows[:k][~tie[:k]], rows[tie]])
                pick = pa.array(rows)
                got = pa.table([*(at[f"k{j}"].take(pick) for j in range(len(keys))), at[f"c{i}"].take(pick)], names=[*keyed.column_names, "_v"])
                if best[i] is not None:
                    got = pa.concat_tables([best[i], got])
                got = got.take(pc.sort_indices(got, [(x, "ascending") for x in got.column_names], null_placement="at_start")[:k])
                best[i] = got.combine_chunks()
        if not n:
            return
        out = {"_n": pa.array([n], pa.int64())}
        for i in range(len(cols)):
            out[f"nn{i}"], out[f"num{i}"] = pa.array([nn[i]], pa.int64()), pa.array([num[i]], pa.int64())
            kind = pa.struct([*((f"_k{j}", at[f"k{j}"].type) for j in range(len(keys))), ("_v", at[f"c{i}"].type)])
            rows = best[i].to_pylist() if best[i] is not None else []
            out[f"ex{i}"] = pa.array([rows], pa.list_(kind))
        yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return src.mapInArrow(run, f"_n bigint{least}")


def column_profile(df: DataFrame, order_key: str | Sequence[str] | None = None,
                   examples: int = EXAMPLES, infer_text: bool = True) -> DataFrame:
    """One row per column: variable, position, dtype, rows_total, non_null,
    missing, missing_pct (4 places), example_values.

    ``dtype`` of a text column is 'numeric' when every non-null value parses as
    a number (and there is at least one), else 'string'; other columns keep
    their Spark type name.  Example values are the first ``examples`` non-null
    values in ``order_key`` order (ties by value), joined by '; '; without examples (0) no key is needed.

    The table is read once, whatever its number of columns: counts alone are one native aggregation; with examples
    each task keeps the few least values of every column beside its counts (:func:`profile_parts`)."""
    if examples > 0 and not order_key:
        raise ValueError("example values need an order_key")
    cols = df.columns
    keys = [] if order_key is None else ([order_key] if isinstance(order_key, str) else list(order_key))
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    if examples > 0:
        parts = profile_parts(df, keys, examples, infer_text)
        merged = [F.coalesce(F.sum("_n"), F.lit(0)).alias("_n")]
        for i in range(len(cols)):
            least = F.slice(F.array_sort(F.flatten(F.collect_list(f"ex{i}"))), 1, examples)
            merged += [F.coalesce(F.sum(f"nn{i}"), F.lit(0)).alias(f"_nn{i}"), F.coalesce(F.sum(f"num{i}"), F.lit(0)).alias(f"_num{i}"), least.alias(f"ex{i}")]
        # by shares of the tasks first, so that no merge takes all parts at once
        shares = 1 + math.isqrt(max(1, df.sparkSession.sparkContext.defaultParallelism))
        some = parts.groupBy(F.pmod(F.spark_partition_id(), F.lit(shares)).alias("_share")).agg(*[
            c.alias(x) for c, x in zip(merged, ["_n", *[f"{x}{i}" for i in range(len(cols)) for x in ("nn", "num", "ex")]])])
        counts = some.agg(*merged)
    else:
        aggs = [F.count(F.lit(1)).alias("_n")]
        for i, c in enumerate(cols):
            aggs.append(F.count(F.col(f"`{c}`")).alias(f"_nn{i}"))
            if infer_text and c in text:
                aggs.append(F.count(to_double(F.col(f"`{c}`"))).alias(f"_num{i}"))
        counts = df.agg(*aggs)
    rows = []
    for i, c in enumerate(cols):
        nn = F.col(f"_nn{i}")
        if infer_text and c in text:
            dtype = F.when((F.col(f"_num{i}") == nn) & (nn > 0), F.lit("numeric")).otherwise(F.lit("string"))
        else:
            dtype = F.lit(dtype_label(df.schema[c].dataType))
        shown = F.array_join(F.transform(f"ex{i}", lambda s: s["_v"].cast("string")), EXAMPLE_SEP) if examples > 0 else F.lit("")
        rows.append(F.struct(F.lit(c).alias("variable"), F.lit(i).alias("position"), dtype.alias("dtype"),
                             F.col("_n").alias("rows_total"), nn.alias("non_null"),
                             (F.col("_n") - nn).alias("missing"),
                             F.round(F.try_divide((F.col("_n") - nn) * F.lit(100.0), F.col("_n")), 4).alias("missing_pct"),
                             shown.alias("example_values")))
    return counts.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def example_values(df: DataFrame, order_key, k: int = EXAMPLES) -> DataFrame:
    """(variable, example_values): first k non-null values per column by ``order_key``, all columns in one scan."""
    return column_profile(df, order_key, k, infer_text=False).select("variable", "example_values")


def duplicate_count(df: DataFrame) -> DataFrame:
    """rows, distinct rows and duplicates (rows - distinct), null equal to null."""
    per_row = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_c"))
    return per_row.agg(F.sum("_c").alias("rows"), F.count(F.lit(1)).alias("distinct_rows")).withColumn(
        "duplicates", F.col("rows") - F.col("distinct_rows"))


def distinct_sorted(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct().orderBy(*cols)


# The fallback description of a column with no dictionary entry.
FALLBACK_ENTRY = {"description": "Variable included in final panel", "source": "Derived",
                  "category": "Derived", "unit": "", "notes": ""}
# The description of every column when there is no dictionary at all.
UNDOCUMENTED_ENTRY = {**FALLBACK_ENTRY, "source": "Consolidated Data", "category": "Data"}
DICT_COLUMNS = ("variable", "dtype", "description", "source", "category", "unit", "notes")


def data_dictionary(profile: DataFrame, documented: DataFrame | None = None,
                    fallback: Mapping[str, str] = FALLBACK_ENTRY) -> DataFrame:
    """Dictionary rows in column order: documented variables (semi join to the
    profile) take their entry, undocumented ones (anti join) a fallback row; without ``documented``
    all take ``UNDOCUMENTED_ENTRY``.
    ``profile`` comes from :func:`column_profile`."""
    prof = profile.select("variable", "position", "dtype", "non_null")
    if documented is None:
        rows = prof.withColumns({k: F.lit(v) for k, v in UNDOCUMENTED_ENTRY.items()})
    else:
        doc = documented.select("variable", *[c for c in ("description", "source", "category", "unit", "notes")])
        known = prof.join(doc, on="variable", how="inner")
        unknown = prof.join(doc.select("variable"), on="variable", how="left_anti").withColumns(
            {k: F.lit(v) for k, v in fallback.items()})
        rows = known.unionByName(unknown)
    return rows.select(*DICT_COLUMNS, "non_null", "position")
