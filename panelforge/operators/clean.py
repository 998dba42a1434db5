"""Cleaning operators: required fields, complete cases, empty rows/columns,
dataset rule table, IQR fences and the cleaning funnel (audit)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.coerce import coerce_double
from panelforge.functions.columns import resolve
from panelforge.operators.quantiles import grouped_quantiles

FENCE_K = 3.0


# --------------------------------------------------------------------------
# Required fields / complete cases / empty rows and columns
# --------------------------------------------------------------------------

def require_fields(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows where every listed column is non-null (and not NaN)."""
    cols = [c for c in cols if c in df.columns]
    return df.na.drop(how="any", subset=cols) if cols else df


def required_ok(df: DataFrame, cols: Sequence[str]) -> Column:
    """Predicate form of :func:`require_fields` (for one-pass funnels)."""
    cond = F.lit(True)
    for c in cols:
        col = F.col(c)
        dt = df.schema[c].dataType.typeName()
        ok = col.isNotNull() & (~F.isnan(col) if dt in ("double", "float") else F.lit(True))
        cond = cond & ok
    return cond


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Listwise deletion over the model columns (null, NaN and +-inf are missing)."""
    out = df.select(*cols)
    for c in cols:
        if out.schema[c].dataType.typeName() in ("double", "float"):
            out = out.withColumn(c, F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(F.col(c)))
    return out.na.drop(how="any")


def drop_all_null_rows(df: DataFrame) -> DataFrame:
    return df.na.drop(how="all")


def empty_columns(df: DataFrame) -> list[str]:
    """Names of the columns that are null in every row (one aggregation job)."""
    if not df.columns:
        return []
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return [c for i, c in enumerate(df.columns) if row[f"c{i}"] == 0]


def drop_empty_columns(df: DataFrame) -> tuple[DataFrame, list[str]]:
    empty = empty_columns(df)
    return (df.drop(*empty) if empty else df), empty


# --------------------------------------------------------------------------
# Dataset rule table
# --------------------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    required: tuple[str, ...]
    outliers: tuple[str, ...]
    groups: tuple[str, ...] = ()


# Dataset-name substrings (matched on the lower-cased name, first
# hit wins) and the fields each dataset requires, fences and groups by.
DATASET_RULES = (
    ("fred_macro_raw", Rule(
        required=("date", "cpi_all_items", "policy_rate", "industrial_production"),
        outliers=("cpi_all_items", "policy_rate", "industrial_production"))),
    ("staging_world_newformat", Rule(
        required=("REF_AREA", "TIME_PERIOD", "ENERGY_PRODUCT", "FLOW_BREAKDOWN", "UNIT_MEASURE", "OBS_VALUE"),
        outliers=("OBS_VALUE",),
        groups=("ENERGY_PRODUCT", "FLOW_BREAKDOWN", "UNIT_MEASURE"))),
    ("world_bank_wdi_raw", Rule(
        required=("indicator_id", "country_iso3", "year", "value"),
        outliers=("value",),
        groups=("indicator_id",))),
)
# Fixed values for datasets without a rule.
GENERIC_REQUIRED = ("date", "year", "time_period", "country_iso3", "ref_area", "indicator_id", "obs_value", "value")
GENERIC_NOT_NUMERIC = ("year", "decimal", "assessment_code", "obs_status")
GENERIC_VALUE_NAMES = ("value", "obs_value")


@dataclass
class ResolvedRule:
    required: list[str] = field(default_factory=list)
    outliers: list[str] = field(default_factory=list)
    groups: list[str] = field(default_factory=list)


def dataset_rules(columns: Sequence[str], dataset_name: str) -> ResolvedRule:
    """Rules for a dataset, resolved case-insensitively against its columns.
    Names that the dataset lacks are dropped."""
    columns = list(columns)
    name = dataset_name.lower()
    for needle, rule in DATASET_RULES:
        if needle in name:
            m = resolve(columns, rule.required + rule.outliers + rule.groups)
            pick = lambda names: [m[n] for n in names if n in m]
            return ResolvedRule(pick(rule.required), pick(rule.outliers), pick(rule.groups))
    m = resolve(columns, GENERIC_REQUIRED)
    required = [m[n] for n in GENERIC_REQUIRED if n in m]
    numeric = [c for c in columns if c.lower() not in GENERIC_NOT_NUMERIC]
    outliers = [c for c in numeric if c.lower() in GENERIC_VALUE_NAMES] or numeric
    return ResolvedRule(required, outliers, [])


# --------------------------------------------------------------------------
# IQR fence
# --------------------------------------------------------------------------

def fence_flag(df: DataFrame, value_cols: Sequence[str], group_cols: Sequence[str] = (),
               k: float = FENCE_K, null_groups: str = "group", method: str = "auto",
               flag: str = "_keep", bounds_from: Column | None = None) -> DataFrame:
    """Add boolean ``flag``: the row passes the k*IQR fence on every value column.

    A row passes a column when its coerced value is null, the group IQR is
    null or 0, or ``q1 - k*iqr <= v <= q3 + k*iqr``.  Bounds of all columns are
    taken from the same input (``bounds_from`` restricts which rows feed them).
    ``null_groups='group'`` puts null keys in one group; ``'keep'`` gives them
    no bounds (so they pass), like a plain equality join.
    """
    value_cols, group_cols = list(value_cols), list(group_cols)
    helpers = {f"_fv{i}": coerce_double(df, c) for i, c in enumerate(value_cols)}
    g_alias = {g: f"_fg{i}" for i, g in enumerate(group_cols)}
    work = df.withColumns(helpers)
    if not value_cols:
        return df.withColumn(flag, F.lit(True))
    src = work.where(bounds_from) if bounds_from is not None else work
    gsrc = src.select(*[F.col(g).alias(a) for g, a in g_alias.items()], *helpers)
    if len(value_cols) == 1:
        bounds = grouped_quantiles(gsrc, "_fv0", list(g_alias.values()), [0.25, 0.75],
                                   method=method, out_names=["_q1_0", "_q3_0"])
    else:
        # all value columns stacked into one long frame: one sort / one pass
        # computes the bounds of every column, keyed by (column index, group)
        long = gsrc.select(*g_alias.values(), F.explode(F.array(*[
            F.struct(F.lit(i).alias("_ci"), F.col(f"_fv{i}").alias("_cv"))
            for i in range(len(value_cols))])).alias("_s"))
        long = long.select(*g_alias.values(), "_s._ci", "_s._cv")
        q = grouped_quantiles(long, "_cv", ["_ci", *g_alias.values()], [0.25, 0.75],
                              method=method, out_names=["_q1", "_q3"])
        bounds = q.groupBy(*g_alias.values()).agg(*[
            F.max(F.when(F.col("_ci") == i, F.col(qn))).alias(f"_{qn[1:]}_{i}")
            for i in range(len(value_cols)) for qn in ("_q1", "_q3")])
    if group_cols:
        eq = [work[g].eqNullSafe(bounds[a]) if null_groups == "group" else work[g] == bounds[a]
              for g, a in g_alias.items()]
        # bounds hold one row per group; AQE turns this into a broadcast join
        # only when their measured size is under the threshold.
        joined = work.join(bounds, on=eq, how="left").drop(*g_alias.values())
    else:
        # global bounds are scalars: read the one row once and inline them
        row = bounds.first()
        lits = {}
        for i in range(len(value_cols)):
            for q in ("q1", "q3"):
                v = row[f"_{q}_{i}"] if row is not None else None
                lits[f"_{q}_{i}"] = F.lit(v).cast("double")
        joined = work.withColumns(lits)
    keep = F.lit(True)
    for i in range(len(value_cols)):
        v, q1, q3 = F.col(f"_fv{i}"), F.col(f"_q1_{i}"), F.col(f"_q3_{i}")
        iqr = q3 - q1
        ok = (v.isNull() | iqr.isNull() | (iqr == 0)
              | ((v >= q1 - F.lit(k) * iqr) & (v <= q3 + F.lit(k) * iqr)))
        keep = keep & ok
    helper_cols = list(helpers) + [f"_q{j}_{i}" for i in range(len(value_cols)) for j in (1, 3)]
    return joined.withColumn(flag, keep).drop(*helper_cols)


def iqr_fence(df: DataFrame, value_cols: Sequence[str], group_cols: Sequence[str] = (),
              k: float = FENCE_K, null_groups: str = "group", method: str = "auto") -> DataFrame:
    """Rows that pass the grouped (or, with no groups, global) k*IQR fence."""
    flagged = fence_flag(df, value_cols, group_cols, k, null_groups, method)
    return flagged.where(F.col("_keep")).drop("_keep")


# --------------------------------------------------------------------------
# Rule-driven cleaning with a one-pass funnel audit
# --------------------------------------------------------------------------

AUDIT_SCHEMA = ("source_name string, output_name string, rows_in long, rows_after_required long, "
                "rows_after_outliers long, dropped_missing_required long, dropped_outliers long, "
                "required_fields array<string>, outlier_columns array<string>, group_columns array<string>")


def clean_flags(df: DataFrame, dataset_name: str, rule: ResolvedRule | None = None,
                method: str = "auto") -> tuple[DataFrame, ResolvedRule]:
    """Flag columns ``_req`` (required fields present) and ``_keep`` (required and
    inside the fence).  Fence bounds use only rows that pass ``_req``."""
    rule = rule or dataset_rules(df.columns, dataset_name)
    flagged = df.withColumn("_req", required_ok(df, rule.required))
    if rule.outliers:
        flagged = fence_flag(flagged, rule.outliers, rule.groups, method=method,
                             flag="_fence", bounds_from=F.col("_req"))
    else:
        flagged = flagged.withColumn("_fence", F.lit(True))
    return flagged.withColumn("_keep", F.col("_req") & F.col("_fence")).drop("_fence"), rule


def funnel_counts(flagged: DataFrame) -> DataFrame:
    """rows_in, rows_after_required, rows_after_outliers in a single aggregation."""
    return flagged.agg(F.count(F.lit(1)).alias("rows_in"),
                       F.count_if(F.col("_req")).alias("rows_after_required"),
                       F.count_if(F.col("_keep")).alias("rows_after_outliers"))


def audit_row(flagged: DataFrame, rule: ResolvedRule, source_name: str, output_name: str) -> DataFrame:
    c = funnel_counts(flagged)
    arr = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    return c.select(
        F.lit(source_name).alias("source_name"), F.lit(output_name).alias("output_name"),
        "rows_in", "rows_after_required", "rows_after_outliers",
        (F.col("rows_in") - F.col("rows_after_required")).alias("dropped_missing_required"),
        (F.col("rows_after_required") - F.col("rows_after_outliers")).alias("dropped_outliers"),
        arr(rule.required).alias("required_fields"), arr(rule.outliers).alias("outlier_columns"),
        arr(rule.groups).alias("group_columns"))


def clean_dataset(df: DataFrame, dataset_name: str, output_name: str | None = None,
                  method: str = "auto") -> tuple[DataFrame, DataFrame]:
    """(cleaned rows, one-row audit).  Both derive from one flagged plan, so a
    write of the cleaned rows plus the audit share the scan and fence."""
    flagged, rule = clean_flags(df, dataset_name, method=method)
    out_name = output_name or f"{dataset_name}_cleaned"
    return (flagged.where(F.col("_keep")).drop("_req", "_keep"),
            audit_row(flagged, rule, dataset_name, out_name))
