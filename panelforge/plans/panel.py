"""Entity x year panel engineering (composition of the operators) and the
estimation-sample builder."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions.coerce import coerce_double
from panelforge.operators import clean, features, reshape
from panelforge.session import ensure_checkpoint_dir


@dataclass
class PanelSpec:
    """Column names and codes of a panel build; defaults are the reference's
    variable names (fixed values)."""
    entity: str = "country_iso3"
    area: str = "ref_area"
    time: str = "year"
    indicators: Mapping[str, str] = field(default_factory=dict)   # code -> column
    flows: Mapping[str, str] = field(default_factory=dict)        # code -> column
    growth: Mapping[str, str] = field(default_factory=lambda: {
        "gas_import_shock": "TOTIMPSB", "gas_demand_growth": "TOTDEMC", "gdp_growth": "gdp_level"})
    openness: tuple[str, str, str] = ("trade_openness", "imports_gdp", "exports_gdp")
    shock: str = "gas_import_shock"
    lags: Sequence[int] = (1, 2, 3)
    dependence: str = "energy_import_share"
    high: str = "high_energy_dependence"
    t0: int = 2022
    post: str = "post_2022"
    did: str = "did_interaction"
    interaction: str = "shock_x_highdep_lag{k}"
    fallback: Mapping[str, str] = field(default_factory=lambda: {"XKX": "XK"})


def engineer_panel(indicators_long: DataFrame, flows_long: DataFrame, crosswalk: DataFrame,
                   spec: PanelSpec, crosswalk_cols: tuple[str, str] = ("iso3", "iso2"),
                   quantile_method: str = "auto", freeze: bool = True) -> DataFrame:
    """indicators_long: (entity, time, indicator, value) annual observations;
    flows_long: (area, date, flow, value) monthly observations;
    crosswalk: entity code -> area code.  Returns the engineered panel."""
    s = spec
    ind = indicators_long.select(
        s.entity, F.col(s.time).cast("int").alias(s.time), "indicator",
        coerce_double(indicators_long, "value").alias("value"))
    ind = clean.require_fields(ind, [s.entity, s.time, "indicator", "value"])
    wide = reshape.pivot_mean(ind, [s.entity, s.time], "indicator", list(s.indicators), "value",
                              names=dict(s.indicators))
    wide = reshape.lookup(wide, s.entity, crosswalk, crosswalk_cols[0], crosswalk_cols[1], s.area,
                          fallback=s.fallback)

    fl = flows_long.where(F.col(s.area).isNotNull() & F.col("flow").isin(list(s.flows)))
    fl = fl.select(s.area, F.year(F.col("date")).alias(s.time), "flow",
                   coerce_double(flows_long, "value").alias("value"))
    fl = clean.require_fields(fl, ["value", s.time, s.area])
    annual = reshape.grouped_mean(fl, [s.area, s.time, "flow"], "value")
    fwide = reshape.pivot_mean(annual, [s.area, s.time], "flow", list(s.flows), "value", names=dict(s.flows))

    p = reshape.panel_join(wide, fwide, [s.area, s.time])
    if freeze:
        # entity x year is small at any scale: freeze it here so the
        # median-split profiling, the windows and later fits do not recompute
        # the joins and pivots over the observation tables
        ensure_checkpoint_dir(p.sparkSession)
        p = p.checkpoint(eager=True)
    for out, src in s.growth.items():
        p = features.pct_change(p, s.entity, s.time, src, out)
    name, a, b = s.openness
    p = p.withColumn(name, F.col(a) + F.col(b))
    p = features.lags(p, s.entity, s.time, s.shock, s.lags, name="{col}_lag{k}")
    p = features.median_split(p, s.entity, s.dependence, s.high, method=quantile_method)
    p = features.treatment_flags(p, s.time, s.t0, treat=s.high, post=s.post, interaction=s.did)
    p = p.withColumns({s.interaction.format(k=k): F.col(f"{s.shock}_lag{k}") * F.col(s.high) for k in s.lags})
    return features.inf_to_null(p)


def fe_sample(panel: DataFrame, cols: Sequence[str], subset_col: str | None = None,
              subset: str = "all", exclude: tuple[str, object] | None = None) -> DataFrame:
    """Complete cases over the model columns, then an optional excluded period
    and a high (=1) / low (=0) subsample on ``subset_col``."""
    d = clean.complete_cases(panel, list(cols))
    if exclude is not None:
        d = d.where(F.col(exclude[0]) != F.lit(exclude[1]))
    if subset == "high":
        d = d.where(F.col(subset_col) == 1)
    elif subset == "low":
        d = d.where(F.col(subset_col) == 0)
    return d
