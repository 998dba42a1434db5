"""Named queries over the driver tables.  Each takes (spark, sf_dir) and returns
a DataFrame; column names equal those of the matching SQL in
:mod:`panelforge.plans.oracle`.  Doubles are rounded to 6 places on both sides
because sums depend on the order of addition."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators import clean, quantiles
from panelforge.session import read_table, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(c) -> F.Column:
    """Round to 6 places through decimal(38,8): ties are decided on the
    decimal value (not on float noise below 1e-8) and -0.0 becomes 0.0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.try_cast("decimal(38,8)"), 6).cast("double")


# ---------------------------------------------------------------- cleaning

@query
def iqr_fence_grouped(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return clean.iqr_fence(ev, ["value"], ["event_type"])


@query
def iqr_fence_sql(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    fences = quantiles.grouped_quantiles(ev, "value", ["event_type"], [0.25, 0.75], out_names=["low", "high"])
    ev.createOrReplaceTempView("pf_events")
    fences.selectExpr("event_type", "low", "high", "3 * (high - low) AS reach").createOrReplaceTempView("pf_fences")
    return spark.sql("""
    SELECT event_id, user_id, event_type, value FROM pf_events LEFT JOIN pf_fences USING (event_type)
    WHERE NOT coalesce(reach > 0 AND value NOT BETWEEN low - reach AND high + reach, false)""")


def _audit_text(audit):
    return audit.select(
        "source_name", "rows_in", "rows_after_required", "rows_after_outliers",
        "dropped_missing_required", "dropped_outliers",
        F.array_join("required_fields", ",").alias("required_fields"),
        F.array_join("outlier_columns", ",").alias("outlier_columns"),
        F.array_join("group_columns", ",").alias("group_columns"))


@query
def rule_driven_clean(spark, sf):
    ev = read_table(spark, sf, "events")
    # the lenient scan lands every column as text
    od = read_table(spark, sf, "orders")
    od = od.select(*[F.col(c).cast("string").alias(c) for c in od.columns])
    _, a1 = clean.clean_dataset(ev, "events")
    _, a2 = clean.clean_dataset(od, "orders")
    return _audit_text(a1).unionByName(_audit_text(a2))


@query
def iqr_fence_global(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return clean.iqr_fence(ev, ["value", "user_id"])


def _events_with_k(spark, sf):
    return read_table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k"))


@query
def cleaning_funnel(spark, sf):
    ev = _events_with_k(spark, sf)
    rule = clean.ResolvedRule(required=["event_type", "value", "k"], outliers=["value"], groups=["event_type"])
    flagged, _ = clean.clean_flags(ev, "events", rule=rule)
    return clean.funnel_counts(flagged).select(
        "rows_in", "rows_after_required", "rows_after_outliers",
        (F.col("rows_in") - F.col("rows_after_required")).alias("dropped_missing_required"),
        (F.col("rows_after_required") - F.col("rows_after_outliers")).alias("dropped_outliers"))


def _orders_text(spark, sf):
    od = read_table(spark, sf, "orders")
    return od.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderstatus",
        F.format_string("%.2f", "o_totalprice").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        "o_orderpriority",
        F.when(F.col("o_orderstatus") != "O", F.format_string("%.2f", "o_totalprice")).alias("o_closed_price"))


@query
def null_profile(spark, sf):
    from panelforge.operators import profile
    od = _orders_text(spark, sf)
    # examples in order of the (text) key, as the landed all-text table has it
    p = profile.column_profile(od, order_key="o_orderkey")
    return p.select("variable", "position", "rows_total", "non_null", "missing", "missing_pct", "example_values")


@query
def type_inference(spark, sf):
    from panelforge.operators import profile
    od = _orders_text(spark, sf).withColumn("o_status_num", F.when(F.col("o_orderstatus") == "F", "1"))
    return profile.column_profile(od, examples=0).select("variable", "dtype", "non_null")


@query
def drop_empty_columns(spark, sf):
    od = read_table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice",
        F.lit(None).cast("string").alias("o_note"),
        F.when(F.col("o_totalprice") < 0, F.lit("negative")).alias("o_flag"))
    out, _ = clean.drop_empty_columns(od)
    return out


@query
def drop_all_null_rows(spark, sf):
    od = read_table(spark, sf, "orders")
    closed = F.col("o_orderstatus") == "F"
    d = od.select(F.when(~closed, F.col("o_orderkey")).alias("a"),
                  F.when(~closed, F.col("o_totalprice")).alias("b"),
                  F.when(~closed, F.col("o_orderpriority")).alias("c"))
    return clean.drop_all_null_rows(d)


# ---------------------------------------------------------------- dates

_DATE_RENDER = [("yyyy-MM-dd", "%Y-%m-%d"), ("yyyy-MM", "%Y-%m"), ("yyyy/MM/dd", "%Y/%m/%d"),
                ("yyyy/MM", "%Y/%m"), ("yyyyMMdd", "%Y%m%d"), ("yyyy-M-d", "%Y-%-m-%-d")]


def _rendered(col, key, forms):
    expr = None
    for i, f in enumerate(forms):
        e = F.date_format(col, f)
        cond = F.pmod(key, F.lit(len(forms))) == i
        expr = F.when(cond, e) if expr is None else expr.when(cond, e)
    return expr


@query
def date_standardize(spark, sf):
    from panelforge.functions import coerce
    od = read_table(spark, sf, "orders")
    t = _rendered(F.col("o_orderdate"), F.col("o_orderkey"), [a for a, _ in _DATE_RENDER])
    d = od.select("o_orderkey", t.alias("date_text"))
    return d.withColumn("date_std", coerce.standardize_date_text("date_text"))


@query
def year_to_date(spark, sf):
    from panelforge.functions import coerce
    od = read_table(spark, sf, "orders")
    k = F.pmod(F.col("o_orderkey"), F.lit(4))
    y = F.date_format("o_orderdate", "yyyy")
    t = (F.when(k == 0, y).when(k == 1, F.concat(F.lit(" "), y, F.lit(" ")))
         .when(k == 2, F.date_format("o_orderdate", "yy")).otherwise(F.date_format("o_orderdate", "yyyy-MM")))
    return od.select("o_orderkey", t.alias("year_text")).withColumn("year_std", coerce.year_to_date_text("year_text"))


@query
def timestamp_to_date(spark, sf):
    from panelforge.functions import coerce
    od = read_table(spark, sf, "orders")
    k = F.pmod(F.col("o_orderkey"), F.lit(4))
    t = (F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
         .when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
         .when(k == 2, F.lit("n/a"))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'12:mm:ss'+02:00'")))
    return od.select("o_orderkey", t.alias("ts_text")).withColumn("ts_date", coerce.timestamp_to_date_text("ts_text"))


@query
def date_range_filter(spark, sf):
    from panelforge.functions import coerce
    od = read_table(spark, sf, "orders")
    text = F.when(F.pmod("o_orderkey", F.lit(10)) == 0, F.lit("n/a")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    d = od.select("o_orderkey", coerce.to_date_lenient(text, "yyyy-MM-dd").alias("order_date"))
    d = d.where(F.col("order_date").between(F.lit("1996-01-01").cast("date"), F.lit("1997-12-31").cast("date")))
    return d.withColumn("yr", coerce.year_of("order_date")).orderBy("o_orderkey")


# ---------------------------------------------------------------- blocks, unions, dedupe

@query
def block_extract(spark, sf):
    from panelforge.functions import coerce
    from panelforge.operators import reshape
    od = read_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus",
                                                 F.col("o_totalprice").cast("string").alias("amount_text"))
    ev = read_table(spark, sf, "events").select("event_id", "event_type",
                                                 F.col("value").cast("string").alias("amount_text"))
    u = reshape.union_by_name([od, ev])
    blk = u.where(F.col("event_type").isNotNull() & F.col("event_type").isin("click", "purchase"))
    return blk.select("event_id", "event_type", coerce.to_double("amount_text").alias("amount"))


@query
def union_sparse_panel(spark, sf):
    from panelforge.functions import columns
    from panelforge.operators import reshape
    od = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("O_ORDERKEY"),
                                                 F.col("o_totalprice").alias("O_TotalPrice"))
    ev = read_table(spark, sf, "events").select(F.col("event_id").alias("Event_ID"), "value")
    li = read_table(spark, sf, "lineitem").select("l_orderkey", F.col("l_quantity").alias("L_QUANTITY"))
    return reshape.union_by_name([columns.lower_names(od), columns.lower_names(ev), columns.lower_names(li)])


@query
def row_dedupe(spark, sf):
    from panelforge.operators import dedupe
    return dedupe.drop_exact_duplicates(read_table(spark, sf, "documents").select("text", "lang", "source"))


@query
def content_dedupe(spark, sf):
    from panelforge.operators import dedupe
    return dedupe.content_duplicates(read_table(spark, sf, "documents"), "doc_id", "text")


@query
def duplicate_rows(spark, sf):
    from panelforge.operators import profile
    return profile.duplicate_count(read_table(spark, sf, "documents").select("text", "lang", "source"))


# ---------------------------------------------------------------- shared bases

def _orders_nation(spark, sf):
    od = read_table(spark, sf, "orders")
    cu = read_table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    return od.join(cu, od["o_custkey"] == cu["c_custkey"]).drop("c_custkey")


def _nation_year(spark, sf):
    """nation x year panel: y = mean order price (thousands), x1 = orders
    (hundreds), x2 = mean discount of the orders' line items (percent)."""
    on = _orders_nation(spark, sf).withColumn("yr", F.year("o_orderdate"))
    a = on.groupBy("nation", "yr").agg((F.avg("o_totalprice") / 1000).alias("y"),
                                       (F.count(F.lit(1)).cast("double") / 100).alias("x1"))
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_discount")
    b = (li.join(on.select("o_orderkey", "nation", "yr"), li["l_orderkey"] == on["o_orderkey"])
         .groupBy("nation", "yr").agg((F.avg("l_discount") * 100).alias("x2")))
    return a.join(b, ["nation", "yr"])


def _frozen_nation_year(spark, sf):
    """The nation x year panel written once to the checkpoint folder (small at
    any scale): fits and median splits read it instead of re-joining."""
    return _nation_year(spark, sf).checkpoint(eager=True)


def _nation_month(spark, sf):
    on = _orders_nation(spark, sf)
    return on.groupBy("nation", F.trunc(F.to_date("o_orderdate"), "month").alias("month")).agg(
        (F.sum("o_totalprice") / 1e6).alias("revenue"))


def _monthly_series(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.groupBy(F.trunc(F.to_date("l_shipdate"), "month").alias("month")).agg(
        (F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))) / 1e6).alias("revenue"),
        (F.sum("l_quantity") / 1e3).alias("quantity"),
        F.avg("l_discount").alias("discount"))


def _round_doubles(df):
    from pyspark.sql import types as T
    return df.select(*[r6(f.name).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


# ---------------------------------------------------------------- reshape and joins

@query
def long_to_wide_mean(spark, sf):
    from panelforge.operators import reshape
    on = _orders_nation(spark, sf).withColumn("yr", F.year("o_orderdate"))
    w = reshape.pivot_mean(on, ["nation", "yr"], "o_orderstatus", ["F", "O", "P"], "o_totalprice",
                           names={"F": "avg_f", "O": "avg_o", "P": "avg_p"})
    return _round_doubles(w)


@query
def series_assemble(spark, sf):
    from panelforge.operators import reshape
    ev = read_table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return reshape.assemble_series(ev, "day", "event_type", "value",
                                   ["click", "error", "purchase", "signup", "view"], "ts").orderBy("day")


@query
def panel_inner_join(spark, sf):
    from panelforge.operators import reshape
    on = _orders_nation(spark, sf)
    a = on.groupBy("nation", F.year("o_orderdate").alias("yr")).agg((F.sum("o_totalprice") / 1e6).alias("revenue"))
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_shipdate")
    b = (li.join(on.select("o_orderkey", "nation"), li["l_orderkey"] == on["o_orderkey"])
         .groupBy("nation", F.year("l_shipdate").alias("yr")).agg((F.sum("l_quantity") / 1e3).alias("quantity")))
    return _round_doubles(reshape.panel_join(a, b, ["nation", "yr"]))


@query
def flow_self_join(spark, sf):
    from panelforge.operators import reshape, stats
    ev = read_table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    # correlation over every (error, click) pair of a user-day, from moments
    m = reshape.pair_moments(ev, ["user_id", "day"], ["user_id"], "event_type", "error", "click", "value")
    c = m.select("user_id", stats.corr_from_moments().alias("corr")).where(F.col("corr").isNotNull())
    bottom = c.orderBy("corr", "user_id").limit(15)
    return _round_doubles(bottom.withColumn(
        "sign", F.when(F.col("corr") < 0, F.lit("negative")).otherwise(F.lit("non-negative"))))


@query
def lookup_with_fallback(spark, sf):
    from panelforge.operators import reshape
    cu = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    na = read_table(spark, sf, "nation")
    rg = read_table(spark, sf, "region")
    nr = na.join(rg, na["n_regionkey"] == rg["r_regionkey"]).select("n_nationkey", "r_name")
    d = reshape.lookup(cu, "c_nationkey", na, "n_nationkey", "n_name", "nation_name", fallback={"XKX": "XK"})
    d = reshape.lookup_with_default(d, "c_nationkey", nr, "n_nationkey", {"r_name": "UNKNOWN"})
    return d.withColumnRenamed("r_name", "region_name")


# Fixed values for the registry: a small source dictionary of customer columns.
_CUSTOMER_DOCS = [("c_custkey", "Customer key", "TPC-H", "Key", "", ""),
                  ("c_acctbal", "Account balance", "TPC-H", "Financial", "currency", "may be negative")]


@query
def dictionary_semi_anti(spark, sf):
    from panelforge.operators import profile
    cu = read_table(spark, sf, "customer")
    prof = profile.column_profile(cu, examples=0, infer_text=False)
    docs = spark.createDataFrame(_CUSTOMER_DOCS, "variable string, description string, source string, "
                                                 "category string, unit string, notes string")
    return profile.data_dictionary(prof, docs)


_LISTED = (("customer", "c_custkey"), ("supplier", "s_suppkey"), ("part", "p_partkey"))


@query
def dictionary_listing(spark, sf):
    from panelforge.functions import text
    from panelforge.operators import profile
    out = None
    for name, key in _LISTED:
        p = profile.column_profile(read_table(spark, sf, name), order_key=key)
        p = p.select(F.lit(name).alias("dataset"), "variable", "dtype", text.source_label(F.lit(name)).alias("source"),
                     "rows_total", "non_null", text.clean_text("example_values").alias("example_values"))
        out = p if out is None else out.unionByName(p)
    return out.orderBy("dataset", "variable")


# ---------------------------------------------------------------- features

@query
def growth_and_lags(spark, sf):
    from panelforge.operators import features
    nm = _nation_month(spark, sf)
    g = features.pct_change(nm, "nation", "month", "revenue", "growth")
    g = features.lags(g, "nation", "month", "growth", [1, 2, 3])
    return _round_doubles(features.inf_to_null(g))


@query
def median_split(spark, sf):
    from panelforge.operators import features
    cu = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return features.median_split(cu, "c_nationkey", "c_acctbal", "high_balance").select(
        "c_custkey", "c_nationkey", "high_balance")


@query
def did_features(spark, sf):
    from panelforge.operators import features
    ny = _nation_year(spark, sf)
    d = features.sums(ny, {"trade": ("x1", "x2")})
    d = features.median_split(d, "nation", "y", "treat")
    d = features.treatment_flags(d, "yr", 1998, treat="treat", post="post", interaction="did")
    return _round_doubles(d.select("nation", "yr", "trade", "treat", "post", "did"))


# Fixed values for the registry: order priorities stand in for the annual
# indicators, return flags for the monthly flows.
PANEL_SPEC_KW = dict(
    entity="nation_name", area="nation_key", time="year",
    indicators={"1-URGENT": "inflation", "2-HIGH": "energy_import_share", "3-MEDIUM": "imports_gdp",
                "4-NOT SPECIFIED": "exports_gdp", "5-LOW": "gdp_level"},
    flows={"R": "imports_flow", "A": "demand_flow"},
    growth={"gas_import_shock": "imports_flow", "gas_demand_growth": "demand_flow", "gdp_growth": "gdp_level"},
    t0=1998, post="post_treatment")


def engineered_panel(spark, sf):
    from panelforge.plans.panel import PanelSpec, engineer_panel
    on = _orders_nation(spark, sf)
    na = read_table(spark, sf, "nation")
    ind = on.join(na, on["nation"] == na["n_nationkey"]).select(
        F.col("n_name").alias("nation_name"), F.year("o_orderdate").alias("year"),
        F.col("o_orderpriority").alias("indicator"), (F.col("o_totalprice") / 1000).alias("value"))
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate", "l_returnflag", "l_quantity")
    flows = li.join(on.select("o_orderkey", "nation"), li["l_orderkey"] == on["o_orderkey"]).select(
        F.col("nation").alias("nation_key"), F.col("l_shipdate").alias("date"),
        F.col("l_returnflag").alias("flow"), F.col("l_quantity").alias("value"))
    return engineer_panel(ind, flows, na, PanelSpec(**PANEL_SPEC_KW), crosswalk_cols=("n_name", "n_nationkey"))


@query
def panel_build(spark, sf):
    return _round_doubles(engineered_panel(spark, sf))


MODEL_A_COLS = ["nation_name", "year", "inflation", "gas_import_shock_lag1", "shock_x_highdep_lag1",
                "gdp_growth", "imports_gdp", "energy_import_share", "high_energy_dependence"]


@query
def complete_case_sample(spark, sf):
    from panelforge.plans.panel import fe_sample
    p = engineered_panel(spark, sf)
    return _round_doubles(fe_sample(p, MODEL_A_COLS, "high_energy_dependence", "high", ("year", 1999)))


# ---------------------------------------------------------------- EDA statistics

@query
def corr_matrix(spark, sf):
    from panelforge.operators import stats
    return _round_doubles(stats.corr_matrix(_monthly_series(spark, sf), ["revenue", "quantity", "discount"]))


@query
def corr_matrix_pairwise(spark, sf):
    """Correlations over pairwise-complete rows, with nulls in every column."""
    from panelforge.operators import moments
    li = read_table(spark, sf, "lineitem").select(
        F.when(F.col("l_linenumber") != 1, F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice") / 1000).alias("price_k"),
        F.when(F.pmod("l_orderkey", F.lit(7)) != 0, F.col("l_discount")).alias("discount"),
        F.when(F.pmod("l_orderkey", F.lit(5)) != 2, F.col("l_tax")).alias("tax"),
        F.when(F.col("l_linestatus") == "O", F.lit(1.5)).alias("constant"))
    return moments.pairwise_corr_matrix(li, li.columns).withColumn("corr", r6("corr"))


BAND_POINTS = (1.0, 10.0, 25.0, 40.0, 50.0)
BAND_REPLICATES = 40


@query
def regression_band(spark, sf):
    """Line of price on quantity with the band of its bootstrap replicates; weights hang on the line's key alone."""
    from panelforge.operators import moments
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", (F.col("l_extendedprice") / 1000).alias("price_k"))
    return _round_doubles(moments.line_band(li, F.concat_ws("-", "l_orderkey", "l_linenumber"), "l_quantity", "price_k", BAND_POINTS, BAND_REPLICATES))


@query
def lag_corr(spark, sf):
    from panelforge.operators import timeseries
    return _round_doubles(timeseries.lag_corr_profile(_monthly_series(spark, sf), "revenue", "discount", "month"))


@query
def best_lag(spark, sf):
    from panelforge.operators import timeseries
    prof = timeseries.lag_corr_profile(_monthly_series(spark, sf), "revenue", "discount", "month")
    return _round_doubles(timeseries.best_lag(prof))


@query
def topk_categories(spark, sf):
    from panelforge.operators import stats
    return stats.topk_counts(read_table(spark, sf, "events"), "event_type", 6)


@query
def boxplot_stats(spark, sf):
    from panelforge.operators import stats
    ev = read_table(spark, sf, "events")
    top = stats.topk_counts(ev, "event_type", 6).select("event_type")
    sel = ev.join(top, on="event_type", how="left_semi")
    return _round_doubles(stats.boxplot_stats(sel, "event_type", "value"))


def _customer_months(spark, sf):
    od = read_table(spark, sf, "orders")
    return od.groupBy("o_custkey", F.trunc(F.to_date("o_orderdate"), "month").alias("month")).agg(
        (F.sum("o_totalprice") / 1000).alias("total"))


@query
def densify_interpolate(spark, sf):
    from panelforge.operators import timeseries
    dense = timeseries.densify_monthly(_customer_months(spark, sf), "o_custkey", "month", ["total"])
    return _round_doubles(timeseries.interpolate_linear(dense, "o_custkey", "month", "total"))


@query
def seasonal_decompose(spark, sf):
    from panelforge.operators import timeseries
    dense = timeseries.densify_monthly(_nation_month(spark, sf), "nation", "month", ["revenue"])
    filled = timeseries.interpolate_linear(dense, "nation", "month", "revenue")
    return _round_doubles(timeseries.seasonal_decompose(filled, "nation", "month", "revenue", 12))


@query
def regression_line(spark, sf):
    from panelforge.operators import stats
    li = read_table(spark, sf, "lineitem").select("l_returnflag", "l_quantity",
                                                  (F.col("l_extendedprice") / 1000).alias("price_k"))
    return _round_doubles(stats.regression_line(li, "l_quantity", "price_k", "l_returnflag"))


@query
def json_flatten(spark, sf):
    ev = read_table(spark, sf, "events")
    parsed = F.from_json("props", "k BIGINT")
    return ev.select("event_id", F.coalesce(parsed["k"], F.lit(-1).cast("bigint")).alias("k"))


# ---------------------------------------------------------------- regression

def _fit_rows(spark, fit, terms=None, extra=None):
    """(variable, coef, se[, extra...]) rows of one fit."""
    from pyspark.sql import types as T
    terms = terms or fit.terms
    fields = [T.StructField("variable", T.StringType()), T.StructField("coef", T.DoubleType()),
              T.StructField("se", T.DoubleType())]
    extra = extra or {}
    for k, (typ, _) in extra.items():
        fields.append(T.StructField(k, typ))
    from panelforge.plans.regression import _f
    rows = [tuple([t, _f(fit.coef.get(t)), _f(fit.se.get(t))] + [fn(fit) for _, fn in extra.values()])
            for t in terms]
    return spark.createDataFrame(rows, T.StructType(fields))


def _ny_fit(spark, sf, effects, cluster=None):
    from panelforge.plans import regression
    ny = _frozen_nation_year(spark, sf)
    return regression.fit_ols(ny, "y", ["x1", "x2"], entity="nation", time="yr", effects=effects,
                              cluster=cluster)[None]


@query
def fe_one_way(spark, sf):
    from pyspark.sql import types as T
    f = _ny_fit(spark, sf, ("entity",))
    df = _fit_rows(spark, f, extra={"nobs": (T.LongType(), lambda f: int(f.nobs)),
                                    "r2_within": (T.DoubleType(), lambda f: f.r2_within)})
    return _round_doubles(df.drop("se"))


@query
def fe_two_way(spark, sf):
    from pyspark.sql import types as T
    f = _ny_fit(spark, sf, ("entity", "time"))
    df = _fit_rows(spark, f, extra={"nobs": (T.LongType(), lambda f: int(f.nobs)),
                                    "r2_within": (T.DoubleType(), lambda f: f.r2_within)})
    return _round_doubles(df.drop("se"))


@query
def cluster_se(spark, sf):
    f = _ny_fit(spark, sf, ("entity", "time"), cluster="nation")
    return _round_doubles(_fit_rows(spark, f))


def _did_frame(spark, sf):
    from panelforge.operators import features
    ny = _frozen_nation_year(spark, sf)
    d = features.median_split(ny, "nation", "x2", "treat")
    return d


@query
def did_estimate(spark, sf):
    from panelforge.operators import features
    from panelforge.plans import regression
    d = features.treatment_flags(_did_frame(spark, sf), "yr", 1998, treat="treat", post="post", interaction="did")
    f = regression.fit_ols(d, "y", ["did", "treat", "post", "x1"], entity="nation", time="yr",
                           cluster="nation", scale="dummies", dist="normal")[None]
    return _round_doubles(_fit_rows(spark, f))


@query
def placebo_did(spark, sf):
    from panelforge.operators import features
    from panelforge.plans import regression
    d = _did_frame(spark, sf).where(F.col("yr") < 1999)
    d = features.treatment_flags(d, "yr", 1997, treat="treat", post="placebo_post", interaction="placebo_did")
    f = regression.fit_ols(d, "y", ["placebo_did", "treat", "placebo_post", "x1"], entity="nation", time="yr",
                           cluster="nation", scale="dummies", dist="normal")[None]
    return _round_doubles(_fit_rows(spark, f))


def _lineitem_reg(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") / 1000).alias("price_k"),
                     "l_quantity", "l_discount", "l_tax")


@query
def breusch_pagan(spark, sf):
    from panelforge.plans import regression
    r = regression.breusch_pagan(_lineitem_reg(spark, sf), "price_k", ["l_quantity", "l_discount"])
    return _round_doubles(spark.createDataFrame(
        [(float(r["lm_stat"]), float(r["lm_pvalue"]), float(r["f_stat"]), float(r["f_pvalue"]), int(r["nobs"]))],
        "lm_stat double, lm_pvalue double, f_stat double, f_pvalue double, nobs long"))


@query
def vif(spark, sf):
    from panelforge.plans import regression
    rows = regression.vif(_lineitem_reg(spark, sf), ["l_quantity", "l_discount", "l_tax"])
    return _round_doubles(spark.createDataFrame(rows, "variable string, vif double"))


@query
def residuals(spark, sf):
    from panelforge.plans import regression
    li = _lineitem_reg(spark, sf)
    fit = regression.pooled_ols(li, "price_k", ["l_quantity", "l_discount"])
    out = regression.fitted_and_resid(li, fit, "price_k", ["l_quantity", "l_discount"])
    return _round_doubles(out.select("l_orderkey", "l_linenumber", "fitted", "resid"))


def _fe_resid(spark, sf):
    from panelforge.plans import regression
    ny = _frozen_nation_year(spark, sf)
    fit = regression.fit_ols(ny, "y", ["x1", "x2"], entity="nation", time="yr")[None]
    return regression.fe_fitted_and_resid(ny, fit, "y", ["x1", "x2"], "nation", "yr")


@query
def fe_residuals(spark, sf):
    return _round_doubles(_fe_resid(spark, sf).select("nation", "yr", "fitted", "resid"))


@query
def fe_qq(spark, sf):
    from panelforge.plans import regression
    return _round_doubles(regression.qq_table(_fe_resid(spark, sf), "resid"))


@query
def qq_table(spark, sf):
    from panelforge.plans import regression
    li = _lineitem_reg(spark, sf)
    fit = regression.pooled_ols(li, "price_k", ["l_quantity", "l_discount"])
    res = regression.fitted_and_resid(li, fit, "price_k", ["l_quantity", "l_discount"])
    return _round_doubles(regression.qq_table(res, "resid"))


@query
def qq_fit(spark, sf):
    from panelforge.plans import regression
    li = _lineitem_reg(spark, sf)
    fit = regression.pooled_ols(li, "price_k", ["l_quantity", "l_discount"])
    res = regression.fitted_and_resid(li, fit, "price_k", ["l_quantity", "l_discount"])
    return _round_doubles(regression.qq_fit(regression.qq_table(res, "resid")))


# Model specifications on the engineered panel (reference layout).
MODEL_A_REGS = ["gas_import_shock_lag1", "shock_x_highdep_lag1", "gdp_growth", "imports_gdp"]
MODEL_B_REGS = ["did_interaction", "high_energy_dependence", "post_treatment", "gas_import_shock_lag1",
                "gdp_growth", "imports_gdp"]


def _frozen_panel(spark, sf):
    """The engineered panel written to the shared checkpoint folder once, so
    several fits reuse it without recomputing the windows and median split."""
    return engineered_panel(spark, sf).checkpoint(eager=True)


def _models(spark, sf, panel=None):
    from panelforge.plans import regression
    from panelforge.plans.panel import fe_sample
    panel = panel if panel is not None else _frozen_panel(spark, sf)
    a = fe_sample(panel, MODEL_A_COLS)
    fa = regression.fit_ols(a, "inflation", MODEL_A_REGS, entity="nation_name", time="year",
                            cluster="nation_name", scale="panel", dist="t")[None]
    b = clean.complete_cases(panel, ["nation_name", "year", "inflation"] + MODEL_B_REGS)
    fb = regression.fit_ols(b, "inflation", MODEL_B_REGS, entity="nation_name", time="year",
                            cluster="nation_name", scale="dummies", dist="normal")[None]
    return fa, fb


@query
def regression_table(spark, sf):
    from panelforge.plans import report
    fa, fb = _models(spark, sf)
    ta = report.coef_table(spark, fa, "model_a")
    tb = report.coef_table(spark, fb, "model_b")
    return _round_doubles(report.comparison_table(ta, tb))


# Term labels and order of the publication table.
TERM_LABELS = {
    "gas_import_shock_lag1": "Gas import shock (t-1)",
    "shock_x_highdep_lag1": "Shock x high energy dependence",
    "did_interaction": "High dependence x Post-2022",
    "high_energy_dependence": "High energy dependence",
    "post_2022": "Post-2022",
    "gdp_growth": "GDP growth",
    "imports_gdp": "Imports (% GDP)",
}
TERM_ORDER = ["gas_import_shock_lag1", "shock_x_highdep_lag1", "did_interaction", "high_energy_dependence",
              "post_2022", "gdp_growth", "imports_gdp"]


@query
def publication_rows(spark, sf):
    from panelforge.plans import report
    fa, fb = _models(spark, sf)
    order = [("post_treatment" if t == "post_2022" else t) for t in TERM_ORDER]
    labels = dict(TERM_LABELS, post_treatment="Post-treatment")
    footer = [("Country fixed effects", ["Yes", "Yes"]), ("Year fixed effects", ["Yes", "Yes"]),
              ("Clustered standard errors", ["Country", "Country"]),
              ("Observations", [str(fa.nobs), str(fb.nobs)]),
              ("R-squared", [report.fmt4(fa.r2_within), report.fmt4(fb.r2)])]
    return report.publication_rows(spark, {"model_fe": fa, "model_did": fb}, order, labels, footer)


@query
def model_notes(spark, sf):
    from panelforge.plans import regression, report
    panel = _frozen_panel(spark, sf)
    fa, fb = _models(spark, sf, panel)
    a = clean.complete_cases(panel, MODEL_A_COLS)
    bp = regression.breusch_pagan(a, "inflation", MODEL_A_REGS)
    vifs = regression.vif(a, MODEL_A_REGS)
    six = lambda x: None if x is None else f"{float(round(x, 6)):.6f}"
    return report.notes(spark, [
        ("Model A entity FE", "Yes"), ("Model A time FE", "Yes"), ("Model A clustered SE", "Yes (entity)"),
        ("Model A observations", fa.nobs), ("Model A R2 within", six(fa.r2_within)),
        ("Model B country FE", "Yes"), ("Model B year FE", "Yes"), ("Model B clustered SE", "Yes (country)"),
        ("Model B observations", fb.nobs), ("Model B R2", six(fb.r2)),
        ("BP p-value", six(bp["lm_pvalue"])), ("Max VIF", six(max(v for _, v in vifs)))])


def _robustness_fits(spark, sf):
    """Fits of the robustness checks: alternative lags, an excluded year, high
    and low dependence subsamples (one stacked grid fit), and a placebo DiD in
    the pre-treatment years.  Returns [(check, variable, fit)]."""
    from panelforge.operators import features
    from panelforge.plans import regression
    from panelforge.plans.panel import fe_sample
    panel = _frozen_panel(spark, sf)

    def cols(lag):
        return ["nation_name", "year", "inflation", f"gas_import_shock_lag{lag}", f"shock_x_highdep_lag{lag}",
                "gdp_growth", "imports_gdp", "energy_import_share", "high_energy_dependence"]

    def regs(lag, sub=False):
        r = [f"gas_import_shock_lag{lag}", f"shock_x_highdep_lag{lag}", "gdp_growth", "imports_gdp"]
        return [r[0]] + r[2:] if sub else r

    specs = {
        "Alternative lag 2": (fe_sample(panel, cols(2)), regs(2), "gas_import_shock_lag2"),
        "Alternative lag 3": (fe_sample(panel, cols(3)), regs(3), "gas_import_shock_lag3"),
        "Exclude year 1999": (fe_sample(panel, cols(1), exclude=("year", 1999)), regs(1), "gas_import_shock_lag1"),
        "Subsample high dependence": (fe_sample(panel, cols(1), "high_energy_dependence", "high"),
                                      regs(1, True), "gas_import_shock_lag1"),
        "Subsample low dependence": (fe_sample(panel, cols(1), "high_energy_dependence", "low"),
                                     regs(1, True), "gas_import_shock_lag1"),
    }
    fits = regression.fit_grid({k: v[0] for k, v in specs.items()}, "inflation",
                               {k: v[1] for k, v in specs.items()}, "nation_name", "year",
                               cluster="nation_name", scale="panel", dist="t")
    out = [(k, v[2], fits[k]) for k, v in specs.items()]
    # placebo difference-in-differences in the pre-treatment years
    pre = clean.complete_cases(panel, PLACEBO_COLS).where(F.col("year") < 2000)
    pre = features.treatment_flags(pre, "year", 1999, treat="high_energy_dependence", post="placebo_post",
                                   interaction="placebo_interaction")
    fp = regression.fit_ols(pre, "inflation", PLACEBO_REGS, entity="nation_name", time="year",
                            cluster="nation_name", scale="dummies", dist="normal")[None]
    out.append(("Placebo DiD pre-treatment", "placebo_interaction", fp))
    return out


PLACEBO_COLS = ["nation_name", "year", "inflation", "high_energy_dependence", "gas_import_shock_lag1",
                "gdp_growth", "imports_gdp"]
PLACEBO_REGS = ["placebo_interaction", "high_energy_dependence", "placebo_post", "gas_import_shock_lag1",
                "gdp_growth", "imports_gdp"]


@query
def robustness_grid(spark, sf):
    from panelforge.plans import report
    rows = report.coef_rows(spark, [((c, v), f) for c, v, f in _robustness_fits(spark, sf)])
    return _round_doubles(rows.select(F.col("label0").alias("check"), "variable", "coef", F.col("p").alias("p_value"), F.col("nobs").cast("double").alias("nobs")))


@query
def robustness_coefs(spark, sf):
    """The robustness checks' coefficient, clustered SE and sample size of the
    reported variable."""
    from panelforge.plans.regression import _f
    rows = [(c, v, _f(f.coef.get(v)), _f(f.se.get(v)), int(f.nobs)) for c, v, f in _robustness_fits(spark, sf)]
    return _round_doubles(spark.createDataFrame(
        rows, "check string, variable string, coef double, se double, nobs long"))


# ---------------------------------------------------------------- stage compositions

def _dated_orders(spark, sf):
    od = read_table(spark, sf, "orders")
    return od.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("TIME_PERIOD"), "o_totalprice",
                     F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("fetched_at_utc"))


@query
def date_columns_standardize(spark, sf):
    from panelforge.operators import dates
    out, _ = dates.standardize_date_columns(_dated_orders(spark, sf))
    return out


@query
def date_harmonize(spark, sf):
    from panelforge.operators import dates
    std, _ = dates.standardize_date_columns(_dated_orders(spark, sf))
    out, _ = dates.harmonize_date_column(std)
    return out


def _merged_union(spark, sf):
    """Documents, orders and events by name; events without a value or type of note are null throughout."""
    from panelforge.operators import reshape
    docs = read_table(spark, sf, "documents").select("lang", "source")
    od = read_table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority")
    told = F.col("event_type").isin("click", "purchase")
    ev = read_table(spark, sf, "events").select(F.when(told, F.col("event_type")).alias("event_type"), F.when(told, F.floor("value")).alias("event_value"),
                                                F.lit(None).cast("string").alias("obs_status"))
    return reshape.union_by_name([docs, od, ev])


@query
def final_panel_merge(spark, sf):
    from panelforge.plans.pipeline_stages import final_panel
    return final_panel(_merged_union(spark, sf))[0]


@query
def final_panel_audit(spark, sf):
    from panelforge.plans.pipeline_stages import final_panel, panel_audit
    return panel_audit(spark, final_panel(_merged_union(spark, sf))[1])


# ---------------------------------------------------------------- landing: files written from the tables and read back

@query
def csv_typed(spark, sf):
    """Typed scan of two CSV datasets whose columns stand in different orders; 'NA' and empty text are null, a price
    that is no number as well, and a column that the files lack."""
    from panelforge.sources import read_typed_csv, write_table
    od = read_table(spark, sf, "orders")
    d = od.select("o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") == "P", F.lit("NA")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
                  F.when(F.pmod("o_orderkey", F.lit(10)) == 3, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
                  F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), F.concat(F.lit('says "'), "o_orderpriority", F.lit('", often')).alias("o_note"))
    even = F.pmod("o_orderkey", F.lit(2)) == 0
    top = scratch_path(spark, "typed")
    write_table(d.where(even), f"{top}/even.csv", fmt="csv")
    write_table(d.where(~even).select(*reversed(d.columns)), f"{top}/odd.csv", fmt="csv")
    out = read_typed_csv(spark, [f"{top}/even.csv", f"{top}/odd.csv"], "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                                                                       "o_orderdate date, o_note string, o_closed int", null_tokens=("", "NA"))
    return _round_doubles(out)


def _landed_lines(spark, sf):
    """A CSV dataset of orders in which each tenth line lacks a field and each next one has one too many."""
    od = read_table(spark, sf, "orders")
    k = F.pmod("o_orderkey", F.lit(10))
    part = [F.col(c).cast("string") for c in ("o_orderkey", "o_custkey", "o_orderstatus")]
    line = F.when(k == 0, F.concat_ws(",", *part[:2])).when(k == 1, F.concat_ws(",", *part, F.lit("more"))).otherwise(F.concat_ws(",", *part))
    path = scratch_path(spark, "lenient")
    # the lines as they are: neither separator nor quote of this writer occurs in them
    od.select(line.alias("o_orderkey,o_custkey,o_orderstatus")).write.options(header=True, sep="\x01", quote="\x02").csv(path)
    return path


@query
def csv_lenient(spark, sf):
    from panelforge.sources import read_lenient_csv
    return read_lenient_csv(spark, _landed_lines(spark, sf))


@query
def csv_rejects(spark, sf):
    """Rows read, rejected and delivered, counted by the scan that delivers (and here writes) the rows."""
    from pyspark.sql import Observation
    from panelforge.sources import read_lenient_csv, write_table
    seen = Observation("lenient")
    out = scratch_path(spark, "accepted")
    write_table(read_lenient_csv(spark, _landed_lines(spark, sf), counts=seen), out)
    row = (seen.get["rows_read"], seen.get["rows_rejected"], spark.read.parquet(out).count())
    return spark.createDataFrame([row], "rows_read bigint, rows_rejected bigint, rows_delivered bigint")


@query
def provenance_scan(spark, sf):
    """Yearly CSV datasets in one scan, rows tagged with year and source group."""
    from panelforge.sources import read_with_provenance, write_table
    od = read_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("yr"))
    top = scratch_path(spark, "yearly")
    write_table(od, top, fmt="csv", partition_by=["yr"])
    return read_with_provenance(spark, f"{top}/yr=*", "orders_yearly")


def _stage(spark, sf):
    """A stage directory of datasets with the names and columns of the rule table, and one that is left out."""
    from panelforge.sources import write_table
    top = scratch_path(spark, "stage")
    ms = _monthly_series(spark, sf)
    write_table(ms.select(F.date_format("month", "yyyy-MM-dd").alias("date"), F.when(F.month("month") != 5, F.col("revenue")).alias("cpi_all_items"),
                          F.col("discount").alias("policy_rate"), F.col("quantity").alias("industrial_production")), f"{top}/fred_macro_raw.csv", fmt="csv")
    li = read_table(spark, sf, "lineitem")
    write_table(li.select(F.col("l_returnflag").alias("REF_AREA"), F.date_format("l_shipdate", "yyyy-MM").alias("TIME_PERIOD"), F.col("l_linestatus").alias("ENERGY_PRODUCT"),
                          F.col("l_linenumber").alias("FLOW_BREAKDOWN"), F.lit("KTOE").alias("UNIT_MEASURE"),
                          F.when(F.col("l_quantity") > 2, F.pow("l_quantity", F.lit(6))).alias("OBS_VALUE")), f"{top}/staging_world_newformat.csv", fmt="csv")
    ev = read_table(spark, sf, "events")
    write_table(ev.select(F.col("event_type").alias("indicator_id"), F.col("user_id").alias("country_iso3"), F.year("ts").alias("year"), "value"),
                f"{top}/world_bank_wdi_raw.csv", fmt="csv")
    write_table(ev.select("event_id").limit(1), f"{top}/notes.csv", fmt="csv")
    return top


@query
def stage_audit(spark, sf):
    """Clean a stage directory by the rule table (every branch with its own columns); the run summary, read back."""
    from panelforge.plans.pipeline_stages import clean_stage
    out = scratch_path(spark, "cleaned")
    clean_stage(spark, _stage(spark, sf), out, exclude=["notes.csv"])
    return _audit_text(spark.read.schema(clean.AUDIT_SCHEMA).json(f"{out}/cleaning_summary"))


@query
def dataset_fingerprint(spark, sf):
    """Fingerprints of two tables from those of their parts: whole rows, and the key columns alone."""
    from panelforge.sources import fingerprint_parts, merge_fingerprints
    od = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    doc = read_table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return merge_fingerprints(fingerprint_parts(od, "orders", {"all": od.columns, "key": ["o_orderkey"]}, by="o_orderstatus"),
                              fingerprint_parts(doc, "documents", {"all": doc.columns, "key": ["doc_id"]}, by="lang"))


@query
def dictionary_datasets(spark, sf):
    listing = dictionary_listing(spark, sf)
    return listing.groupBy("dataset").agg(F.min_by("source", "variable").alias("source"),
                                          F.max("rows_total").alias("rows_total")).orderBy("dataset")


@query
def distinct_keys(spark, sf):
    from panelforge.operators import profile
    return profile.distinct_sorted(read_table(spark, sf, "events"), ["event_type"])


def _sparse_union(spark, sf):
    from panelforge.operators import reshape
    ev = read_table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM").alias("time_period"), F.col("user_id").cast("string").alias("ref_area"),
        F.col("event_type").alias("flow_breakdown"), F.col("value").cast("string").alias("obs_value"),
        F.lit("units").alias("unit_measure"))
    od = read_table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        (F.col("o_totalprice") / 1000).alias("cpi_all_items"),
        F.when(F.col("o_orderstatus") != "F", F.length("o_orderpriority").cast("double")).alias("policy_rate"),
        F.col("o_custkey").cast("double").alias("industrial_production"))
    return reshape.union_by_name([od, ev])


@query
def energy_block(spark, sf):
    from panelforge.plans.pipeline_stages import analysis_blocks
    _, energy = analysis_blocks(_sparse_union(spark, sf))
    return energy


@query
def macro_block(spark, sf):
    from panelforge.plans.pipeline_stages import analysis_blocks
    macro, _ = analysis_blocks(_sparse_union(spark, sf))
    return _round_doubles(macro)


@query
def fe_two_way_monthly(spark, sf):
    """Two-way FE on nation x month (80 periods: absorbed by alternating
    projections); months without orders count as zero."""
    from pyspark.sql import types as T
    from panelforge.operators import timeseries
    from panelforge.plans import regression
    on = _orders_nation(spark, sf)
    nm = on.groupBy("nation", F.trunc(F.to_date("o_orderdate"), "month").alias("month")).agg(
        (F.sum("o_totalprice") / 1e6).alias("y"), (F.count(F.lit(1)).cast("double") / 100).alias("x1"),
        (F.count_if(F.col("o_orderstatus") == "F").cast("double") / 100).alias("x2"))
    panel = timeseries.densify_monthly(nm, "nation", "month", ["y", "x1", "x2"], span="global", fill=0.0)
    f = regression.fit_ols(panel, "y", ["x1", "x2"], entity="nation", time="month", cluster="nation")[None]
    df = _fit_rows(spark, f, extra={"nobs": (T.LongType(), lambda f: int(f.nobs)),
                                    "r2_within": (T.DoubleType(), lambda f: f.r2_within)})
    return _round_doubles(df)


@query
def iqr_fence_skewsafe(spark, sf):
    """The grouped fence through the refining (skew-safe) quantile strategy:
    same rows as ``iqr_fence_grouped``."""
    ev = read_table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return clean.iqr_fence(ev, ["value"], ["event_type"], method="refined")


@query
def json_pages(spark, sf):
    """Landed JSON pages ``[meta, [record, ...]]`` built from events (pages of
    500 consecutive ids, so no page grows with a hot user or day), flattened
    back into rows by the page flattener."""
    from panelforge.sources.json_pages import flatten_pages
    ev = read_table(spark, sf, "events")
    rec = F.struct(F.col("user_id").cast("string").alias("countryiso3code"),
                   F.struct(F.col("event_type").alias("value")).alias("country"),
                   F.date_format("ts", "yyyy").alias("date"), F.col("value").alias("value"),
                   F.lit(None).cast("string").alias("obs_status"), F.lit(None).cast("int").alias("decimal"))
    pages = ev.groupBy((F.col("event_id") / 500).cast("long").alias("page")).agg(
        F.collect_list(rec).alias("recs"))
    text = F.concat(F.lit("["), F.to_json(F.struct(F.col("page"), F.lit(1).alias("pages"))), F.lit(","),
                    F.to_json("recs"), F.lit("]"))
    flat = flatten_pages(pages.select(text.alias("body")), "body", "EV.VALUE", "Event value",
                         fetched_at=F.to_timestamp(F.lit("2024-01-01T00:00:00+00:00"),
                                                    "yyyy-MM-dd'T'HH:mm:ssXXX"))
    return flat.select("country_iso3", "country_name", "year", F.col("value").cast("double").alias("value"),
                       "obs_status", "decimal", "fetched_at_utc")


@query
def eda_summary(spark, sf):
    """EDA metrics as (metric, value) text: series correlation, best lag and
    its |corr|, the most frequent flows, how many entities have a defined
    flow correlation, and the row counts of the two analysis blocks."""
    from panelforge.operators import reshape, stats, timeseries
    from panelforge.plans import report
    ms = _monthly_series(spark, sf)
    c0 = stats.corr_matrix(ms, ["revenue", "discount"]).where("var1 = 'revenue' AND var2 = 'discount'").first()["corr"]
    best = timeseries.best_lag(timeseries.lag_corr_profile(ms, "revenue", "discount", "month")).first()
    ev = read_table(spark, sf, "events")
    top = [r["event_type"] for r in stats.topk_counts(ev, "event_type", 6).collect()]
    ev_day = ev.withColumn("day", F.to_date("ts"))
    m = reshape.pair_moments(ev_day, ["user_id", "day"], ["user_id"], "event_type", "error", "click", "value")
    n_groups = m.where(stats.corr_from_moments().isNotNull()).count()
    macro_rows = ms.count()
    energy_rows = ev.where(F.col("value").isNotNull()).count()
    six = lambda x: None if x is None else f"{float(round(x, 6)):.6f}"
    return report.notes(spark, [
        ("corr_revenue_discount", six(c0)), ("best_lag", best["best_lag"]),
        ("best_lag_abs_corr", six(abs(best["best_corr"]))), ("top_flows", ", ".join(top[:4])),
        ("group_corr_count", n_groups), ("macro_rows", macro_rows), ("energy_rows", energy_rows)])


def _coef_se_t(spark, fit, terms):
    from pyspark.sql import types as T
    from panelforge.plans.regression import _f
    rows = [(t, _f(fit.coef.get(t)), _f(fit.se.get(t)), _f(fit.tstat.get(t)), int(fit.nobs)) for t in terms]
    return _round_doubles(spark.createDataFrame(rows, T.StructType([
        T.StructField("variable", T.StringType()), T.StructField("coef", T.DoubleType()),
        T.StructField("se", T.DoubleType()), T.StructField("t", T.DoubleType()),
        T.StructField("nobs", T.LongType())])))


@query
def model_a_fit(spark, sf):
    """Two-way FE of inflation on the lagged shock, its interaction, GDP
    growth and imports, clustered by entity (panel scaling)."""
    fa, _ = _models(spark, sf)
    return _coef_se_t(spark, fa, MODEL_A_REGS)


@query
def model_b_fit(spark, sf):
    """Difference-in-differences with entity and year effects, clustered by
    entity (dummy-design scaling); the absorbed main effects are null."""
    _, fb = _models(spark, sf)
    return _coef_se_t(spark, fb, MODEL_B_REGS)
