import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelforge.operators import features, stats, timeseries


def test_growth_edges(spark):
    rows = [("a", 2000, 10.0), ("a", 2001, 0.0), ("a", 2003, 5.0), ("a", 2004, None), ("a", 2005, 4.0),
            ("b", 2000, 0.0), ("b", 2001, 0.0), ("c", 2000, 3.0)]
    df = spark.createDataFrame(rows, "entity string, year int, x double")
    g = features.pct_change(df, "entity", "year", "x", "g")
    g = features.pct_change(g, "entity", "year", "x", "gc", calendar=True)
    got = {(r.entity, r.year): (r.g, r.gc) for r in g.collect()}
    assert got[("a", 2001)] == (-100.0, -100.0)
    assert got[("a", 2003)] == (None, None)           # x / 0 -> null
    assert got[("a", 2004)] == (None, None) and got[("a", 2005)] == (None, None)
    assert got[("b", 2001)] == (None, None)           # 0 / 0
    assert got[("c", 2000)] == (None, None)
    lag = features.lags(g, "entity", "year", "g", [1, 2]).where("entity = 'a' AND year = 2003").first()
    assert lag.g_lag1 == -100.0 and lag.g_lag2 is None


def test_median_edges(spark):
    rows = [("a", 1.0), ("a", 3.0), ("b", 2.0), ("c", None), ("d", 10.0), ("d", 20.0)]
    df = spark.createDataFrame(rows, "entity string, s double")
    got = {r.entity: r.h for r in features.median_split(df, "entity", "s", "h").collect()}
    # medians a=2, b=2, d=15 -> median of medians 2 -> a, b exactly at it -> 1
    assert got == {"a": 1.0, "b": 1.0, "c": 0.0, "d": 1.0}
    got2 = {r.entity: r.h for r in features.median_split(df, "entity", "s", "h", method="sorted").collect()}
    assert got2 == got


def test_interpolate_matches_pandas(spark):
    vals = [None, 1.0, None, None, 4.0, 6.0, None, None]
    months = pd.date_range("2020-01-01", periods=len(vals), freq="MS")
    df = spark.createDataFrame([("k", m.date(), v) for m, v in zip(months, vals)], "key string, month date, x double")
    got = [r.x for r in timeseries.interpolate_linear(df, "key", "month", "x").orderBy("month").collect()]
    want = pd.Series(vals, dtype=float).interpolate().tolist()
    assert got[0] is None and np.allclose(got[1:], want[1:])


def test_densify(spark):
    import datetime as dt
    df = spark.createDataFrame([("k", dt.date(2020, 1, 15), 1.0), ("k", dt.date(2020, 4, 2), 2.0),
                                ("j", dt.date(2021, 6, 1), 3.0)], "key string, d date, x double")
    out = timeseries.densify_monthly(df, "key", "d", ["x"]).orderBy("key", "d").collect()
    assert [(r.key, str(r.d), r.x) for r in out] == [
        ("j", "2021-06-01", 3.0), ("k", "2020-01-01", 1.0), ("k", "2020-02-01", None),
        ("k", "2020-03-01", None), ("k", "2020-04-01", 2.0)]


def _np_decompose(x, period=12):
    n = len(x)
    filt = np.r_[0.5, np.ones(period - 1), 0.5] / period
    trend = np.full(n, np.nan)
    h = period // 2
    for t in range(h, n - h):
        trend[t] = np.dot(filt, x[t - h:t + h + 1])
    det = x - trend
    means = np.array([np.nanmean(det[i::period]) for i in range(period)])
    means -= means.mean()
    seasonal = np.tile(means, n // period + 1)[:n]
    return trend, seasonal, x - trend - seasonal


def test_seasonal_decompose_matches_numpy(spark):
    rng = np.random.default_rng(4)
    n = 40
    x = 10 + 0.1 * np.arange(n) + np.sin(np.arange(n) * 2 * np.pi / 12) + rng.normal(scale=0.1, size=n)
    months = pd.date_range("2019-01-01", periods=n, freq="MS")
    df = spark.createDataFrame([("s", m.date(), float(v)) for m, v in zip(months, x)], "key string, month date, x double")
    out = timeseries.seasonal_decompose(df, "key", "month", "x").orderBy("month").toPandas()
    trend, seasonal, resid = _np_decompose(x)
    assert np.allclose(out.trend.to_numpy(dtype=float), trend, equal_nan=True)
    assert np.allclose(out.seasonal.to_numpy(dtype=float), seasonal)
    assert np.allclose(out.resid.to_numpy(dtype=float), resid, equal_nan=True)
    # invariant: trend + seasonal + resid = series where the trend exists
    ok = ~np.isnan(trend)
    assert np.allclose((out.trend + out.seasonal + out.resid).to_numpy(dtype=float)[ok], x[ok])


def test_lag_profile_and_best_lag(spark):
    rng = np.random.default_rng(8)
    n = 60
    xv = rng.normal(size=n)
    yv = np.r_[np.zeros(2), xv[:-2]] + rng.normal(scale=0.1, size=n)
    months = pd.date_range("2015-01-01", periods=n, freq="MS")
    df = spark.createDataFrame([(m.date(), float(a), float(b)) for m, a, b in zip(months, yv, xv)],
                               "month date, y double, x double")
    prof = {r.lag: r.corr for r in timeseries.lag_corr_profile(df, "y", "x", "month").collect()}
    s = pd.Series(yv)
    for k in [0, 1, 2, 3, 6, 12]:
        assert prof[k] == pytest.approx(s.corr(pd.Series(xv).shift(k)), abs=1e-9)
    best = timeseries.best_lag(timeseries.lag_corr_profile(df, "y", "x", "month")).first()
    assert best.best_lag == 2


def test_corr_edges(spark):
    rows = [("const", 1.0, 2.0), ("const", 1.0, 3.0), ("one", 1.0, 1.0), ("nulls", None, 1.0),
            ("nulls", 2.0, None), ("nulls", 1.0, 2.0), ("nulls", 2.0, 4.0), ("nulls", 3.0, 5.0)]
    df = spark.createDataFrame(rows, "g string, a double, b double")
    got = {r.g: r.corr for r in stats.grouped_corr(df, "g", "a", "b", drop_undefined=False).collect()}
    assert got["const"] is None and got["one"] is None
    assert got["nulls"] == pytest.approx(pd.Series([1.0, 2, 3]).corr(pd.Series([2.0, 4, 5])))
    assert set(r.g for r in stats.grouped_corr(df, "g", "a", "b").collect()) == {"nulls"}


def test_boxplot_matches_bruteforce(spark):
    rng = np.random.default_rng(2)
    v = np.r_[rng.normal(size=200), [8.0, -9.0, 12.0]]
    df = spark.createDataFrame([("g", float(x)) for x in v], "g string, v double")
    r = stats.boxplot_stats(df, "g", "v").first()
    q1, med, q3 = np.percentile(v, [25, 50, 75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert (r.q1, r.median, r.q3) == pytest.approx((q1, med, q3))
    assert r.whisker_low == pytest.approx(v[v >= lo].min()) and r.whisker_high == pytest.approx(v[v <= hi].max())
    assert r.n_outliers == int(((v < lo) | (v > hi)).sum())


def test_corr_matrix_and_regression_line(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.normal(size=(50, 3)), columns=["a", "b", "c"])
    df = spark.createDataFrame(pdf)
    m = {(r.var1, r.var2): r.corr for r in stats.corr_matrix(df, ["a", "b", "c"]).collect()}
    want = pdf.corr()
    for (i, j), c in m.items():
        assert c == pytest.approx(want.loc[i, j], abs=1e-12)
    line = stats.regression_line(df, "a", "b").first()
    slope, intercept = np.polyfit(pdf.a, pdf.b, 1)
    assert (line.slope, line.intercept) == pytest.approx((slope, intercept))
