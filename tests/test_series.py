"""Windows over series cut into blocks give the rows of plain windows, whatever the cut."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelforge.operators import features, series, timeseries


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(21)
    out = []
    for key, n in (("a", 900), ("b", 1), ("c", 40), (None, 60), ("d", 0)):
        at = np.sort(rng.choice(5000, n, replace=False))
        for t in at:
            out.append((key, int(t), None if rng.random() < 0.4 else float(rng.normal()), float(rng.normal())))
    out += [("e", i, None, 1.0) for i in range(30)] + [("f", i, 1.5 if i == 11 else None, 2.0) for i in range(200)]
    return spark.createDataFrame(out, "k string, t int, v double, w double").repartition(7).cache()


def _same(a, b):
    a, b = (x.toPandas() for x in (a, b))
    cols = list(a.columns)
    assert cols == list(b.columns)
    a, b = (x.sort_values(["k", "t"], na_position="first").reset_index(drop=True) if "k" in cols else x.sort_values("t").reset_index(drop=True) for x in (a, b))
    pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("key", ["k", None])
@pytest.mark.parametrize("parts", [3, 16])
def test_blocks_equal_whole(spark, rows, key, parts):
    df = rows if key else rows.where("k = 'a'").drop("k")

    def make(w, position):
        return {"p": position, "l1": F.lag("v", 1).over(w), "l40": F.lag("w", 40).over(w), "ahead": F.lead("v", 3).over(w),
                "m": F.avg("v").over(w.rowsBetween(-5, 3)), "n": F.count("v").over(w.rowsBetween(-40, 0))}

    _same(series.over_series(df, key, "t", make, 40, 3, cut="blocks", parts=parts), series.over_series(df, key, "t", make, 40, 3, cut="whole"))
    _same(series.around_known(df, key, "t", "v", cut="blocks", parts=parts), series.around_known(df, key, "t", "v", cut="whole"))


def test_halo_reaches_over_many_small_blocks(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(40)], "t int, v double")
    out = series.over_series(df, None, "t", lambda w, p: {"p": p, "back": F.lag("v", 17).over(w), "on": F.lead("v", 9).over(w)}, 17, 9, cut="blocks", parts=16)
    for r in out.collect():
        assert r.p == r.t and r.back == (r.t - 17 if r.t >= 17 else None) and r.on == (r.t + 9 if r.t + 9 < 40 else None)


def test_one_keyless_series_is_many_tasks(spark):
    n = 20_000
    df = spark.range(n, numPartitions=6).select(F.col("id").alias("t"), F.when(F.col("id") % 997 == 3, F.col("id") * 2.0).alias("v"))
    out = series.around_known(df, None, "t", "v", cut="blocks", parts=12).withColumn("task", F.spark_partition_id())
    tasks = [r["count"] for r in out.groupBy("task").count().collect()]
    assert len(series._blocks(df, [], "t", 12)[1].collect()) >= 8 and max(tasks) < n
    got = timeseries.interpolate_linear(df, None, "t", "v", out="y", cut="blocks").toPandas().sort_values("t")
    s = pd.Series([2.0 * i if i % 997 == 3 else np.nan for i in range(n)]).interpolate()
    np.testing.assert_allclose(got["y"].to_numpy(), s.to_numpy())


def test_operators_on_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(series, "WHOLE_ROWS", 25)  # 'auto' cuts all but the short ones
    d = rows.where("k is not null")
    for f in (lambda cut: timeseries.shift(d, "v", -2, "t", "k", cut=cut), lambda cut: timeseries.interpolate_linear(d, "k", "t", "v", cut=cut),
              lambda cut: timeseries.seasonal_decompose(d.na.fill(0.5), "k", "t", "v", 6, cut=cut), lambda cut: timeseries.seasonal_decompose(d.na.fill(0.5), "k", "t", "v", 7, cut=cut),
              lambda cut: features.lags(d, "k", "t", "v", [1, 2, 3], cut=cut), lambda cut: features.pct_change(d, "k", "t", "w", "g", calendar=True, cut=cut)):
        _same(f("auto"), f("whole"))
    a, b = (timeseries.lag_corr_profile(d, "v", "w", "t", key="k", cut=c).orderBy("k", "lag").toPandas() for c in ("blocks", "whole"))
    pd.testing.assert_frame_equal(a, b, rtol=1e-9)


def test_empty_series(spark):
    none = spark.createDataFrame([], "k string, t int, v double")
    for cut in ("whole", "blocks"):
        assert timeseries.interpolate_linear(none, "k", "t", "v", cut=cut).count() == 0
        assert timeseries.shift(none, "v", 1, "t", cut=cut).count() == 0
