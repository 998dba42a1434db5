"""Tail probabilities as column expressions against the scalar ones and published values."""

import math

import pytest
from pyspark.sql import functions as F

from panelforge.functions import tails as columns
from panelforge.plans import tails


def test_log_gamma(spark):
    xs = [0.1, 0.5, 1.0, 2.5, 10.0, 170.3, 1e6]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(columns.log_gamma("x").alias("g")).collect()
    assert [r.g for r in got] == pytest.approx([math.lgamma(x) for x in xs], rel=1e-12, abs=1e-12)


def test_against_scalars(spark):
    rows = [(t, df) for t in (0.0, 0.3, -1.5, 2.0, 4.5, 40.0) for df in (1.0, 3.0, 10.0, 127.0, 5000.0, 1e7)]
    out = spark.createDataFrame(rows, "t double, df double").select("t", "df", columns.t_two_sided("t", "df").alias("p"), columns.normal_two_sided("t").alias("z"),
                                                                   columns.chi2_upper(F.abs("t") * 4, "df").alias("c"), columns.f_upper(F.abs("t"), F.lit(4.0), "df").alias("f"))
    for r in out.collect():
        assert r.p == pytest.approx(tails.t_two_sided(r.t, r.df), rel=1e-7, abs=1e-12)
        assert r.z == pytest.approx(tails.norm_two_sided(r.t), rel=1e-9, abs=1e-14)
        assert r.c == pytest.approx(tails.chi2_sf(abs(r.t) * 4, r.df), rel=1e-7, abs=1e-12)
        assert r.f == pytest.approx(tails.f_sf(abs(r.t), 4.0, r.df), rel=1e-7, abs=1e-12)


def test_published_values_and_missing(spark):
    one = spark.range(1).select(columns.chi2_upper(F.lit(6.59703), F.lit(4.0)).alias("c"), columns.f_upper(F.lit(1.65548), F.lit(4.0), F.lit(425.0)).alias("f"),
                                columns.t_two_sided(F.lit(2.0), F.lit(10.0)).alias("t"), columns.normal_two_sided(F.lit(1.959963984540054)).alias("n"),
                                columns.t_two_sided(F.lit(None).cast("double"), F.lit(10.0)).alias("a"), columns.t_two_sided(F.lit(1.0), F.lit(0.0)).alias("b"),
                                columns.normal_two_sided(F.lit(float("nan"))).alias("d")).first()
    assert (one.c, one.f, one.t, one.n) == (pytest.approx(0.158778, abs=1e-6), pytest.approx(0.159434, abs=1e-6), pytest.approx(0.0733880, abs=1e-7), pytest.approx(0.05, abs=1e-12))
    assert one.a is None and one.b is None and one.d is None
