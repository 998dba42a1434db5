import datetime as dt

from pyspark.sql import functions as F

from panelforge.operators import features, reshape, timeseries
from panelforge.plans import report
from panelforge.plans.regression import Fit
from panelforge.sources import sql_over


def _fit(coef, se, p, nobs=10, r2=None):
    return Fit(terms=list(coef), coef=coef, se=se, tstat={k: None for k in coef}, pvalue=p, nobs=nobs, r2=r2)


def test_comparison_and_publication_rows(spark):
    a = _fit({"x": 1.23456, "z": -0.5}, {"x": 0.1, "z": 0.2}, {"x": 0.004, "z": 0.2}, nobs=100)
    b = _fit({"x": 2.0, "w": None}, {"x": 1.0, "w": None}, {"x": 0.06, "w": None}, nobs=90)
    cmp = report.comparison_table(report.coef_table(spark, a, "a"), report.coef_table(spark, b, "b")).collect()
    assert [r.variable for r in cmp] == ["w", "x", "z"]
    assert cmp[1].coef_a_fmt == "1.2346***" and cmp[1].coef_b_fmt == "2.0000*"
    assert cmp[0].coef_b_fmt == "" and cmp[2].coef_b is None
    rows = report.publication_rows(spark, {"m1": a, "m2": b}, ["x", "w"], {"x": "Term X"},
                                   [("Observations", ["100", "90"])]).collect()
    assert [(r.term, r.m1, r.m2) for r in rows] == [
        ("Term X", "1.2346***", "2.0000*"), ("", "(0.1000)", "(1.0000)"),
        ("w", "", ""), ("", "", ""), ("Observations", "100", "90")]
    notes = report.notes(spark, [("a", 1), ("b", None)]).collect()
    assert [(r.metric, r.value) for r in notes] == [("a", "1"), ("b", "")]


def test_position_order_shift_flags_sql(spark):
    df = spark.createDataFrame([("b",), ("zz",), ("a",)], "v string")
    got = [r.v for r in reshape.position_order(df, "v", ["a", "b"]).orderBy("_order", "v").collect()]
    assert got == ["a", "b", "zz"]
    s = spark.createDataFrame([(dt.date(2020, m, 1), float(m)) for m in (3, 1, 2)], "d date, x double")
    assert [r.x_shift1 for r in timeseries.shift(s, "x", 1, "d").orderBy("d").collect()] == [None, 1.0, 2.0]
    t = spark.createDataFrame([(2021, 1.0), (2022, 1.0), (None, 1.0), (2023, 0.0)], "year int, treat double")
    out = [(r.post, r.did) for r in features.treatment_flags(t, "year", 2022, "treat", "post", "did").collect()]
    assert out == [(0.0, 0.0), (1.0, 1.0), (0.0, 0.0), (1.0, 0.0)]
    got = sql_over(spark, {"pf_t": t}, "SELECT count(*) AS n FROM pf_t WHERE year IS NOT NULL").first().n
    assert got == 3
