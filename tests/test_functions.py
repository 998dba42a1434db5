from pyspark.sql import functions as F

from panelforge.functions import coerce, fmt, text, columns


def test_date_edges(spark):
    rows = ["2024-03-05", "2024-03", "2024/03/05", "2024/03", "2024-3-5", "20240305", "", None]
    df = spark.createDataFrame([(r,) for r in rows], "d string")
    got = [r[0] for r in df.select(coerce.standardize_date_text("d")).collect()]
    assert got == ["2024-03-05", "2024-03-01", "2024-03-05", "2024-03-01", "2024-03-05", None, None, None]


def test_year_and_timestamp_text(spark):
    df = spark.createDataFrame([(" 2020 ",), ("20",), ("2020-05",), ("2021-06-01T10:00:00+00:00",),
                                ("2021-06-01 23:59:59",), ("n/a",)], "d string")
    y = [r[0] for r in df.select(coerce.year_to_date_text("d")).collect()]
    assert y[:3] == ["2020-01-01", "20", "2020-05"]
    t = [r[0] for r in df.select(coerce.timestamp_to_date_text("d")).collect()]
    assert t[3:] == ["2021-06-01", "2021-06-01", "n/a"]


def test_to_double(spark):
    vals = ["-", "1.5", "NaN", " 2 ", "abc", "1e3", "1.5d", None, ".5", "2F", "0x1p3", "1e5d", "-inf",
            "Infinity", "+3", "1,5"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(coerce.to_double("v")).collect()]
    inf = float("inf")
    assert got == [None, 1.5, None, 2.0, None, 1000.0, None, None, 0.5, None, None, None, -inf, inf, 3.0, None]


def test_normalize_nulls_keeps_codes(spark):
    df = spark.createDataFrame([("NA",), ("",), ("US",)], "ref_area string")
    got = [r[0] for r in coerce.normalize_nulls(df).collect()]
    assert got == ["NA", None, "US"]


def test_stars_and_format(spark):
    df = spark.createDataFrame([(1.23456, 0.005, 0.1), (-0.5, 0.03, None), (2.0, 0.07, 0.2),
                                (0.1, 0.5, 0.3), (None, 0.01, 0.1), (1.0, None, 0.1)],
                               "c double, p double, se double")
    got = df.select(fmt.fmt_coef("c", "p"), fmt.fmt_se("se")).collect()
    assert [r[0] for r in got] == ["1.2346***", "-0.5000**", "2.0000*", "0.1000", "", ""]
    assert got[0][1] == "(0.1000)" and got[1][1] == ""


def test_text_helpers(spark):
    df = spark.createDataFrame([(" a|b ", "world_bank_wdi_raw.csv"), (None, "fred_macro.csv"),
                                ("x", "jodi_2019.csv")], "t string, n string")
    got = df.select(text.clean_text("t"), text.source_label("n"), text.file_year("n")).collect()
    assert [tuple(r) for r in got] == [("a\\|b", "World Bank WDI", ""), ("", "FRED", ""), ("x", "JODI", "2019")]


def test_lower_names_collision(spark):
    df = spark.createDataFrame([(1, 2)], "A int, a_ int").toDF("A", "a")
    import pytest
    with pytest.raises(ValueError):
        columns.lower_names(df)
    assert columns.resolve(["REF_AREA", "Value"], ["ref_area", "value", "x"]) == {"ref_area": "REF_AREA", "value": "Value"}


def test_offset_timestamp_date_is_utc_in_any_session_zone(spark):
    df = spark.createDataFrame([("2021-06-01T23:30:00-02:00",), ("2021-06-02T00:30:00+02:00",)], "d string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ["UTC", "America/Los_Angeles", "Asia/Tokyo"]:
            spark.conf.set("spark.sql.session.timeZone", tz)
            got = [r[0] for r in df.select(coerce.timestamp_to_date_text("d")).collect()]
            assert got == ["2021-06-02", "2021-06-01"], tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
