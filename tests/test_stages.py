import os

from panelforge.operators import dates
from panelforge.plans.pipeline_stages import analysis_blocks, clean_stage, final_panel


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def test_clean_stage_with_summary(spark, tmpdir_fresh):
    raw = os.path.join(tmpdir_fresh, "raw")
    os.makedirs(raw)
    _write(os.path.join(raw, "fred_macro_raw.csv"),
           "date,cpi_all_items,policy_rate,industrial_production\n"
           + "".join(f"2020-{m:02d}-01,{100 + m},{1 + m / 10},{90 + m}\n" for m in range(1, 13))
           + "2021-01-01,,2.0,95\n2021-02-01,113,2.0,9000\n")
    _write(os.path.join(raw, "world_bank_wdi_raw.csv"),
           "indicator_id,country_iso3,year,value\nA,DEU,2020,1\nA,DEU,2021,2\nA,FRA,2020,3\nA,FRA,2021,4\n"
           "A,ITA,2020,500\nB,DEU,2020,\n")
    _write(os.path.join(raw, "skip_me.csv"), "x\n1\n")
    out = os.path.join(tmpdir_fresh, "cleaned")
    audits = {r.source_name: r for r in clean_stage(spark, raw, out, exclude=["skip_me.csv"]).collect()}
    fred = audits["fred_macro_raw.csv"]
    assert (fred.rows_in, fred.rows_after_required, fred.rows_after_outliers) == (14, 13, 12)
    wdi = audits["world_bank_wdi_raw.csv"]
    assert (wdi.rows_in, wdi.rows_after_required, wdi.rows_after_outliers) == (6, 5, 4)
    assert wdi.group_columns == ["indicator_id"]
    assert spark.read.parquet(os.path.join(out, "fred_macro_raw_cleaned")).count() == 12
    assert spark.read.json(os.path.join(out, "cleaning_summary")).count() == 2


def test_harmonize_and_final_panel(spark):
    df = spark.createDataFrame([("2020", "x", "2021-01-01T00:00:00+00:00")], "Year string, v string, fetched_at_utc string")
    std, changed = dates.standardize_date_columns(df)
    assert changed == ["Year", "fetched_at_utc"]
    out, log = dates.harmonize_date_column(std)
    assert out.columns == ["date", "v", "fetched_date"] and out.first().date == "2020-01-01"
    assert log == ["Year->date", "fetched_at_utc->fetched_date"]
    u = spark.createDataFrame([(2, None, None), (1, "a", None), (None, None, None), (1, "a", None), (None, "b", None)],
                              "a int, b string, c string")
    panel, meta = final_panel(u)
    assert panel.columns == ["a", "b"]
    assert [tuple(r) for r in panel.collect()] == [(1, "a"), (2, None), (None, "b")]
    assert meta["dropped_all_null_rows"] == 1 and meta["duplicates_removed"] == 1 and meta["empty_columns"] == ["c"]


def test_analysis_blocks(spark):
    from panelforge.operators import reshape
    macro = spark.createDataFrame([("2020-01-01", 1.0, 2.0, 3.0), ("2020-02-01", None, 2.0, 3.0)],
                                  "date string, cpi_all_items double, policy_rate double, industrial_production double")
    energy = spark.createDataFrame([("2020-01", "DE", "TOTIMPSB", "5", "M3"), ("2020-02", "DE", "TOTIMPSB", "-", "M3")],
                                   "time_period string, ref_area string, flow_breakdown string, obs_value string, unit_measure string")
    m, e = analysis_blocks(reshape.union_by_name([macro, energy]))
    assert m.count() == 1 and e.count() == 1 and str(e.first().time) == "2020-01-01"
