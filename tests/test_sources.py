import json
import os

from pyspark.sql import functions as F

from panelforge.sources import (dataset_fingerprint, file_duplicates, flatten_pages, list_datasets,
                                read_lenient_csv, read_typed_csv, read_with_provenance, scan_stage_dir,
                                write_run_summary, write_table)


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def test_typed_csv_keeps_na_code(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "energy.csv")
    _write(p, "REF_AREA,OBS_VALUE\nNA,1.5\n,2\nUS,abc\n")
    df = read_typed_csv(spark, p, "REF_AREA string, OBS_VALUE double")
    assert [tuple(r) for r in df.collect()] == [("NA", 1.5), (None, 2.0), ("US", None)]
    df2 = read_typed_csv(spark, p, "REF_AREA string, OBS_VALUE double", null_tokens=["", "NA"])
    assert df2.first()[0] is None


def test_lenient_csv_skips_malformed(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "raw.csv")
    _write(p, "a,b\n1,2\n3\n4,5,6\n7,8\n")
    df = read_lenient_csv(spark, p)
    assert dict(df.dtypes) == {"a": "string", "b": "string"}
    assert [tuple(r) for r in df.collect()] == [("1", "2"), ("7", "8")]
    rows = read_lenient_csv(spark, p, keep_rejects=True).collect()
    assert sum(r["_corrupt_record"] is not None for r in rows) == 2


def test_provenance_scan_and_listing(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "yearly")
    os.makedirs(d)
    _write(os.path.join(d, "2019.csv"), "x\n1\n2\n")
    _write(os.path.join(d, "2020.csv"), "x\n3\n")
    _write(os.path.join(d, "notes.txt"), "skip")
    df = read_with_provenance(spark, os.path.join(d, "*.csv"), "oil_world")
    got = sorted((r.x, r.SOURCE_FILE_YEAR, r.SOURCE_GROUP) for r in df.collect())
    assert got == [("1", "2019", "oil_world"), ("2", "2019", "oil_world"), ("3", "2020", "oil_world")]
    names = [p.rsplit("/", 1)[-1] for p in list_datasets(spark, d, exclude=["2020.csv"])]
    assert names == ["2019.csv"]
    assert sorted(scan_stage_dir(spark, d)) == ["2019.csv", "2020.csv"]


def test_json_pages(spark):
    page = json.dumps([{"page": 1, "pages": 1},
                       [{"countryiso3code": "DEU", "country": {"value": "Germany"}, "date": "2020", "value": 1.5,
                         "obs_status": "", "decimal": 1},
                        {"countryiso3code": "", "country": {"value": "World"}, "date": "2020", "value": None,
                         "obs_status": None, "decimal": None}]])
    pages = spark.createDataFrame([(page,), (json.dumps([{"page": 1, "pages": 0}, None]),)], "body string")
    rows = flatten_pages(pages, "body", "FP.CPI.TOTL.ZG", "Inflation").collect()
    assert len(rows) == 2
    assert (rows[0].country_iso3, rows[0].country_name, rows[0].year, rows[0].value) == ("DEU", "Germany", "2020", "1.5")
    assert (rows[1].country_iso3, rows[1].value, rows[1].decimal) == ("", "", "")
    assert rows[0].fetched_at_utc.endswith("+00:00")


def test_file_duplicates_fingerprint_and_sinks(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "cleaned")
    os.makedirs(d)
    for name, body in [("a.csv", "x\n1\n"), ("b.csv", "x\n1\n"), ("c.csv", "x\n2\n")]:
        _write(os.path.join(d, name), body)
    dups = [(r.kept, r.removed) for r in file_duplicates(spark, d).collect()]
    assert dups == [("a.csv", "b.csv")]
    t1 = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    t2 = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string")
    assert dataset_fingerprint(t1, "t").first().fingerprint == dataset_fingerprint(t2, "t").first().fingerprint
    out = os.path.join(tmpdir_fresh, "out")
    write_table(t1, out, partition_by=["v"])
    assert spark.read.parquet(out).count() == 2
    write_run_summary(spark.createDataFrame([("t", 2)], "source string, rows long"), os.path.join(tmpdir_fresh, "sum"))
    assert spark.read.json(os.path.join(tmpdir_fresh, "sum")).first().rows == 2


def test_streaming_landing(spark, tmpdir_fresh):
    from pyspark.sql import types as T
    from panelforge.streaming import land_stream
    landing = os.path.join(tmpdir_fresh, "landing")
    os.makedirs(landing)
    _write(os.path.join(landing, "part1.csv"), "ref_area,obs_value\nDE,1.5\n,2\nFR,-\n")
    schema = T.StructType([T.StructField("ref_area", T.StringType()), T.StructField("obs_value", T.StringType())])
    q = land_stream(spark, landing, schema, os.path.join(tmpdir_fresh, "landed"), os.path.join(tmpdir_fresh, "ck"),
                    required=["ref_area"], numeric=["obs_value"], group_tag="jodi")
    q.awaitTermination(120)
    got = sorted((r.ref_area, r.obs_value, r.source_file) for r in spark.read.parquet(os.path.join(tmpdir_fresh, "landed")).collect())
    assert got == [("DE", 1.5, "part1.csv"), ("FR", None, "part1.csv")]


def test_size_shuffles(spark, tmpdir_fresh):
    from panelforge.session import input_bytes, size_shuffles
    p = os.path.join(tmpdir_fresh, "f.csv")
    _write(p, "x\n" + "1\n" * 1000)
    assert input_bytes(spark, p) == 2002
    keys = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.files.maxPartitionBytes"]
    old = {k: spark.conf.get(k) for k in keys}
    try:
        assert size_shuffles(spark, p, target_bytes=100) == 21
        assert size_shuffles(spark, p, target_bytes=10**9) == spark.sparkContext.defaultParallelism
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_csv_doubled_quotes_and_reordered_headers(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "q")
    os.makedirs(d)
    _write(os.path.join(d, "2019.csv"), 'x,y\n"He said ""hi"", ok",1\n')
    _write(os.path.join(d, "2020.csv"), "y,x,z\n2,b,9\n")
    want = [('He said "hi", ok', "1"), ("b", "2")]
    assert sorted((r.x, r.y) for r in read_lenient_csv(spark, d).collect()) == want
    tagged = read_with_provenance(spark, os.path.join(d, "*.csv"), "g").collect()
    assert sorted((r.x, r.y, r.z, r.SOURCE_FILE_YEAR) for r in tagged) == [(*want[0], None, "2019"), (*want[1], "9", "2020")]
    typed = read_typed_csv(spark, d, "y int, x string, w double").collect()
    assert sorted((r.x, r.y, r.w) for r in typed) == [(want[0][0], 1, None), ("b", 2, None)]
    out = os.path.join(tmpdir_fresh, "back")
    write_table(spark.createDataFrame([('a "b", c', 1)], "t string, k int"), out, fmt="csv")
    assert [r.t for r in read_typed_csv(spark, out, "t string, k int").collect()] == ['a "b", c']


def test_fingerprint_sees_where_nulls_are(spark):
    a = spark.createDataFrame([("a", None)], "x string, y string")
    b = spark.createDataFrame([(None, "a")], "x string, y string")
    assert dataset_fingerprint(a, "t").first().fingerprint != dataset_fingerprint(b, "t").first().fingerprint
