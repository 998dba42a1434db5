import pytest
from pyspark.sql import functions as F

from panelforge.operators import dedupe, profile, reshape


def test_union_edges(spark):
    a = spark.createDataFrame([(1, "x", None)], "id int, name string, empty string")
    b = spark.createDataFrame([(2.5, "y"), (2.5, "y")], "id double, other string")
    u = reshape.union_by_name([a, b])
    assert u.columns == ["id", "name", "empty", "other"]
    assert dict(u.dtypes)["id"] == "double"
    assert u.count() == 3
    assert reshape.union_by_name([a, b]).dropDuplicates().count() == 2


def test_pivot_and_series(spark):
    rows = [("A", 2020, "F", 1.0), ("A", 2020, "F", 3.0), ("A", 2020, "O", 5.0), ("B", 2021, "P", 7.0),
            (None, 2020, "F", 9.0)]
    df = spark.createDataFrame(rows, "k string, yr int, s string, v double")
    w = {(r.k, r.yr): (r.f, r.o, r.p) for r in
         reshape.pivot_mean(df, ["k", "yr"], "s", ["F", "O", "P"], "v", {"F": "f", "O": "o", "P": "p"}).collect()}
    assert w == {("A", 2020): (2.0, 5.0, None), ("B", 2021): (None, None, 7.0)}
    ev = spark.createDataFrame([("d1", "a", 1.0, 1), ("d1", "a", 2.0, 2), ("d2", "b", 3.0, 1)],
                               "day string, series string, v double, seq int")
    s = {r.day: (r.a, r.b) for r in reshape.assemble_series(ev, "day", "series", "v", ["a", "b"], "seq").collect()}
    assert s == {"d1": (2.0, None), "d2": (None, 3.0)}


def test_pair_moments_equal_explicit_pairs(spark):
    import numpy as np
    import pandas as pd
    from panelforge.operators import stats
    rng = np.random.default_rng(5)
    rows = []
    for u in range(4):
        for d in range(6):
            for f in ("e", "c"):
                for _ in range(int(rng.integers(0, 4))):
                    rows.append((u, d, f, float(rng.normal())))
    rows += [(9, 0, "e", 1.0), (9, 0, "c", 2.0), (9, 1, "e", 1.0), (9, 1, "c", 3.0)]   # constant side
    df = spark.createDataFrame(rows, "user long, day int, f string, v double")
    m = reshape.pair_moments(df, ["user", "day"], ["user"], "f", "e", "c", "v")
    got = {r.user: r.corr for r in m.select("user", stats.corr_from_moments().alias("corr")).collect()}
    pdf = pd.DataFrame(rows, columns=["user", "day", "f", "v"])
    pairs = pdf[pdf.f == "e"].merge(pdf[pdf.f == "c"], on=["user", "day"])
    want = pairs.groupby("user").apply(lambda g: g.v_x.corr(g.v_y), include_groups=False)
    for u, w in want.items():
        if pd.isna(w) or u == 9:
            assert got.get(u) is None
        else:
            assert got[u] == pytest.approx(w, abs=1e-9)
    cond = reshape.flow_pair(df.where("user = 9"), ["user", "day"], "f", "e", "c", "v", "a", "b").count()
    assert cond == 2


def test_crosswalk_edges(spark):
    ent = spark.createDataFrame([("NAM",), ("XKX",), ("WLD",)], "iso3 string")
    cw = spark.createDataFrame([("NAM", "NA"), ("DEU", "DE")], "iso3 string, iso2 string")
    got = {r.iso3: r.iso2 for r in reshape.lookup(ent, "iso3", cw, "iso3", "iso2", "iso2", {"XKX": "XK"}).collect()}
    assert got == {"NAM": "NA", "XKX": "XK", "WLD": None}


def test_semi_anti_and_dictionary(spark):
    df = spark.createDataFrame([(1, "a", None)], "k int, name string, extra double")
    prof = profile.column_profile(df, order_key="k")
    docs = spark.createDataFrame([("k", "Key", "src", "Key", "", "")],
                                 "variable string, description string, source string, category string, unit string, notes string")
    d = profile.data_dictionary(prof, docs).orderBy("position").collect()
    assert [r.variable for r in d] == ["k", "name", "extra"]
    assert d[0].description == "Key" and d[1].source == "Derived"
    keep, missing = reshape.semi_anti_split(prof, docs, "variable")
    assert [r.variable for r in keep.collect()] == ["k"] and missing.count() == 2


def test_profile_counts_examples_types(spark):
    rows = [(i, str(i) if i % 2 else None, "x" if i < 3 else "1") for i in range(1, 7)]
    df = spark.createDataFrame(rows, "k int, num string, mixed string")
    p = {r.variable: r for r in profile.column_profile(df, order_key="k").collect()}
    assert p["num"].non_null == 3 and p["num"].missing == 3 and p["num"].missing_pct == 50.0
    assert p["num"].dtype == "numeric" and p["mixed"].dtype == "string" and p["k"].dtype == "int"
    assert p["num"].example_values == "1; 3; 5"
    assert p["mixed"].example_values == "x; x; 1"
    dc = profile.duplicate_count(spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")).first()
    assert (dc.rows, dc.distinct_rows, dc.duplicates) == (3, 2, 1)


def test_content_dedupe(spark):
    df = spark.createDataFrame([(3, "same"), (1, "same"), (2, "other"), (9, "same")], "id long, body string")
    rep = sorted((r.kept, r.removed) for r in dedupe.content_duplicates(df, "id", "body").collect())
    assert rep == [(1, 3), (1, 9)]
    assert sorted(r.id for r in dedupe.dedupe_by_content(df, "id", "body").collect()) == [1, 2]
    assert dedupe.drop_exact_duplicates(df.select("body")).count() == 2


def test_lookup_fallback_takes_crosswalk_type(spark):
    ent = spark.createDataFrame([("DEU",), ("XKX",), ("BAD",)], "iso3 string")
    cw = spark.createDataFrame([("DEU", 276)], "iso3 string, num int")
    out = reshape.lookup(ent, "iso3", cw, "iso3", "num", "num", {"XKX": "412", "BAD": "not-a-number"})
    assert dict(out.dtypes)["num"] == "int"
    assert {r.iso3: r.num for r in out.collect()} == {"DEU": 276, "XKX": 412, "BAD": None}


def test_union_keeps_large_ids_and_decimals(spark):
    from decimal import Decimal
    a = spark.createDataFrame([(1, Decimal("1.25"))], "id int, v decimal(5,2)")
    b = spark.createDataFrame([(9007199254740993, 7)], "id bigint, v int")
    u = reshape.union_by_name([a, b])
    assert dict(u.dtypes) == {"id": "bigint", "v": "decimal(12,2)"}
    assert sorted((r.id, r.v) for r in u.collect()) == [(1, Decimal("1.25")), (9007199254740993, Decimal("7.00"))]


def test_lookups_with_repeated_keys_take_the_smallest(spark):
    ent = spark.createDataFrame([("A",), ("B",)], "k string")
    cw = spark.createDataFrame([("A", "z"), ("A", "y")], "code string, v string")
    assert {r.k: r.o for r in reshape.lookup(ent, "k", cw, "code", "v", "o").collect()} == {"A": "y", "B": None}
    got = reshape.lookup_with_default(ent, "k", cw, "code", {"v": "none"}).collect()
    assert sorted((r.k, r.v) for r in got) == [("A", "y"), ("B", "none")]


def test_examples_need_an_order(spark):
    import pytest
    with pytest.raises(ValueError):
        profile.column_profile(spark.createDataFrame([(1,)], "a int"))


def test_pair_moments_far_from_zero(spark):
    import numpy as np
    from panelforge.operators import stats
    rng = np.random.default_rng(11)
    rows = [(u, d, f, float(1e6 + rng.normal(0, 0.3))) for u in range(2) for d in range(12) for f in ("e", "c") for _ in range(3)]
    rows += [(5, d, f, 0.1) for d in range(7) for f in ("e", "c") for _ in range(3)]  # constant
    df = spark.createDataFrame(rows, "user long, day int, f string, v double")
    m = reshape.pair_moments(df, ["user", "day"], ["user"], "f", "e", "c", "v")
    got = {r.user: r.corr for r in m.select("user", stats.corr_from_moments().alias("corr")).collect()}
    for u in range(2):
        pairs = [(x, y) for a, d, f, x in rows for b, k, g, y in rows if a == b == u and d == k and (f, g) == ("e", "c")]
        x, y = np.array(pairs).T
        assert got[u] == pytest.approx(np.corrcoef(x - 1e6, y - 1e6)[0, 1], abs=1e-9)
    assert got[5] is None


def test_dictionary_without_source(spark):
    prof = spark.createDataFrame([("a", 0, "double", 3)], "variable string, position int, dtype string, non_null long")
    row = profile.data_dictionary(prof).first()
    assert (row.source, row.category, row.description) == ("Consolidated Data", "Data", "Variable included in final panel")
