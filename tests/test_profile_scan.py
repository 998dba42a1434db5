"""Profiles with examples read the table once and merge bounded parts."""

import datetime

import numpy as np

from panelforge.operators import profile


def _frame(spark, n=500, parts=9):
    rng = np.random.default_rng(41)
    rows = []
    for i in range(n):
        rows.append((int(rng.integers(0, 60)), None if rng.random() < 0.7 else f"v{rng.integers(0, 9)}", None if i % 3 else str(i), float(i) if i % 7 else None,
                     datetime.date(2020, 1, 1) + datetime.timedelta(days=i), None, [i], i % 2 == 0))
    return spark.createDataFrame(rows, "k int, a string, num string, x double, d date, none string, arr array<int>, b boolean").repartition(parts), rows


def test_examples_and_counts_against_brute_force(spark):
    df, rows = _frame(spark)
    got = {r.variable: r for r in profile.column_profile(df, "k", 4).collect()}
    for i, c in enumerate(df.columns):
        r = got[c]
        there = sorted(((x[0], x[i]) for x in rows if x[i] is not None), key=lambda t: (t[0], str(t[1]) if c == "arr" else t[1]))[:4]
        text = {"x": lambda v: str(v), "d": str, "arr": str, "b": lambda v: str(v).lower()}.get(c, str)
        assert (r.rows_total, r.non_null, r.missing) == (500, sum(x[i] is not None for x in rows), sum(x[i] is None for x in rows))
        assert r.example_values == "; ".join(text(v) for _, v in there), c
    assert got["num"].dtype == "numeric" and got["a"].dtype == "string" and got["none"].example_values == ""


def test_one_scan(spark, tmp_path):
    df, _ = _frame(spark)
    df.drop("arr").write.parquet(str(tmp_path / "t"))
    plan = profile.column_profile(spark.read.parquet(str(tmp_path / "t")), "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 or plan.split("Initial Plan")[-1].count("FileScan parquet") == 1


def test_several_keys_ties_and_empty(spark):
    df = spark.createDataFrame([(1, "b", "q"), (1, "a", "z"), (None, "c", "n"), (1, "a", "y"), (1, "a", None)], "k int, j string, v string")
    r = {x.variable: x.example_values for x in profile.example_values(df, ["k", "j"], 3).collect()}
    assert r["v"] == "n; y; z" and r["k"] == "1; 1; 1"
    none = profile.column_profile(df.limit(0), "k").collect()
    assert [(x.variable, x.rows_total, x.missing_pct, x.example_values) for x in none] == [(c, 0, None, "") for c in ("k", "j", "v")]
