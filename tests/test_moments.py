"""Matrix-product moments, the bootstrap band and mergeable fingerprints against numpy and pandas."""

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from panelforge.operators import moments
from panelforge.sources import fingerprint_parts, merge_fingerprints


def _frame(n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(1e6, 1, n)
    pdf = pd.DataFrame({"x": x, "y": 2 * x + rng.normal(0, 3, n), "z w": rng.random(n), "flat": 7.1, "none": np.nan})
    for c in ("x", "y", "z w", "flat"):
        pdf.loc[rng.random(n) < 0.3, c] = np.nan
    return pdf


def _spark_frame(spark, pdf, parts=5):
    rows = [[None if v != v else v for v in r] for r in pdf.to_numpy().tolist()]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in pdf.columns)).repartition(parts)


def test_pairwise_correlations_equal_pandas(spark):
    pdf = _frame()
    got = {(r["var1"], r["var2"]): r for r in moments.pairwise_corr_matrix(_spark_frame(spark, pdf), list(pdf.columns)).collect()}
    assert len(got) == 25
    for (a, b), r in got.items():
        both = pdf[[a]].assign(other=pdf[b]).dropna()
        assert r["n"] == len(both), (a, b)
        want = both[a].corr(both["other"]) if "flat" not in (a, b) and len(both) > 1 else None
        assert r["corr"] is None if want is None else math.isclose(r["corr"], want, abs_tol=1e-6), (a, b)


def test_pairwise_infinite_and_empty(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, float("inf")), (3.0, 6.5), (float("nan"), 1.0), (4.0, 7.0)], "a double, b double")
    got = {(r["var1"], r["var2"]): (r["n"], r["corr"]) for r in moments.pairwise_corr_matrix(df, ["a", "b"]).collect()}
    assert got[("a", "b")][0] == 3 and math.isclose(got[("a", "b")][1], np.corrcoef([1, 3, 4], [2, 6.5, 7])[0, 1])
    assert got[("b", "a")] == got[("a", "b")]
    assert all(r["n"] == 0 and r["corr"] is None for r in moments.pairwise_corr_matrix(df.limit(0), ["a", "b"]).collect())


def _weights(keys, replicates, seed):
    cut, total = [], 0.0
    for k in range(8):
        total += math.exp(-1) / math.factorial(k)
        cut.append(math.floor(total * 65536))
    out = np.zeros((len(keys), replicates))
    for row, key in enumerate(keys):
        for r in range(replicates):
            d = hashlib.md5(f"{seed}:{r // 8}:{key}".encode()).hexdigest()
            u = int(d[4 * (r % 8):4 * (r % 8) + 4], 16)
            out[row, r] = sum(u >= c for c in cut)
    return out


def test_line_band_equals_weighted_fits(spark):
    rng = np.random.default_rng(5)
    n, replicates = 150, 20
    x = rng.normal(1e5, 10, n)
    y = 3 * x + rng.normal(0, 20, n)
    rows = [(f"k{i}", float(a), float(b), None) for i, (a, b) in enumerate(zip(x, y))] + [("bad", None, 1.0, None), ("nan", 1.0, float("nan"), None)]
    df = spark.createDataFrame(rows, "id string, x double, y double, key string")
    w = _weights([f"k{i}" for i in range(n)], replicates, 1)
    assert 0.8 < w.mean() < 1.2
    at = 1e5 + 5.0
    lines = [np.polyfit(x - 1e5, y, 1, w=np.sqrt(w[:, r])) for r in range(replicates)]
    values = [np.polyval(c, at - 1e5) for c in lines]
    got = [moments.line_band(df.repartition(p), F.col("id"), "x", "y", [at], replicates, 0.9).collect() for p in (1, 6)]
    for (r,) in got:
        assert r["replicates"] == replicates
        assert math.isclose(r["fit"], np.polyval(np.polyfit(x - 1e5, y, 1), at - 1e5), abs_tol=1e-4)
        assert math.isclose(r["low"], np.quantile(values, 0.05), abs_tol=1e-4) and math.isclose(r["high"], np.quantile(values, 0.95), abs_tol=1e-4)


def test_line_band_without_a_line(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 1.0, 3.0)], "id string, x double, y double")
    for d in (df, df.limit(0)):
        (r,) = moments.line_band(d, F.col("id"), "x", "y", [0.5], 10).collect()
        assert r["fit"] is None and r["low"] is None and r["replicates"] == 0


def test_fingerprints_merge_and_tell_rows_apart(spark):
    rows = [(1, "a", None), (2, "", "x"), (2, "", "x"), (3, None, "x"), (None, "ab", "c")]
    df = spark.createDataFrame(rows, "k int, u string, v string")

    def of(*parts):
        return {r["columns"]: (r["rows"], r["fingerprint"]) for r in merge_fingerprints(*parts).collect()}

    sets = {"all": ["k", "u", "v"], "text": ["u", "v"]}
    whole = of(fingerprint_parts(df, "t", sets))
    assert whole == of(fingerprint_parts(df.repartition(4).orderBy("v"), "t", sets, by="v"))
    assert whole == of(fingerprint_parts(df.where("k = 2"), "t", sets), fingerprint_parts(df.where("k is null or k <> 2"), "t", sets))
    assert whole["all"] != of(fingerprint_parts(df.dropDuplicates(), "t", sets))["all"]
    near = spark.createDataFrame([(1, "a", ""), *rows[1:]], df.schema)  # null against empty text
    assert of(fingerprint_parts(near, "t", sets))["text"] != whole["text"]
    moved = spark.createDataFrame([*rows[:4], (None, "a", "bc")], df.schema)  # a letter over a column's edge
    assert of(fingerprint_parts(moved, "t", sets))["all"] != whole["all"]
    assert of(fingerprint_parts(df.limit(0), "t", sets)) == {}
