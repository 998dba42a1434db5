import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelforge.operators import clean, quantiles


def _np_q(v, p):
    v = np.asarray([x for x in v if x is not None and not np.isnan(x)], dtype=float)
    return float(np.percentile(v, p * 100)) if len(v) else None


@pytest.mark.parametrize("method", ["sorted", "refined", "split", "hash", "auto"])
def test_grouped_quantiles_match_numpy(spark, method):
    rng = np.random.default_rng(7)
    rows = []
    for g, n in [("a", 1), ("b", 2), ("c", 57), ("hot", 900), (None, 13)]:
        for x in rng.normal(size=n).round(3):
            rows.append((g, float(x)))
    rows += [("c", None), ("d", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: (r["q1"], r["q3"]) for r in quantiles.grouped_quantiles(
        df, "v", ["g"], [0.25, 0.75], method=method, out_names=["q1", "q3"], num_partitions=7).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    for g, sub in pdf.groupby("g", dropna=False):
        key = None if (isinstance(g, float) and np.isnan(g)) else g
        vals = sub["v"].tolist()
        want = (_np_q(vals, 0.25), _np_q(vals, 0.75))
        if want[0] is None:
            assert key not in got
            continue
        assert got[key] == pytest.approx(want, abs=1e-12)


def test_with_group_rank(spark):
    rows = [("x", float(v)) for v in [5, 1, 3, 3, 9]] + [("y", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = sorted((r["g"], r["v"], r["rank"], r["n"]) for r in
                 quantiles.with_group_rank(df, "v", ["g"], num_partitions=3).collect())
    assert [x[2] for x in got if x[0] == "x"] == [0, 1, 2, 3, 4]
    assert got[-1] == ("y", 2.0, 0, 1)


def _number(x):
    try:
        return float(x)
    except (TypeError, ValueError):
        return float("nan")


def _inside_fences(pdf, col, groups, width=3.0):
    """Row flags by a loop over groups: a group's quartiles from numpy, rows beyond a fence flagged False."""
    values = np.array([_number(x) for x in pdf[col]])
    names = [str(x) for x in pdf[groups[0]]] if groups else [""] * len(pdf)
    keep = np.ones(len(pdf), bool)
    for name in set(names):
        at = [i for i, x in enumerate(names) if x == name]
        known = [i for i in at if not np.isnan(values[i])]
        if not known:
            continue
        low, high = np.percentile(values[known], [25, 75])
        if high > low:
            reach = width * (high - low)
            for i in known:
                keep[i] = low - reach <= values[i] <= high + reach
    return keep


@pytest.mark.parametrize("method", ["sorted", "refined", "hash"])
def test_fence_edges_match_pandas(spark, method):
    rows = [(None, "1"), (None, "2"), (None, "100"), ("a", "-"), ("a", "abc"), ("a", "NaN"),
            ("z", "5"), ("z", "5"), ("z", "5"), ("z", "500"),          # IQR 0 -> keep all
            ("s", "7"),                                                # single row
            ("e", "1"), ("e", "2"), ("e", "3"), ("e", "4"), ("e", "11.5"), ("e", "11.51")]  # on the fence
    df = spark.createDataFrame(rows, "g string, v string")
    got = clean.iqr_fence(df, ["v"], ["g"], method=method)
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    want = pdf[_inside_fences(pdf, "v", ["g"])]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.itertuples(index=False)), key=str)


def test_fence_null_groups_keep_mode(spark):
    rows = [(None, 1.0), (None, 2.0), (None, 3.0), (None, 4.0), (None, 1000.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    assert clean.iqr_fence(df, ["v"], ["g"], null_groups="group").count() == 4
    assert clean.iqr_fence(df, ["v"], ["g"], null_groups="keep").count() == 5


def test_global_fence_several_columns(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=300)
    b = rng.normal(size=300)
    a[5], b[7] = 50.0, -40.0
    pdf = pd.DataFrame({"a": a, "b": b})
    df = spark.createDataFrame(pdf)
    got = clean.iqr_fence(df, ["a", "b"]).count()
    want = int((_inside_fences(pdf, "a", None) & _inside_fences(pdf, "b", None)).sum())
    assert got == want == 298


def test_rules_and_funnel(spark):
    r = clean.dataset_rules(["REF_AREA", "TIME_PERIOD", "ENERGY_PRODUCT", "FLOW_BREAKDOWN", "UNIT_MEASURE",
                             "OBS_VALUE", "X"], "jodi_gas_staging_world_newformat")
    assert r.groups == ["ENERGY_PRODUCT", "FLOW_BREAKDOWN", "UNIT_MEASURE"] and r.outliers == ["OBS_VALUE"]
    g = clean.dataset_rules(["Year", "decimal", "obs_value", "note"], "other")
    assert g.required == ["Year", "obs_value"] and g.outliers == ["obs_value"]
    g2 = clean.dataset_rules(["a", "year"], "other")
    assert g2.outliers == ["a"]
    rows = [("x", "1"), ("x", None), ("x", "2"), ("x", "3"), ("x", "4"), ("x", "400")]
    df = spark.createDataFrame(rows, "indicator_id string, value string").withColumn("country_iso3", F.lit("A")) \
        .withColumn("year", F.lit("2020"))
    cleaned, audit = clean.clean_dataset(df, "world_bank_wdi_raw")
    a = audit.first()
    assert (a.rows_in, a.rows_after_required, a.rows_after_outliers) == (6, 5, 4)
    assert a.dropped_missing_required == 1 and a.dropped_outliers == 1
    assert cleaned.count() == 4


def test_empty_columns_and_rows(spark):
    df = spark.createDataFrame([(1, None, None), (None, None, None)], "a int, b string, c double")
    out, empty = clean.drop_empty_columns(df)
    assert empty == ["b", "c"] and out.columns == ["a"]
    assert clean.drop_all_null_rows(df).count() == 1
    cc = clean.complete_cases(spark.createDataFrame([(1.0, float("inf")), (2.0, 3.0), (float("nan"), 1.0)],
                                                    "x double, y double"), ["x", "y"])
    assert cc.collect() == [(2.0, 3.0)]


def test_hot_group_is_split_across_partitions(spark):
    """A group with most of the rows spans many range partitions in the sorted
    strategy, and its quantiles are still exact."""
    rng = np.random.default_rng(21)
    hot = rng.normal(size=5000)
    rows = [("hot", float(x)) for x in hot] + [("cold", float(x)) for x in rng.normal(size=50)]
    df = spark.createDataFrame(rows, "g string, v double")
    base = df.withColumnRenamed("v", "_v")
    srt, blocks = quantiles._sorted_blocks(base, ["g"], 8)
    assert blocks.where("g = 'hot'").count() >= 4
    q = {r.g: (r.q1, r.med) for r in quantiles.grouped_quantiles(
        df, "v", ["g"], [0.25, 0.5], method="sorted", out_names=["q1", "med"], num_partitions=8).collect()}
    assert q["hot"] == pytest.approx((np.percentile(hot, 25), np.percentile(hot, 50)), abs=1e-12)


def test_auto_picks_sorted_above_limit(spark, monkeypatch):
    df = spark.createDataFrame([("a", float(i)) for i in range(100)], "g string, v double")
    monkeypatch.setattr(quantiles, "HASH_DISTINCT_LIMIT", 10)
    assert quantiles.choose_method(df.withColumnRenamed("v", "_v"), ["g"])[0] == "sorted"
    got = quantiles.grouped_quantiles(df, "v", ["g"], [0.5], out_names=["m"]).first().m
    assert got == 49.5


def test_sorted_and_hash_agree_to_the_last_bit_and_split_hot_values(spark):
    from pyspark.sql import functions as F
    from panelforge.operators.quantiles import _sorted_blocks, grouped_quantiles
    df = spark.range(20000).select((F.col("id") % 97).alias("g"), F.sin("id").alias("v"))
    runs = [{r.g: tuple(r)[1:] for r in grouped_quantiles(df, "v", ["g"], [0.1, 0.25, 0.9], method=m).collect()} for m in ("sorted", "hash")]
    assert runs[0] == runs[1]
    hot = spark.range(40000).select(F.lit(0.0).alias("_v"))
    srt, _ = _sorted_blocks(hot, [], 8)
    assert max(r["count"] for r in srt.groupBy("_pid").count().collect()) < 10000


def _exact(values, p):
    x = sorted(values)
    at = (len(x) - 1) * p
    lo, hi, f = x[int(np.floor(at))], x[int(np.ceil(at))], at - np.floor(at)
    return lo if f == 0 or lo == hi else (1 - f) * lo + f * hi


def test_refined_quantiles_of_hard_values(spark, monkeypatch):
    """Half the rows equal, powers of two over the whole range, both infinities, extremes whose difference overflows, one value."""
    rng = np.random.default_rng(51)
    groups = {"equal": [7.0] * 500 + list(rng.normal(size=500)), "powers": [float(2.0**k) for k in range(-1074, 1024, 7)] + [0.0, -1.0],
              "inf": [float("inf")] * 30 + [float("-inf")] * 20 + list(rng.normal(size=51)), "wide": [-1.7e308, 1.7e308, -1e-320, 1e-320, 0.0, 5e-324],
              "one": [3.25], "two": [1.0, 2.0], None: list(rng.integers(0, 5, 99).astype(float))}
    df = spark.createDataFrame([(g, float(v)) for g, x in groups.items() for v in x], "g string, v double").repartition(6)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    want = {g: [_exact(x, p) for p in probs] for g, x in groups.items()}
    for bins in (quantiles.BINS, 4):
        monkeypatch.setattr(quantiles, "BINS", bins)
        if bins == 4:
            df = df.where("g <> 'powers' or g is null")
            want.pop("powers")
        got = {r["g"]: list(r)[1:] for r in quantiles.grouped_quantiles(df, "v", ["g"], probs, method="refined").collect()}
        assert got.keys() == want.keys()
        for g in want:
            np.testing.assert_equal(np.array(got[g]), np.array(want[g]))
    monkeypatch.setattr(quantiles, "HASH_DISTINCT_LIMIT", 60)
    a, b = ({r["g"]: list(r)[1:] for r in quantiles.grouped_quantiles(df, "v", ["g"], [0.3, 0.5], method=m).collect()} for m in ("split", "hash"))
    assert {g: x for g, x in a.items() if g != "inf"} == {g: x for g, x in b.items() if g != "inf"}


def test_refining_shuffles_counts_only(spark):
    """No task reads more than the bins of its groups, though half of all rows are one value."""
    df = spark.range(0, 60_000, 1, 8).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 2 == 0, 1.5).otherwise(F.rand(3)).alias("v"))
    q = {r["g"]: r["_q0"] for r in quantiles.grouped_quantiles(df, "v", ["g"], [0.4], method="refined").collect()}
    x = df.toPandas()
    for g, part in x.groupby("g"):
        assert q[g] == _exact(part["v"], 0.4)
    plan = quantiles.grouped_quantiles(df, "v", ["g"], [0.4], method="refined")._jdf.queryExecution().executedPlan().toString()
    assert "RangePartitioning" not in plan and "rangepartitioning" not in plan
