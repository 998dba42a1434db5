"""Result tables: model comparison (coef/SE/t/p + formatted text), publication
rows (coefficient row, SE row, footer), key-value notes.  Built as DataFrames
from the small fitted results; formatting is native column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions import tails
from panelforge.functions.fmt import fmt_coef, fmt_fixed, fmt_se
from panelforge.plans.regression import Fit, _f


def p_value(t, df, dist):
    """Two-sided p-value of a statistic, as a column: ``dist`` 't' with ``df`` degrees of freedom, or 'normal'."""
    return F.when(F.col(dist) == "normal", tails.normal_two_sided(t)).otherwise(tails.t_two_sided(t, df))


def coef_rows(spark: SparkSession, fits: Sequence[tuple[Sequence[str], Fit]]) -> DataFrame:
    """(label..., variable, coef, se, t, p, nobs) for (labels with the variable last, fit) pairs; the p-value is a column
    expression of the statistic, the residual degrees of freedom and the fit's distribution; a fit without the statistic has its own."""
    labels = [f"label{i}" for i in range(len(fits[0][0]) - 1)] if fits else []
    rows = [(*name[:-1], name[-1], _f(f.coef.get(name[-1])), _f(f.se.get(name[-1])), _f(f.tstat.get(name[-1])),
             None if f.tstat.get(name[-1]) is not None else _f(f.pvalue.get(name[-1])), float(f.df_resid), f.dist, int(f.nobs))
            for name, f in fits]
    kinds = "".join(f"{x} string, " for x in labels) + "variable string, coef double, se double, t double, _p double, _df double, _dist string, nobs bigint"
    df = spark.createDataFrame(rows, kinds)
    return df.withColumn("p", F.coalesce(p_value("t", "_df", "_dist"), "_p")).select(*labels, "variable", "coef", "se", "t", "p", "nobs")


def coef_table(spark: SparkSession, fit: Fit, suffix: str, terms: Sequence[str] | None = None) -> DataFrame:
    """variable, coef_<s>, se_<s>, t_<s>, p_<s>, coef_<s>_fmt for the listed
    terms (a term the model lacks gets nulls: lookup into a fixed term list)."""
    terms = list(terms) if terms is not None else list(fit.terms)
    df = coef_rows(spark, [((t,), fit) for t in terms]).drop("nobs")
    df = df.toDF("variable", *[f"{c}_{suffix}" for c in ("coef", "se", "t", "p")])
    return df.withColumn(f"coef_{suffix}_fmt", fmt_coef(f"coef_{suffix}", f"p_{suffix}"))


def comparison_table(a: DataFrame, b: DataFrame) -> DataFrame:
    """Full outer join of two coefficient tables on ``variable``, sorted."""
    return a.join(b, on="variable", how="full_outer").orderBy("variable")


def publication_rows(spark: SparkSession, fits: Mapping[str, Fit], order: Sequence[str],
                     labels: Mapping[str, str], footer: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Rows (row_order, term, <one text column per model>): for each variable in
    ``order`` a coefficient row (label, '%.4f' + stars) and an SE row ('',
    '(%.4f)'), then the footer rows.  Any number of models."""
    models = list(fits)
    recs = []
    for i, v in enumerate(order):
        recs.append((2 * i, labels.get(v, v), "coef", v))
        recs.append((2 * i + 1, "", "se", v))
    base = spark.createDataFrame(recs, "row_order int, term string, kind string, variable string")
    cols = []
    for m in models:
        t = coef_table(spark, fits[m], m, order).select(
            "variable", F.col(f"coef_{m}").alias(f"_c_{m}"), F.col(f"se_{m}").alias(f"_s_{m}"),
            F.col(f"p_{m}").alias(f"_p_{m}"))
        base = base.join(t, on="variable", how="left")
        cols.append(F.when(F.col("kind") == "coef", fmt_coef(f"_c_{m}", f"_p_{m}"))
                    .otherwise(fmt_se(f"_s_{m}")).alias(m))
    body = base.select("row_order", "term", *cols)
    n = 2 * len(order)
    foot = spark.createDataFrame([(n + j, term, *vals) for j, (term, vals) in enumerate(footer)],
                                 "row_order int, term string, " + ", ".join(f"`{m}` string" for m in models))
    return body.unionByName(foot).orderBy("row_order")


def notes(spark: SparkSession, items: Sequence[tuple[str, object]]) -> DataFrame:
    """Key-value notes (metric, value) with every value rendered as text."""
    return spark.createDataFrame([(k, "" if v is None else str(v)) for k, v in items], "metric string, value string")


def fmt4(x) -> str:
    return "" if x is None else f"{float(x):.4f}"


__all__ = ["coef_rows", "coef_table", "p_value", "comparison_table", "publication_rows", "notes", "fmt4", "fmt_fixed"]
