"""Exact histogram of encoded lengths, and what follows from it for every context limit."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import tokens
from .store import freeze, map_batches

BLOCK = 1024


def lengths(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """``(n_tokens)`` of every row's whole text; null and empty texts have none."""
    path = path or tokens.default_path()

    def run(batches):
        enc = tokens.encoder(path)
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = [t or "" for t in batch.column(0).slice(k, 1024).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(np.fromiter(map(len, enc.encode(part)), np.int64, len(part)))], names=["n_tokens"])

    return map_batches(docs.select(docs[text].alias("text")), run, "n_tokens bigint")


def histogram(n: DataFrame) -> DataFrame:
    """One row per distinct length, with suffix sums.

    ``n_docs`` documents have exactly ``n_tokens`` tokens; ``docs_ge``/``tokens_ge`` count documents at least that
    long and their tokens; ``docs_le`` the others with those of this length; ``kept_tokens`` is the corpus total when every document is truncated
    to ``n_tokens``, ``lost_tokens`` what that drops; ``total_docs``/``total_tokens`` the whole.

    The counts are frozen, so texts are encoded once though two aggregations follow.  Suffix sums run in two levels,
    within blocks of 1024 lengths and over the block totals (one row per block that occurs), so no task holds the
    whole histogram.  An empty table gives no row; repeated rows count each time.
    """
    h = freeze(n.groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "lengths", compact=True)
    h = h.withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("bd"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("bt"))
    every = Window.orderBy(F.desc("block"))
    after = every.rowsBetween(Window.unboundedPreceding, -1)
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = lambda c: F.coalesce(c, F.lit(0))
    blocks = blocks.select("block", zero(F.sum("bd").over(after)).alias("ad"), zero(F.sum("bt").over(after)).alias("at"),
                           F.sum("bd").over(whole).alias("total_docs"), F.sum("bt").over(whole).alias("total_tokens"))
    down = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    tokens_here = F.col("n_docs") * F.col("n_tokens")
    s = h.join(blocks, "block").select(
        "n_tokens", "n_docs", (F.sum("n_docs").over(down) + F.col("ad")).alias("docs_ge"),
        (F.sum(tokens_here).over(down) + F.col("at")).alias("tokens_ge"), "total_docs", "total_tokens")
    lost = F.col("tokens_ge") - F.col("docs_ge") * F.col("n_tokens")
    return s.select("n_tokens", "n_docs", "docs_ge", "tokens_ge",
                    (F.col("total_docs") - F.col("docs_ge") + F.col("n_docs")).alias("docs_le"),
                    (F.col("total_tokens") - lost).alias("kept_tokens"), lost.alias("lost_tokens"), "total_docs", "total_tokens")


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """For each context limit: documents that fit, tokens kept after truncation, tokens lost.  Any limit is answered
    from the first length at or above it."""
    spark = hist.sparkSession
    want = spark.createDataFrame([(int(x),) for x in dict.fromkeys(limits)], "context_limit bigint")
    total = hist.agg(F.max("total_docs").alias("docs"), F.max("total_tokens").alias("tokens"))
    ge = (hist.join(F.broadcast(want), F.col("n_tokens") >= F.col("context_limit"))
          .groupBy("context_limit").agg(F.min_by(F.struct("docs_ge", "tokens_ge", "n_tokens", "n_docs"), "n_tokens").alias("x")))
    over = F.coalesce(F.col("x.docs_ge"), F.lit(0))
    lost = F.coalesce(F.col("x.tokens_ge") - F.col("x.docs_ge") * F.col("context_limit"), F.lit(0))
    fits = F.col("docs") - over + F.when(F.col("x.n_tokens") == F.col("context_limit"), F.col("x.n_docs")).otherwise(0)
    row = total.first()
    return want.join(ge, "context_limit", "left").withColumns({"docs": F.lit(row[0] or 0), "tokens": F.lit(row[1] or 0)}).select(
        "context_limit", fits.alias("docs_fit"), (F.col("tokens") - lost).alias("kept_tokens"), lost.alias("lost_tokens"))


def quantile(hist: DataFrame, q: float) -> int | None:
    """Smallest length that at least the share ``q`` of the documents does not exceed."""
    row = hist.where(F.col("docs_le") >= F.lit(q) * F.col("total_docs")).agg(F.min("n_tokens")).first()
    return row[0]


def token_counts(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """:func:`histogram` of the encoded lengths of all rows of ``docs``."""
    return histogram(lengths(docs, path, text))
