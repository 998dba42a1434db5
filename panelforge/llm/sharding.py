"""Weighted rendezvous hashing of records over shards, with gapless slots.

Shard s draws ``-ln(u) / weight`` with u hashed from (record key, s); the least draw wins.  A new shard
only adds a draw, so records move into it and nowhere else, in proportion to its weight.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .store import freeze


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Index of the shard whose weighted draw for ``key`` is least (ties: the lower index); shards of weight 0 get
    nothing.  A null key hashes like any other value, so all null keys share a shard."""
    draws = [F.struct((-F.ln((F.shiftrightunsigned(F.xxhash64(key, F.lit(s)), 11) + 0.5) / float(2**53)) / float(w)).alias("draw"),
                      F.lit(s).alias("shard")) for s, w in enumerate(weights) if w > 0]
    if not draws:
        raise ValueError("at least one shard needs a weight above 0")
    return (F.least(*draws) if len(draws) > 1 else draws[0])["shard"]


def slots(rows: DataFrame, shard: str = "shard", order: str = "__row") -> DataFrame:
    """Adds ``slot``, gapless from 0 in each shard.

    ``order`` is a monotonically increasing row id whose upper bits are the partition.  Numbers run inside
    (partition, shard), and offsets are the prefix sums of their counts, so a hot shard is never one task.
    """
    part = F.shiftright(F.col(order), 33).alias("__part")
    rows = rows.withColumn("__part", part)
    counts = rows.groupBy("__part", shard).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(shard).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("__part", shard, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("__part", shard).orderBy(order)
    return (rows.withColumn("__k", F.row_number().over(inside) - 1).join(base, ["__part", shard])
            .withColumn("slot", F.col("__base") + F.col("__k")).drop("__k", "__base", "__part"))


def shard_documents(docs: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text",
                    new_weight: float = 1.0) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot, grown_shard)`` of every row.

    ``size`` is the text's UTF-8 bytes (null: none) plus 1; ``grown_shard`` the shard once one of ``new_weight`` is
    added.  Key and shard list alone decide the shard: rows that repeat a key, null included, share it
    but have slots of their own.  Only narrow rows are frozen and shuffled; other columns are ignored.
    """
    body = F.coalesce(docs[text], F.lit(""))
    narrow = docs.select(
        docs[key].alias("doc_id"), (F.octet_length(body) + F.lit(1)).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), F.monotonically_increasing_id().alias("__row"))
    placed = freeze(narrow.withColumns({"shard": rendezvous(F.col("doc_id"), weights),
                                        "grown_shard": rendezvous(F.col("doc_id"), [*weights, new_weight])}), "shards")
    return slots(placed).select("doc_id", "size", "text_crc32", "shard", "slot", "grown_shard")
