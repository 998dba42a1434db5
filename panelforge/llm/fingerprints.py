"""Bottom-k sketches of word shingles, in DataFrame functions only.

A sketch is the sorted array of the k least distinct 64-bit hashes of a text's 5-word shingles.  Sketches of
parts merge into the sketch of the whole; two of them estimate resemblance and containment, one the number of
distinct shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .store import parallelism

K = 128
SHINGLE = 5
_SPACE = "[\\x20\\x09-\\x0D]+"
_BLANKS = " \t\n\x0b\x0c\r"
FINE = 16


def with_sketch(df: DataFrame, text: str, out: str, k: int = K) -> DataFrame:
    """Adds ``out``, the sketch of ``text`` (null: empty).  A text of fewer than five words is one shingle, one
    without words has an empty sketch."""
    words = F.split(F.lower(F.trim(F.coalesce(F.col(text), F.lit("")), F.lit(_BLANKS))), _SPACE)
    df = df.withColumn("__w", F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w)))
    w, n = F.col("__w"), F.size("__w")
    rolled = F.transform(F.sequence(F.lit(1), n - (SHINGLE - 1)), lambda i: F.xxhash64(*[F.get(w, i - 1 + d) for d in range(SHINGLE)]))
    found = (F.when(n >= SHINGLE, rolled).when(n > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>")))
    return df.withColumn("__s", F.array_distinct(found)).withColumn(out, F.slice(F.sort_array("__s"), 1, k)).drop("__w", "__s")


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: share of the union's k least hashes that both have (two empty sketches: 1)."""
    both = F.array_intersect(a, b)
    u = merged(a, b, k)
    return F.when(F.size(u) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(u, both)) / F.size(u))


def distinct_shingles(s: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(s, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has, from resemblance and the distinct counts (a empty: 1)."""
    j, na, nb = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), j / (1 + j) * (na + nb) / na))


def merge_by(df: DataFrame, group: str, sketch: str, k: int = K) -> DataFrame:
    """One sketch per group.  Hashes of equal value meet first and ranks are cut in salted parts, so a group
    with a third of the rows never meets in one task before it is down to k hashes a part."""
    rows = df.select(F.col(group), F.explode(sketch).alias("h")).distinct().withColumn("salt", F.pmod(F.col("h"), F.lit(256)))
    part = Window.partitionBy(group, "salt").orderBy("h")
    kept = rows.withColumn("r", F.row_number().over(part)).where(F.col("r") <= k)
    return kept.groupBy(group).agg(F.slice(F.sort_array(F.collect_list("h")), 1, k).alias(sketch))


def as_text(s: Column) -> Column:
    return F.array_join(F.transform(s, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def with_next(df: DataFrame, key: str, carry: list[str], tie: str) -> DataFrame:
    """Adds ``next_<c>`` of the following row in ascending (``key``, ``tie``), the first row's after the last.

    Rows are dealt to buckets that follow the key's order: equal steps of the key's range, counted in a narrow
    pass and joined to about equal buckets.  The first row of each bucket is also sent, as a ghost, to the end of the bucket
    before it; so one shuffle and a window inside each bucket see every neighbour.  Null keys come first.
    """
    spark = df.sparkSession
    parts = parallelism(spark)
    low, high, rows = df.agg(F.min(key).cast("double"), F.max(key).cast("double"), F.count("*")).first()
    step = max((high - low) / (FINE * parts), 1.0) if low is not None else 1.0
    fine = F.coalesce(F.floor((F.col(key).cast("double") - F.lit(low or 0.0)) / F.lit(step)), F.lit(-1)).cast("int")
    df = df.withColumn("__fine", fine)
    # At most FINE * parts + 2 rows, whatever the table holds.
    counts = df.groupBy("__fine").agg(F.count("*").alias("n"))
    before = Window.orderBy("__fine").rowsBetween(Window.unboundedPreceding, -1)
    buckets = counts.select("__fine", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / F.lit(max(1.0, (rows or 0) / parts))).cast("int").alias("__bucket"))
    placed = df.join(F.broadcast(buckets), "__fine")
    heads = placed.groupBy("__bucket").agg(F.min(F.struct(F.col(key), F.col(tie))).alias("h"))
    order = Window.orderBy("__bucket")
    last = F.max("__bucket").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    # One row per bucket: the head of each, and the bucket before it.
    heads = heads.select(F.col(f"h.{key}").alias("__hk"), F.col(f"h.{tie}").alias("__ht"), F.coalesce(F.lag("__bucket").over(order), last).alias("__to"))
    ghosts = (df.join(F.broadcast(heads), F.col(key).eqNullSafe(F.col("__hk")) & F.col(tie).eqNullSafe(F.col("__ht")))
              .groupBy("__to").agg(*[F.first(c).alias(c) for c in df.columns]))
    every = placed.withColumn("__ghost", F.lit(0)).unionByName(
        ghosts.withColumnRenamed("__to", "__bucket").withColumn("__ghost", F.lit(1)))
    inside = Window.partitionBy("__bucket").orderBy("__ghost", F.asc_nulls_first(key), tie)
    for c in carry:
        every = every.withColumn(f"next_{c}", F.lead(c).over(inside))
    return every.where("__ghost = 0").drop("__ghost", "__bucket", "__fine")


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Fingerprints of every row's whole text and of its edited text (the last half of its code points
    replaced by the first as many of the next document in ascending key order, or all it has; the last document is followed by the first).

    Columns: key as ``doc_id``, ``n_chars``, ``edited`` (text), ``sketch``, ``edited_sketch``, ``next_sketch``.
    Null texts are empty, null keys come first, rows that repeat a key are ordered by a hash of their text, and other
    columns are ignored.  A table of one row follows itself; an empty one gives no rows.
    """
    src = docs.select(docs[key].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    src = with_sketch(src.withColumn("tie", F.xxhash64("text")), "text", "sketch", k)
    near = with_next(src, "doc_id", ["text", "sketch"], "tie")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    near = near.withColumn("n_chars", n.cast("bigint")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)))
    return with_sketch(near.drop("text", "next_text", "tie"), "edited", "edited_sketch", k)
