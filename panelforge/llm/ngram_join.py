"""Exact Jaccard self-join of texts on word shingles: a grouped prefix join.

Order the shingles of all sets the same way.  Two sets whose Jaccard similarity reaches t share one of the
first ``|x| - ceil(t |x|) + 1`` shingles of each.  Sets with the same such prefix and the same size form one group;
groups that share a prefix shingle are candidates, filtered by size, then expanded to their members and verified
on the whole texts.

The order puts frequent shingles last (then by hash), so a passage that many texts share does not bring them
together unless it makes up most of them.  Frequencies are exact counts over all distinct sets.

Only connectedness is asked of the links.  So in a few rounds every group in a crowd verifies the neighbours it
shares most prefix shingles with, which joins up large groups of copies in linear work; then all candidate
pairs whose members are still in different components are verified, and only those.  A pair that is
never verified is connected already: no link that would join two components is lost.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from . import textkernel as K
from .store import components, freeze, map_batches, parallelism, small, tidy

NUM, DEN = 75, 100
FREQUENT = 32
LIMIT = 2_000_000
FLUSH = 1_500_000
BROADCAST_ROWS = 1_000_000
ROUNDS = 3
CROWD = 16
MASK = [f"m{i}" for i in range(16)]
FOLDED = ["f0", "f1", "f2", "f3"]


def _bits(docs: DataFrame) -> int:
    """Buckets are the next power of two above the session's shuffle partitions."""
    return max(1, min(31, int(np.ceil(np.log2(parallelism(docs.sparkSession) + 1)))))


def _sets(column, seen: set):
    """``(i, set, id)`` of each text with words that the task has not met before."""
    for i, s in K.shingle_sets(column):
        if len(s):
            name = xxhash.xxh3_128_digest(s.tobytes())
            if name not in seen:
                seen.add(name)
                yield i, s, name


def frequent_shingles(docs: DataFrame, text: str = "text", least: int = FREQUENT, limit: int = LIMIT) -> np.ndarray:
    """Leading bits of the shingles in at least ``least`` distinct sets, sorted.

    Tasks drop repeated sets and combine counts; 32-bit remainders are counted by bucket, so a shuffled shingle
    takes four bytes.  If more than ``limit`` reach ``least``, the bar doubles until they fit: the order
    stays one for all texts and so the join stays exact, only candidates grow.
    """
    bits = _bits(docs)

    def run(batches):
        seen, held, size = set(), [], 0

        def flush():
            key, n = np.unique(np.concatenate(held) >> np.uint64(32 - bits), return_counts=True)
            bucket = (key >> np.uint64(32)).astype(np.int32)
            rest = key.astype(np.uint32)
            at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            once, many, count = [], [], []
            for a, b in zip(at, np.append(at[1:], len(key))):
                more = n[a:b] > 1
                once.append(rest[a:b][~more].tobytes())
                many.append(rest[a:b][more].tobytes())
                count.append(n[a:b][more].astype(np.uint32).tobytes())
            return pa.RecordBatch.from_arrays([pa.array(bucket[at]), pa.array(once, pa.binary()), pa.array(many, pa.binary()), pa.array(count, pa.binary())],
                                              names=["bucket", "once", "many", "count"])

        for batch in batches:
            for _, s, _ in _sets(batch.column(0), seen):
                held.append(s)
                size += len(s)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        once = np.frombuffer(b"".join(pdf["once"]), np.uint32)
        many = np.frombuffer(b"".join(pdf["many"]), np.uint32)
        n = np.concatenate([np.ones(len(once)), np.frombuffer(b"".join(pdf["count"]), np.uint32)])
        key, back = np.unique(np.concatenate([once, many]), return_inverse=True)
        total = np.bincount(back, n, len(key)).astype(np.int64)
        key, total = key[total >= least], total[total >= least]
        return pd.DataFrame({"key": key.astype(np.int64) | int(pdf["bucket"].iloc[0]) << 32, "n": total})

    parts = map_batches(docs.select(docs[text]), run, "bucket int, once binary, many binary, count binary")
    found = freeze(parts.groupBy("bucket").applyInPandas(count, "key bigint, n bigint"), "frequent")
    level = F.floor(F.log2("n")).cast("int")
    sizes = sorted(((r[0], r[1]) for r in found.groupBy(level).count().collect()), reverse=True)  # at most 63 rows
    bar, total = 64, 0
    for k, n in sizes:
        if total + n > limit:
            break
        bar, total = k, total + n
    key = found.where(F.col("n") >= 2.0**bar).select("key").toArrow().column(0).to_numpy()  # at most `limit` longs
    return np.sort(key.astype(np.uint64))


def _prefix(s: np.ndarray, frequent: np.ndarray, shift: np.uint64) -> np.ndarray:
    n = len(s)
    size = n - -(-NUM * n // DEN) + 1
    if len(frequent):
        key = s >> shift
        at = np.minimum(np.searchsorted(frequent, key), len(frequent) - 1)
        last = frequent[at] == key
        if last.any():
            return np.concatenate([s[~last], s[last]])[:size]
    return s[:size]


def _group(prefix: np.ndarray, n: int) -> int:
    return xxhash.xxh3_64_intdigest(prefix.tobytes(), seed=n) - (1 << 63)


def prefix_hits(docs: DataFrame, shared, bits: int, text: str = "text") -> DataFrame:
    """``(h, g, n, early)``: every prefix shingle that at least two groups have, with these groups and their sizes;
    ``early`` if it lies in the shorter prefix that meets every partner no smaller than the group's own sets."""
    def run(batches):
        frequent, shift = shared.value, np.uint64(32 - bits)
        seen, groups, h, g, n, size = set(), set(), [], [], [], 0  # n: the size, negative where the shingle is early

        def flush():
            hs, gs = np.concatenate(h), np.concatenate(g)
            ns = np.concatenate(n)
            bucket = (hs & np.uint64((1 << bits) - 1)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            bucket, hs, gs, ns = bucket[order], hs[order], gs[order], ns[order]
            at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            cut = list(zip(at, np.append(at[1:], len(bucket))))
            return pa.RecordBatch.from_arrays([pa.array(bucket[at]), *(pa.array([x[a:b].tobytes() for a, b in cut], pa.binary()) for x in (hs, gs, ns))],
                                              names=["bucket", "h", "g", "n"])

        for batch in batches:
            for _, s, _ in _sets(batch.column(0), seen):
                p = _prefix(s, frequent, shift)
                name = _group(p, len(s))
                if name in groups:
                    continue
                groups.add(name)
                h.append(p)
                g.append(np.full(len(p), name, np.int64))
                early = len(s) - -(-2 * NUM * len(s) // (NUM + DEN)) + 1
                n.append(np.where(np.arange(len(p)) < early, -len(s), len(s)).astype(np.int32))
                size += len(p)
                if size >= FLUSH:
                    yield flush()
                    h, g, n, size = [], [], [], 0
        if size:
            yield flush()

    def common(pdf: pd.DataFrame) -> pd.DataFrame:
        h, g, n = (np.frombuffer(b"".join(pdf[c]), t) for c, t in (("h", np.int64), ("g", np.int64), ("n", np.int32)))
        order = np.lexsort((g, h))
        h, g, n = h[order], g[order], n[order]
        new = np.append(True, (h[1:] != h[:-1]) | (g[1:] != g[:-1]))
        h, g, n = h[new], g[new], n[new]
        same = h[1:] == h[:-1]
        keep = np.append(same, False) | np.append(False, same)
        return pd.DataFrame({"h": h[keep], "g": g[keep], "n": np.abs(n[keep]), "early": n[keep] < 0})

    parts = map_batches(docs.select(docs[text]), run, "bucket int, h binary, g binary, n binary")
    return parts.groupBy("bucket").applyInPandas(common, "h bigint, g bigint, n int, early boolean")


def _describe(docs: DataFrame, key: str, text: str, shared, bits: int) -> DataFrame:
    """``(doc_id, text_key, n_shingles, s, g, m0 .. m15)`` of every row: its set's size, name, group (null without words)
    and a 1024-bit mask, where each shingle flips one bit."""
    src = docs.select(docs[key].alias("doc_id"), F.md5(F.coalesce(docs[text], F.lit("")).cast("binary")).alias("text_key"), docs[text].alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        frequent, shift = shared.value, np.uint64(32 - bits)
        for batch in batches:
            n, name, group, mask = [], [], [], []
            for _, s in K.shingle_sets(batch.column(2)):
                n.append(len(s))
                mask.append(np.packbits(np.bincount((s >> np.uint64(20) & np.uint64(1023)).astype(np.int64), minlength=1024).astype(np.uint8) & 1).view(np.int64))
                name.append(xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None)
                group.append(_group(_prefix(s, frequent, shift), len(s)) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(name, pa.string()), pa.array(group, pa.int64()),
                                              *(pa.array(np.ascontiguousarray(m)) for m in np.array(mask, np.int64).reshape(-1, len(MASK)).T)],
                                             names=["doc_id", "text_key", "n_shingles", "s", "g", *MASK])

    return map_batches(src, run, f"doc_id {kind}, text_key string, n_shingles bigint, s string, g bigint, " + ", ".join(f"{m} bigint" for m in MASK))


def _verified(pairs: DataFrame, members: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The pairs ``(a, b)`` of set names whose whole texts reach the similarity.  Pairs whose masks rule it out are
    dropped first; only texts of the others are read, once each."""
    own = members.select(F.col("s").alias("a"), "n", *MASK)
    others = members.select(F.col("s").alias("b"), F.col("n").alias("n_2"), *[F.col(m).alias(f"{m}_2") for m in MASK])
    pairs = freeze(pairs.join(own, "a").join(others, "b").where(_alike(MASK)).select("a", "b"), "pairs", compact=True)
    need = (pairs.select(F.col("a").alias("s")).unionByName(pairs.select(F.col("b").alias("s"))).distinct()
            .join(members.select("s", "text_key"), "s"))
    need = freeze(need, "need", compact=True)
    keyed = docs.select(F.md5(F.coalesce(docs[text], F.lit("")).cast("binary")).alias("text_key"), docs[text].alias("text"))
    body = keyed.join(small(need.select("text_key"), BROADCAST_ROWS), "text_key", "left_semi").groupBy("text_key").agg(F.first("text").alias("text"))
    texts = freeze(need.join(body, "text_key").select("s", "text"), "texts")
    left = texts.select(F.col("s").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("s").alias("b"), F.col("text").alias("text_b"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ok = []
                for (_, x), (_, y) in zip(K.shingle_sets(part.column(2)), K.shingle_sets(part.column(3))):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(DEN * both >= NUM * (len(x) + len(y) - both))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return freeze(map_batches(pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b"), run, "a string, b string"), "edges", compact=True)


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _fits(n: str, m: str):
    """Whether sets of these sizes can reach the similarity."""
    return (F.col(n) * DEN >= F.col(m) * NUM) & (F.col(m) * DEN >= F.col(n) * NUM)


def _joined_up(roots: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Components after more edges: the known ones enter as stars."""
    if roots is not None:
        edges = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(edges)
    return components(edges)


def _mixed(seats: DataFrame, *more: str) -> DataFrame:
    """Seats ``(h, g, n, lo, hi, *more)`` of the shingles whose groups are not all in one component."""
    open_ = seats.groupBy("h").agg(F.min("lo").alias("a"), F.max("hi").alias("b")).where("a < b").select("h")
    return seats.join(open_, "h").select("h", "g", "n", "lo", "hi", *more)


def _folded(i: int):
    """Word i of the mask folded to 256 bits."""
    a, b, c, d = (F.col(MASK[i + k]) for k in (0, 4, 8, 12))
    return a.bitwiseXOR(b).bitwiseXOR(c.bitwiseXOR(d))


def _alike(masks: list[str]):
    """Whether the masks allow the similarity: bits that differ are shingles that only one set has, and similar
    sets of n and m shingles have at most n + m - 2 * ceil(t / (1 + t) * (n + m)) of these."""
    differ = sum((F.bit_count(F.col(m).bitwiseXOR(F.col(f"{m}_2"))) for m in masks), F.lit(0))
    both = F.col("n") + F.col("n_2")
    return F.coalesce(differ <= both - 2 * F.ceil(both * NUM / (NUM + DEN)), F.lit(True))


def _partners(crowds: DataFrame, heads: DataFrame, turn: int) -> DataFrame:
    """Pairs ``(a, b)`` of the heads of groups: for each group the two of other components that stand next to it
    most often.  Groups stand in one order for all shingles, by size at first and then by
    a hash of each turn, so a shingle yields a row or two a group and never its pairs."""
    seats = _mixed(crowds.join(heads.select("g", F.col("root").alias("lo"), F.col("root").alias("hi")), "g"))
    place = F.col("n").cast("bigint") if turn == 0 else F.xxhash64(F.lit(turn), "g")
    along = Window.partitionBy("h").orderBy(place, "g")
    after = [F.lead(F.struct(F.col("g").alias("g2"), F.col("n").alias("n2"), F.col("lo").alias("lo2")), d).over(along) for d in (1, 2)]
    near = (seats.select("g", "n", "lo", F.array(*after).alias("xs")).select("g", "n", "lo", F.explode("xs").alias("x")).where("x is not null").select("g", "n", "lo", "x.*")
            .where((F.col("lo") != F.col("lo2")) & _fits("n", "n2")).groupBy("g", "n", "g2", "n2").agg(F.count("*").alias("k")))
    both = near.unionByName(near.select(F.col("g2").alias("g"), F.col("n2").alias("n"), F.col("g").alias("g2"), F.col("n").alias("n2"), "k"))
    rank = Window.partitionBy("g").orderBy(F.desc("k"), "g2")
    chosen = both.withColumn("r", F.row_number().over(rank)).where("r <= 2").select(
        F.least("g", "g2").alias("g"), F.greatest("g", "g2").alias("g2")).distinct()
    return (chosen.join(heads.select("g", "head"), "g").join(heads.select(F.col("g").alias("g2"), F.col("head").alias("head2")), "g2")
            .select(*_ordered("head", "head2")))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row.

    ``n_shingles`` is the size of the set of 5-word shingles of the whole text, ``component_id`` the smallest
    key reachable by links (similarity 0.75 or more), the own included.  Null texts and texts without words are empty
    and link with nothing.  Rows of equal sets are one node; a key may repeat and may be null (a
    component of null keys alone has none).  Other columns are ignored, and an empty table gives no rows.
    """
    sc, bits = docs.sparkSession.sparkContext, _bits(docs)
    shared = sc.broadcast(frequent_shingles(docs, text))
    rows = freeze(_describe(docs, key, text, shared, bits), "sets")
    hits = freeze(prefix_hits(docs, shared, bits, text), "hits")
    members = rows.where("s is not null").groupBy("s").agg(F.first("g").alias("g"), F.first("n_shingles").alias("n"), F.min("text_key").alias("text_key"),
                                                              *[F.first(m).alias(m) for m in MASK])
    size = members.groupBy("g").agg(F.count("*").alias("k"), F.min("s").alias("head"))
    active = hits.select("g").distinct().join(size.where("k > 1").select("g"), "g", "full")
    members = freeze(members.join(active, "g").join(size, "g").select("s", "g", "n", "text_key", "head", *MASK), "members", compact=True)

    # Members of a group are tried in a chain first, then groups that crowd about a shingle with a partner or two a
    # round.  Rounds only save work: whatever they leave apart is compared at the end.
    beside = Window.partitionBy("g").orderBy("s")
    pairs = freeze(members.select("s", F.lead("s").over(beside).alias("s2")).where("s2 is not null").select(*_ordered("s", "s2")), "pairs", compact=True)
    tried, roots = pairs, _joined_up(None, _verified(pairs, members, docs, text))
    crowds = hits.groupBy("h").agg(F.count("*").alias("k")).where(F.col("k") >= CROWD).select("h")
    crowds = freeze(hits.join(crowds, "h").select("h", "g", "n"), "crowds", compact=True)
    for turn in range(ROUNDS):
        tidy(docs.sparkSession)
        heads = members.groupBy("g").agg(F.min("head").alias("s")).join(roots.withColumnRenamed("node", "s"), "s", "left").select(
            "g", F.col("s").alias("head"), F.coalesce("root", "s").alias("root"))
        pairs = freeze(_partners(crowds, heads, turn).join(tried, ["a", "b"], "left_anti"), "pairs", compact=True)
        met = _verified(pairs, members, docs, text)
        if met.isEmpty():
            break
        tried, roots = tried.unionByName(pairs), _joined_up(roots, met)

    # Last: all candidates that are not connected yet, group pairs first, then their members.
    tidy(docs.sparkSession)
    placed = freeze(members.join(roots.withColumnRenamed("node", "s"), "s", "left")
                    .select("s", "g", F.coalesce("root", "s").alias("root"), *[_folded(i).alias(f) for i, f in enumerate(FOLDED)]), "placed", compact=True)
    # A group of one set carries its mask, others none (and so pass).
    state = placed.groupBy("g").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                    *[F.when(F.count("*") == 1, F.first(m)).alias(m) for m in FOLDED])
    seats = _mixed(hits.join(state, "g"), "early", *FOLDED)
    other = seats.where("early").toDF(*[f"{c}_2" if c != "h" else c for c in seats.columns])
    apart = ~((F.col("lo") == F.col("hi")) & (F.col("lo_2") == F.col("hi_2")) & (F.col("lo") == F.col("lo_2")))
    smaller = (F.col("n_2") < F.col("n")) | ((F.col("n") == F.col("n_2")) & (F.col("g") < F.col("g_2")))
    groups = (seats.join(other, "h").where(smaller & _fits("n", "n_2") & apart & _alike(FOLDED))
              .select("g", F.col("g_2").alias("g2")).distinct())
    other = placed.select(F.col("s").alias("s2"), F.col("g").alias("g2"), F.col("root").alias("root2"))
    open_ = placed.join(groups, "g").join(other, "g2").where("root <> root2").select(*_ordered("s", "s2"))
    same = placed.join(other.withColumnRenamed("g2", "g"), "g").where("root < root2").select(*_ordered("s", "s2"))
    late = freeze(open_.unionByName(same).distinct().join(tried, ["a", "b"], "left_anti"), "pairs", compact=True)
    met = _verified(late, members, docs, text)
    if not met.isEmpty():
        roots = _joined_up(roots, met)

    found = rows.join(roots.withColumnRenamed("node", "s"), "s", "left").select("doc_id", "n_shingles", F.coalesce("root", "s").alias("root"))
    least = found.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return found.join(least, "root", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
