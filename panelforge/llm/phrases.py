"""Phrase collocation mining by multikey quicksort of suffix pointers.

Every word of a piece of text is the start of a suffix; a suffix pointer carries the first three words (64-bit hashes of language and
word).  Pointers are routed by leading words, so that all suffixes of a prefix meet in one task, and sorted there
by multikey three-way quicksort to a depth of three words: the pointers equal to a pivot form a
partition whose size is the count of that prefix, and partitions below the least count are abandoned, with everything beneath them.

Counts of single words come first.  They tell which suffixes can't lead to a frequent phrase, and which words are hot (a share of
1 in 4 P of all words, P the number of partitions; so at most 4 P words are).  A suffix that starts with a hot word is routed by two
words, by three if the second is hot as well; if all three are hot, or a text piece ends there, each task sends one counted pointer per
distinct prefix.  So no route holds more than a bounded share of the pointers, whatever the text.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from . import textkernel as K
from .store import freeze, map_batches, parallelism

LEAST, TOP, COVER = 10, 2000, 50
DEPTH = 3
FLUSH = 1_000_000
TEXTS = 1 << 17
#: Bytes of pointers that one route may bring together.
ROUTE_BYTES = 32 << 20
MOST_BITS = 1 << 27
NO_LANG = "und"
_U = np.uint64
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_SEP = _BREAK.copy()
_SEP[[0x20, 0x09]] = True


def _tokens(texts, langs):
    """Per chunk of texts: ``(words, begin, end, raw, near, text)``: hashes of (language, word), byte ranges, whether the next
    word follows in the same piece, and the text of each word."""
    raw, off = K.utf8(texts)
    names = pc.fill_null(langs.cast(pa.string()), NO_LANG).dictionary_encode()
    own = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in names.dictionary.to_pylist()], np.uint64)
    lang = own[names.indices.to_numpy()] if len(names) else np.zeros(0, np.uint64)
    for i, j in K.chunks(off, TEXTS):
        part = raw[off[i]:off[j]]
        begin, end, h, first = K.tokens(part, off[i:j + 1] - off[i], _SEP)
        text = np.repeat(np.arange(i, j), np.diff(first))
        h = np.maximum(K.mix(h ^ lang[text]), _U(1))
        piece = np.cumsum(_BREAK[part])[begin] if len(begin) else begin
        near = np.zeros(len(h), bool)
        near[:-1] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
        yield h, begin, end, part, near, text


def _strings(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte ranges as strings, A-Z lower-cased."""
    size = end - begin
    off = np.concatenate([[0], np.cumsum(size)])
    data = raw[np.repeat(begin - off[:-1], size) + np.arange(off[-1])]
    data = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(off.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes()))


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(h, lang, word, c)``: occurrences of every word by language; the row of the empty word counts all words of its language.
    Tasks combine before the shuffle, so a hot word is a few rows a task."""
    def run(batches):
        held, size = [], 0

        def flush():
            h = np.concatenate([x[0] for x in held])
            key, first, back = np.unique(h, return_index=True, return_inverse=True)
            n = np.bincount(back, np.concatenate([x[3] for x in held]), len(key)).astype(np.int64)
            column = lambda k: pa.concat_arrays([x[k] for x in held]).take(pa.array(first))
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), column(1), column(2).cast(pa.string()), pa.array(n)], names=["h", "lang", "word", "c"])

        for batch in batches:
            langs = pc.fill_null(batch.column(1).cast(pa.string()), NO_LANG)
            whole: dict = {}
            for h, begin, end, raw, _, of in _tokens(batch.column(0), batch.column(1)):
                key, first, n = np.unique(h, return_index=True, return_counts=True)
                held.append((key, langs.take(pa.array(of[first])), _strings(raw, begin[first], end[first]), n))
                size += len(key)
                for r in pc.value_counts(langs.take(pa.array(of))).to_pylist():
                    whole[r["values"]] = whole.get(r["values"], 0) + r["counts"]
                if size > FLUSH:
                    yield flush()
                    held, size = [], 0
            if whole:
                yield pa.RecordBatch.from_arrays([pa.array([0] * len(whole), pa.int64()), pa.array(list(whole), pa.string()), pa.array([""] * len(whole), pa.string()),
                                                  pa.array(list(whole.values()), pa.int64())], names=["h", "lang", "word", "c"])
        if held:
            yield flush()

    src = docs.select(docs[text].alias("t"), docs[lang].cast("string").alias("l"))
    return map_batches(src, run, "h bigint, lang string, word string, c bigint").groupBy("h", "lang", "word").agg(F.sum("c").alias("c"))


def equal_partitions(cols: list[np.ndarray], weight: np.ndarray | None, least: int, whole: int):
    """Multikey three-way quicksort of suffix pointers; yields ``(depth, first, count)`` per depth: one pointer of each partition of
    equal prefixes and the partition's size (summed ``weight``).

    All partitions are split in lock step: pointers below, equal to and above the median of three of their
    partition.  Equal ones are done at this depth and go on with the next word (0: the piece ends, nothing
    follows); the outer ones are split further.  ``whole``: the first depth whose partitions are complete here; from there
    on those below ``least`` are abandoned.
    """
    at = np.arange(len(cols[0]))
    sizes = np.array([len(at)] if len(at) else [], np.int64)
    for depth, column in enumerate(cols, 1):
        key, done = column[at], []
        while len(sizes):
            begin = np.cumsum(sizes) - sizes
            a, b, c = key[begin], key[begin + sizes // 2], key[begin + sizes - 1]
            pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))
            each = np.repeat(pivot, sizes)
            low, same = key < each, key == each
            total = lambda mask, begin=begin: np.add.reduceat(mask.view(np.int8), begin, dtype=np.int64)
            n_low, n_same = total(low), total(same)
            equal, outer = at[same], (low, ~(low | same))
            count = n_same if weight is None else np.add.reduceat(weight[equal], np.cumsum(n_same) - n_same)
            good = pivot != 0
            if depth >= whole:
                good &= count >= least
            done.append((equal[np.repeat(good, n_same)], n_same[good], count[good]))
            sizes = np.concatenate([n_low, sizes - n_low - n_same])
            at, key = (np.concatenate([x[m] for m in outer]) for x in (at, key))
            live = sizes > 0
            if depth >= whole and weight is None:
                live &= sizes >= least
            keep = np.repeat(live, sizes)
            at, key, sizes = at[keep], key[keep], sizes[live]
        if not done:
            return
        at, sizes, count = (np.concatenate([x[k] for x in done]) for k in range(3))
        yield depth, at[np.cumsum(sizes) - sizes], count


def _known(words: DataFrame, distinct: int) -> np.ndarray:
    """Bits of the hashes of ``words``, at most MOST_BITS (16 MB): a word whose bit is not set is not among them.  Others
    only cost time."""
    bits = min(MOST_BITS, 1 << max(15, int(np.ceil(np.log2(16.0 * max(1, distinct))))))
    place = F.shiftrightunsigned("h", 64 - (bits.bit_length() - 1))
    rows = words.select(place.alias("p")).groupBy(F.floor(F.col("p") / 32768).alias("b")).agg(
        F.bitmap_construct_agg(F.pmod("p", F.lit(32768))).alias("m")).collect()  # at most MOST_BITS / 32768 rows of 4 kB
    out = np.zeros((bits // 32768, 4096), np.uint8)
    for r in rows:
        out[r["b"]] = np.frombuffer(r["m"], np.uint8)
    return out.ravel()


def _has(known: np.ndarray, h: np.ndarray) -> np.ndarray:
    p = (h >> _U(64 - ((len(known) * 8).bit_length() - 1))).astype(np.int64)
    return (known[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)


def _among(values: np.ndarray, h: np.ndarray) -> np.ndarray:
    if not len(values):
        return np.zeros(len(h), bool)
    return values[np.minimum(np.searchsorted(values, h), len(values) - 1)] == h


def _route(cols: list[np.ndarray], hot: np.ndarray, routes: int):
    """Blobs ``(kind, route, pointers, counts)``; the kind is the number of words that route a pointer, 4 for counted ones."""
    one, two, three = (_among(hot, c) for c in cols)
    deep = one & two
    kind = 1 + one + deep + (deep & (three | (cols[2] == 0)))
    key = K.mix(cols[0])
    key = np.where(kind >= 2, K.mix(key ^ cols[1]), key)
    key = np.where(kind >= 3, K.mix(key ^ cols[2]), key)
    for k in range(1, 5):
        mine = np.flatnonzero(kind == k)
        if not len(mine):
            continue
        count = None
        part = [c[mine] for c in cols]
        if k == 4:  # combined here, by the same sort; prefixes that end after two words by their own
            ends = part[2] == 0
            found = [(i, n) for mask, depth in ((~ends, 3), (ends, 2)) for i, n in _counted(part, np.flatnonzero(mask), depth)]
            pick, count = (np.concatenate([x[i] for x in found]) for i in range(2))
            mine, part = mine[pick], [c[pick] for c in part]
        own = key[mine]
        order = np.argsort(own)
        route = ((own[order] >> _U(32)) * _U(routes) >> _U(32)).astype(np.int64)  # follows the order of the keys
        head = np.flatnonzero(np.append(True, route[1:] != route[:-1]))
        for a, b in zip(head, np.append(head[1:], len(order))):
            at = order[a:b]
            yield k, int(route[a]), b"".join(c[at].tobytes() for c in part), None if count is None else count[at].astype(np.int64).tobytes()


def _counted(part, rows: np.ndarray, depth: int):
    found = [(first, count) for d, first, count in equal_partitions([c[rows] for c in part[:depth]], None, 1, 1) if d == depth]
    return [(rows[first], count) for first, count in found]


def frequent_prefixes(docs: DataFrame, known: np.ndarray, hot: np.ndarray, total: int, least: int = LEAST, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(h1, h2, h3, a)``: counts of the phrases of two (h3 null) and three words; those of two hot words in parts.

    Pointers whose first or second word is too rare are dropped where they arise: all their phrases are.  ``total`` words
    decide into how many routes they are dealt.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((known, hot))
    tasks = parallelism(spark)
    # A task sends one blob per route at most, so there are no more routes than partitions unless pointers are too many for these.
    routes = tasks * max(1, -(-total * 8 * DEPTH // (tasks * ROUTE_BYTES)))

    def send(batches):
        known, hot = shared.value
        held, size = [], 0

        def flush():
            rows = list(_route([np.concatenate([x[k] for x in held]) for k in range(DEPTH)], hot, routes))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
                                               pa.array([r[2] for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.binary())],
                                              names=["kind", "route", "pointers", "counts"])

        for batch in batches:
            for h, _, _, _, near, _ in _tokens(batch.column(0), batch.column(1)):
                if len(h) < 2:
                    continue
                common = _has(known, h)
                two, follows = np.zeros_like(h), near & np.append(common[1:], False)
                two[:-1] = np.where(follows[:-1], h[1:], 0)
                three = np.zeros_like(h)
                three[:-1] = np.where(follows[:-1], two[1:], 0)
                keep = common & (two != 0)
                held.append((h[keep], two[keep], three[keep]))
                size += int(keep.sum())
                if size > FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def sort(batches):
        def flush(kind, blobs):
            n = [len(p) // 24 for p, _ in blobs]
            cols = [np.concatenate([np.frombuffer(p, np.uint64, m, 8 * k * m) for (p, _), m in zip(blobs, n)]) for k in range(DEPTH)]
            weight = np.concatenate([np.frombuffer(c, np.int64) for _, c in blobs]) if kind == 4 else None
            for depth, first, count in equal_partitions(cols, weight, least, min(kind, DEPTH)):
                if depth > 1 and len(first):
                    third = pa.array(cols[2][first].view(np.int64), mask=np.full(len(first), depth < 3))
                    yield pa.RecordBatch.from_arrays([*(pa.array(c[first].view(np.int64)) for c in cols[:2]), third, pa.array(count)], names=["h1", "h2", "h3", "a"])

        name, blobs = None, []
        for b in batches:
            for kind, route, pointers, counts in zip(*(b.column(k).to_pylist() for k in range(4))):
                if (kind, route) != name:
                    if blobs:
                        yield from flush(name[0], blobs)
                    name, blobs = (kind, route), []
                blobs.append((pointers, counts))
        if blobs:
            yield from flush(name[0], blobs)

    src = docs.select(docs[text].alias("t"), docs[lang].cast("string").alias("l"))
    sent = map_batches(src, send, "kind int, route bigint, pointers binary, counts binary")
    dealt = sent.repartition(tasks, "kind", "route").sortWithinPartitions("kind", "route")
    return map_batches(dealt, sort, "h1 bigint, h2 bigint, h3 bigint, a bigint")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, cover: int = COVER) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` phrases of two or three words.

    A candidate occurs at least ``least`` times (``a``, within pieces).  Of the cuts of its words the one of the lowest score
    floor(10^6 a a / (l r)) counts, ties to the shorter first part; l and r are the counts of both parts, products are decimals of 38 digits.  A phrase of two
    words that lies in one of three with at least ``cover`` percent of its count is dropped.  Order: score and count descending, phrase ascending.
    Null texts are empty, a null language is ``und``; repeated rows count each; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    counted = freeze(word_counts(docs, text, lang).where((F.col("c") >= least) | (F.col("word") == "")), "words")
    words, whole = counted.where("word <> ''"), counted.where("word = ''").select("lang", F.col("c").alias("n"))
    distinct, total = words.count(), whole.agg(F.sum("n")).first()[0] or 0
    tasks = parallelism(spark)
    hot = words.where(F.col("c") * (4 * tasks) >= total).select("h").toArrow().column("h").to_numpy()  # at most 4 rows a task
    known = _known(words, distinct)
    grams = freeze(frequent_prefixes(docs, known, np.sort(hot.view(np.uint64)), total, least, text, lang), "prefixes")
    one = words.select(F.col("h").alias("h1"), "lang", F.col("word").alias("w1"), F.col("c").alias("f1"))
    two = words.select(F.col("h").alias("h2"), F.col("word").alias("w2"), F.col("c").alias("f2"))
    pairs = grams.where("h3 is null").groupBy("h1", "h2").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    pairs = freeze(pairs.join(one, "h1").join(two, "h2"), "pairs")
    triples = grams.where("h3 is not null").select("h1", "h2", "h3", "a")
    tail = pairs.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("f23"), F.col("w2").alias("w3"), F.col("f2").alias("f3"))
    triples = freeze(triples.join(pairs.withColumnRenamed("a", "f12"), ["h1", "h2"]).join(tail, ["h2", "h3"]), "triples")

    def score(r_l, r_r):
        wide = lambda c: F.col(c).cast("decimal(18,0)")
        return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (wide("a") * wide("a")), wide(r_l) * wide(r_r))

    late = F.col("s2") < F.col("s1")
    triple = triples.withColumns({"s1": score("f1", "f23"), "s2": score("f12", "f3")}).select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(late, F.col("f12")).otherwise(F.col("f1")).alias("l"),
        F.when(late, F.col("f3")).otherwise(F.col("f23")).alias("r"), F.least("s1", "s2").alias("score"))
    inside = triples.select("h1", "h2", "a").unionByName(triples.select(F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a"))
    covered = inside.groupBy("h1", "h2").agg(F.max("a").alias("most"))
    pair = (pairs.join(covered, ["h1", "h2"], "left").where(F.coalesce(100 * F.col("most") < cover * F.col("a"), F.lit(True)))
            .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), score("f1", "f2").alias("score")))
    # First within shares of a language, so that one task gets at most `top` rows of each.
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    found = pair.unionByName(triple).withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(1 + math.isqrt(tasks))))
    some = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*best))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return ranked.join(whole, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
