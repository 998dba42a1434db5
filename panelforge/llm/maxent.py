"""Hashed maximum-entropy language model with a class-factored softmax.

    P(word | context) = P(class | context) * P(leaf | class, context) * P(word | leaf)

Classes are hashed word endings (and one for the end of a text).  The class softmax is log-linear in hashed features of the
context: the word before, the two classes before (n-gram), the words two and three before (skips).  Inside its class a word is
found by the first bits of its hash, a binary tree whose leaves hold about one word each until the depth reaches DEPTH.  Every
decision is logistic: its bias is the log ratio of the counts on both sides, so that without weights the tree gives exactly the
smoothed unigram, and its weights are hashed features of the decision with the words one, two and three before.
P(word | leaf) are exact smoothed counts.  A word never seen has its class' smoothed share, whatever the context.

The weights are trained by distributed gradient updates: every round each task sends the gradient of its share of the
training texts, the sums come to the driver as one array, and a preconditioned step is broadcast.  The rounds deal
all training texts out among them.  Both tables grow with the counted distinct words, up to MOST_ROWS and MOST_CELLS.

Word counts grow with the corpus.  The most frequent words (bounded number) are broadcast for scoring, every
other word of a text is looked up by a shuffle join, so no count is dropped or approximated.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from . import textkernel as K
from .store import freeze, map_batches, ship, tidy

CLASSES = 32
ROWS, MOST_ROWS = 1 << 14, 1 << 16
CELLS, MOST_CELLS = 1 << 16, 1 << 20
DEPTH = 12
DAMP = 2.0
SURE = 40.0
ROUNDS = 4
FEATURES = 4
RATE = 0.6
SMOOTH = 0.1
HEAD = 1_000_000
BLOCK = 256
CELL_BLOCK = 1 << 15
#: Arrays of so many tasks are summed at once.
ONE_LEVEL = 64
FLUSH = 1_500_000
#: Tokens worked on at once, and tokens that a gradient task is meant to have.
PART, TASK = 8192, 1 << 21
PAIRS = CLASSES // 2
#: Levels of a tree whose cells lie together, 2**LINE of them.
LINE = 4
TEXTS = 1 << 17
_U = np.uint64
END = _U(0x5EED0F7E87A11E5D)
_START = _U(0x0B0E61A7C0FFEE11)
_SALT = [_U(x) for x in (0x8CB92BA72F3D8DD7, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def _tokens(column):
    """Per chunk of texts: ``(i, j, hash, class, first)`` with the end token after each text's words."""
    raw, off = K.utf8(column)
    for i, j in K.chunks(off, TEXTS):
        part = raw[off[i]:off[j]]
        start, end, h, first = K.tokens(part, off[i:j + 1] - off[i])
        tail = np.zeros(len(h), np.uint64)
        low = part | ((part >= 65) & (part <= 90)).astype(np.uint8) * np.uint8(32)
        for back in range(1, 4):
            at = end - back
            tail = tail << _U(8) | np.where(at >= start, low[np.maximum(at, 0)] if len(part) else 0, 0).astype(np.uint64)
        cls = (1 + K.mix(tail) % _U(CLASSES - 1)).astype(np.uint8)
        h, cls = np.insert(h, first[1:], END), np.insert(cls, first[1:], 0)
        yield i, j, h, cls, first + np.arange(len(first))


def _contexts(h: np.ndarray, cls: np.ndarray, first: np.ndarray, rows: int = ROWS) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Row of the weight table for each feature of each token's context, and the mixed hashes of the words before."""
    place = np.arange(len(h)) - np.repeat(first[:-1], np.diff(first))

    def before(x, k, none):
        y = np.empty_like(x)
        y[:k] = none
        y[k:] = x[:-k] if len(x) > k else x[:0]
        y[place < k] = none
        return y

    c1, c2 = before(cls, 1, CLASSES), before(cls, 2, CLASSES)
    keys = [before(h, 1, _START), c1.astype(np.uint64) * _U(64) + c2 + _U(1), before(h, 2, _START), before(h, 3, _START)]
    mixed = [K.mix(k * s) for k, s in zip(keys, _SALT)]
    shift = _U(64 - (rows.bit_length() - 1))
    return [(m >> shift).view(np.int64) for m in mixed], [mixed[0], mixed[2], mixed[3]]


def _fit_size(want: float, least: int, most: int) -> int:
    """The power of two from ``least`` to ``most`` that holds ``want``."""
    return min(most, max(least, 1 << max(0, int(np.ceil(np.log2(max(1.0, want)))))))


@dataclass
class Tree:
    """Decisions inside the classes: ``bias`` by ``class << depth | node`` (nodes as in a heap), ``mass`` the smoothed
    counts of the leaves, ``cells`` the weights of hashed features."""

    depth: int
    bias: np.ndarray
    mass: np.ndarray
    cells: np.ndarray

    def logits(self, h: np.ndarray, cls: np.ndarray, before: list[np.ndarray]):
        """Per decision on the way to each token: ``(logit, bit, cells of the features)``; at most PART tokens at once, so that
        the arrays stay in the processor's cache."""
        top = (h >> _U(64 - self.depth)).view(np.int64)
        base = cls.astype(np.int64) << self.depth
        shift = _U(64 - (len(self.cells).bit_length() - 1 - LINE))
        for k in range(self.depth):
            node = top >> (self.depth - k)
            node |= 1 << k
            node |= base
            step = k % LINE
            if step == 0:  # a subtree of LINE levels lies together: one hash per feature for all its decisions
                name = node.view(np.uint64) * _SALT[2]
                lines = []
                for q in before:
                    x = q ^ name
                    x *= _SALT[0]
                    x >>= shift
                    x <<= _U(LINE)
                    lines.append(x.view(np.int64))
            inside = node & ((1 << step) - 1)
            inside |= 1 << step
            z = self.bias[node]
            at = [x + inside for x in lines]
            for x in at:
                z += self.cells[x]
            yield z, (top >> (self.depth - k - 1)) & 1, at

    def logs(self, h: np.ndarray, cls: np.ndarray, before: list[np.ndarray]) -> np.ndarray:
        """log10 of P(leaf | class, context) / mass of the leaf."""
        out = np.zeros(len(h), np.float64)
        for a in range(0, len(h), PART):
            part = slice(a, a + PART)
            odds = np.ones(len(h[part]), np.float64)  # product of 1 / P(decision), a few at a time within double range
            for k, (z, bit, _) in enumerate(self.logits(h[part], cls[part], [q[part] for q in before])):
                z *= 1 - 2 * bit.astype(np.float32)
                odds *= np.exp(z, out=z) + 1
                if k % 8 == 7:
                    out[part] -= np.log10(odds)
                    odds.fill(1.0)
            out[part] -= np.log10(odds)
        return out - np.log10(np.maximum(self.mass[self.leaf(h, cls)], 1e-300))

    def leaf(self, h: np.ndarray, cls: np.ndarray) -> np.ndarray:
        return cls.astype(np.int64) << self.depth | (h >> _U(64 - self.depth)).astype(np.int64)


def _tree(counts: DataFrame, fullest: int, distinct: int) -> Tree:
    """The tree over ``counts`` without weights, for ``fullest`` distinct words in one class; at most CLASSES * 2**DEPTH
    rows of 24 bytes come to the driver."""
    depth = min(DEPTH, max(1, int(np.ceil(np.log2(max(2, fullest))))))
    leaf = F.shiftleft(F.col("cls").cast("bigint"), depth).bitwiseOR(F.shiftrightunsigned("h", 64 - depth))
    t = counts.groupBy(leaf.alias("leaf")).agg((F.sum("c") + F.lit(SMOOTH) * F.count("*")).alias("m")).toArrow()
    mass = np.zeros(CLASSES << depth)
    mass[t.column("leaf").to_numpy()] = t.column("m").to_numpy()
    bias = np.zeros((CLASSES, 1 << depth), np.float32)
    level = mass.reshape(CLASSES, -1)
    for k in range(depth - 1, -1, -1):
        left, right = level[:, ::2], level[:, 1::2]
        ratio = np.log(np.maximum(right, 1e-300)) - np.log(np.maximum(left, 1e-300))
        bias[:, 1 << k:2 << k] = np.clip(ratio, -SURE, SURE)
        level = left + right
    return Tree(depth, bias.ravel(), mass, np.zeros(_fit_size(2 * distinct, CELLS, MOST_CELLS), np.float32))


def _logits(w: np.ndarray, bias: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """Of the classes; the weights are clipped, so that exponentials fit single precision."""
    z = w.take(rows[0], axis=0)
    z += bias
    for r in rows[1:]:
        z += w.take(r, axis=0)
    return z


def _log_softmax(w: np.ndarray, bias: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    z = _logits(w, bias, rows)
    return z - np.log(np.exp(z).sum(axis=1))[:, None]


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(h, cls, c)``: occurrences of every distinct token (64-bit hash); tasks combine before the shuffle."""
    def run(batches):
        held, size = [], 0

        def flush():
            h = np.concatenate([x for x, _, _ in held])
            c = np.concatenate([x for _, x, _ in held])
            n = np.concatenate([x for _, _, x in held])
            key, first, back = np.unique(h, return_index=True, return_inverse=True)
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(c[first].astype(np.int32)), pa.array(np.bincount(back, n, len(key)).astype(np.int64))],
                                              names=["h", "cls", "c"])

        for batch in batches:
            for _, _, h, cls, _ in _tokens(batch.column(0)):
                key, first, n = np.unique(h, return_index=True, return_counts=True)
                held.append((key, cls[first], n))
                size += len(key)
                if size > FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return map_batches(docs.select(docs[text]), run, "h bigint, cls int, c bigint").groupBy("h").agg(
        F.min("cls").alias("cls"), F.sum("c").alias("c"))


def _dealt(docs: DataFrame, tokens: float) -> DataFrame:
    """``docs`` of about ``tokens`` tokens in tasks of about TASK tokens, as far as it has partitions."""
    return docs.coalesce(max(1, int(np.ceil(tokens / TASK))))


def _gradient(docs: DataFrame, text: str, w: np.ndarray, bias: np.ndarray, tree: Tree, tokens: float) -> tuple[np.ndarray, ...]:
    """Gradient of the log-likelihood of all classes of ``docs`` and uses of each row, gradient and curvature of the tree's cells,
    summed over all tasks in two levels."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((w, bias, tree))
    width, n_rows, n_cells = CLASSES + 1, len(w), len(tree.cells)

    def run(batches):
        w, bias, tree = shared.value
        total = np.zeros((n_rows, width))
        cells = np.zeros((2, n_cells))
        # Two neighbouring classes are added as one complex number.
        g_sum, uses = np.zeros(n_rows * PAIRS, np.complex64), np.zeros(n_rows, np.float32)
        slope, bend = np.zeros((2, n_cells), np.float32)
        pair, one = np.arange(PAIRS), np.ones(PART, np.float32)
        some, size = False, 0

        def settle():  # before sums outgrow single precision; often enough to be worth a pass over the tables
            total[:, :CLASSES] += g_sum.view(np.float32).reshape(n_rows, CLASSES)
            total[:, CLASSES] += uses
            cells[0] += slope
            cells[1] += bend
            for x in (g_sum, uses, slope, bend):
                x.fill(0)

        for batch in batches:
            for _, _, h, cls, first in _tokens(batch.column(0)):
                rows, before = _contexts(h, cls, first, n_rows)
                for a in range(0, len(h), PART):
                    part = [r[a:a + PART] for r in rows]
                    own = cls[a:a + PART]
                    g = _logits(w, bias, part)
                    np.exp(g, out=g)
                    g *= (-1 / g.sum(axis=1))[:, None]
                    g[np.arange(len(g)), own] += 1
                    for r in part:
                        np.add.at(uses, r, one[:len(r)])
                        np.add.at(g_sum, ((r * PAIRS)[:, None] + pair).ravel(), g.view(np.complex64).ravel())
                    for z, bit, at in tree.logits(h[a:a + PART], own, [q[a:a + PART] for q in before]):
                        np.negative(z, out=z)
                        # np.add.at takes 20 times as long if the type is not numpy's own object; that of a broadcast array is a copy.
                        p = np.exp(z, out=z).view(np.float32)
                        p += 1
                        np.reciprocal(p, out=p)
                        off = bit.astype(np.float32)
                        off -= p
                        p -= p * p
                        for x in at:
                            np.add.at(slope, x, off)
                            np.add.at(bend, x, p)
                    some = True
                    size += len(g)
                    if size > min(n_cells // 4, MOST_CELLS):
                        settle()
                        size = 0
        if size:
            settle()
        if some:
            task = TaskContext.get().partitionId()
            blocks, more = range(0, n_rows, BLOCK), range(0, n_cells, CELL_BLOCK)
            names = [*blocks, *(-1 - b for b in more)]
            sent = [x.astype(np.float32).tobytes() for x in (*(total[b:b + BLOCK] for b in blocks), *(cells[:, b:b + CELL_BLOCK] for b in more))]
            yield pa.RecordBatch.from_arrays([pa.array([task] * len(names), pa.int32()), pa.array(names, pa.int32()), pa.array(sent, pa.binary())],
                                             names=["task", "block", "g"])

    def add(group):
        first = group.iloc[0]
        g = sum((np.frombuffer(x, np.float32) for x in group["g"]), np.float32(0))
        return group.iloc[:1].assign(task=first["task"], g=[g.astype(np.float32).tobytes()])

    # Every task sends its arrays once: as many as the texts are worth, whatever the number of files or cores; summed in two levels
    # if they are many.
    src = _dealt(docs.select(docs[text]), tokens)
    parts = map_batches(src, run, "task int, block int, g binary")
    tasks, schema = src.rdd.getNumPartitions(), "task int, block int, g binary"
    if tasks > ONE_LEVEL:
        parts = parts.withColumn("task", F.pmod("task", F.lit(max(1, int(tasks**0.5))))).groupBy("task", "block").applyInPandas(add, schema)
    rows = parts.groupBy("block").applyInPandas(add, schema).toPandas()
    total, cells = np.zeros((n_rows, width)), np.zeros((2, n_cells), np.float32)
    for block, g in zip(rows["block"], rows["g"]):
        x = np.frombuffer(g, np.float32)
        if block >= 0:
            total[block:block + BLOCK] = x.reshape(-1, width)
        else:
            cells[:, -1 - block:-1 - block + CELL_BLOCK] = x.reshape(2, -1)
    shared.destroy()
    return total[:, :CLASSES], total[:, CLASSES], cells[0], cells[1]


@dataclass
class Model:
    weights: np.ndarray
    bias: np.ndarray
    tree: Tree
    counts: DataFrame
    n_class: np.ndarray
    v_class: np.ndarray

    @property
    def tokens(self) -> int:
        return int(self.n_class.sum())

    @property
    def distinct(self) -> int:
        return int(self.v_class.sum())


def fit(docs: DataFrame, share: str, text: str = "text", rounds: int = ROUNDS) -> Model:
    """Train on all of ``docs``; ``share`` is an SQL expression that deals rows out to rounds 0 .. rounds-1, so that
    each text takes part in one gradient update and all of them in the counts."""
    ship(docs.sparkSession)
    counts = freeze(word_counts(docs, text), "counts")
    n, v = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in counts.groupBy("cls").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():  # one row per class
        n[r["cls"]], v[r["cls"]] = r["n"], r["v"]
    p = (n + 1) / (n + 1).sum()
    tree = _tree(counts, int(v.max()), int(v.sum()))
    bias, w = np.log(p).astype(np.float32), np.zeros((_fit_size(v.sum() / 8, ROWS, MOST_ROWS), CLASSES), np.float32)
    for k in range(rounds):
        g, uses, slope, bend = _gradient(docs.where(F.expr(share) == k), text, w, bias, tree, n.sum() / rounds)
        tidy(docs.sparkSession)
        # Curvature of a row: its uses times the variance of a class indicator; every token has FEATURES rows.
        step = RATE * g / (uses[:, None] * (p * (1 - p)) + 20)
        w = np.clip(w + np.clip(step, -1.5, 1.5), -6, 6).astype(np.float32)
        tree.cells = np.clip(tree.cells + np.clip(RATE * slope / (bend + DAMP), -1.5, 1.5), -6, 6).astype(np.float32)
    return Model(w, bias, tree, counts, n, v)


def _head(counts: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of at least the least power-of-two count that keeps them within ``limit``: sorted hashes and counts."""
    level = F.floor(F.log2("c")).cast("int")
    sizes = {r[0]: r[1] for r in counts.groupBy(level).count().collect()}  # at most 63 rows
    least, total = 63, 0
    while least > 0 and total + sizes.get(least - 1, 0) <= limit:
        least -= 1
        total += sizes.get(least, 0)
    t = counts.where(F.col("c") >= 2**least).select("h", "c").toArrow()  # at most `limit` rows of 16 bytes
    h, c = t.column("h").to_numpy().view(np.uint64), t.column("c").to_numpy()
    order = np.argsort(h)
    return h[order], c[order]


def score(docs: DataFrame, model: Model, keys=("doc_id",), text: str = "text", head: int = HEAD) -> DataFrame:
    """``(*keys, n_tokens, n_known, base_score, score)`` of every row's whole text, in sparse numpy batches.

    Null and empty texts hold just the end token.  Rows that repeat are scored each by itself; columns besides
    ``keys`` and ``text`` are ignored; an empty table gives no rows.
    """
    top, top_c = _head(model.counts, head)
    log_class = np.log10(model.n_class + SMOOTH * (model.v_class + 1))
    # Share of the class' seen words; the rest is that of a word never seen.
    log_seen = np.log10(np.maximum(model.n_class + SMOOTH * model.v_class, 1e-300)) - log_class
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.tree, top, np.log10(top_c + SMOOTH), log_class, log_seen))
    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches):
        w, bias, tree, top, top_log, log_class, log_seen = shared.value
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for i, j, h, cls, first in _tokens(batch.column(len(keys))):
                # Each distinct word of the chunk is looked up once, in the order of the table.
                own, back = np.unique(h, return_inverse=True)
                at = np.minimum(np.searchsorted(top, own), max(0, len(top) - 1))
                found = top[at] == own if len(top) else np.zeros(len(own), bool)
                known, logs = found[back], np.where(found, top_log[at], 0.0)[back] if len(top) else np.zeros(len(h))
                part = -log_class[cls]
                rows, before = _contexts(h, cls, first, len(w))
                for a in range(0, len(h), PART):
                    z = _logits(w, bias, [r[a:a + PART] for r in rows])
                    own = z[np.arange(len(z)), cls[a:a + PART]]
                    part[a:a + PART] += (own - np.log(np.exp(z, out=z).sum(axis=1))) / np.log(10)
                inside = tree.logs(h, cls, before)
                # What a seen word's score has above that of one never seen, besides its count.
                inside += log_seen[cls] + log_class[cls]
                part[known] += inside[known]
                rest = np.concatenate([[0], np.cumsum(~known)])[first]
                n = np.diff(first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(j - i)), *(batch.column(k).slice(i, j - i) for k in range(len(keys))), pa.array(n),
                     pa.array(n - np.diff(rest)), pa.array(np.add.reduceat(logs, first[:-1])), pa.array(np.add.reduceat(part, first[:-1])),
                     pa.ListArray.from_arrays(rest.astype(np.int32), pa.StructArray.from_arrays([pa.array(h[~known].view(np.int64)), pa.array(inside[~known])], ["h", "inside"]))],
                    names=["row", *keys, "n_tokens", "known", "logs", "part", "rest"])
                row += j - i

    rows = freeze(map_batches(docs.select(*keys, docs[text].alias("__text")), run,
                              f"row bigint, {kinds}, n_tokens bigint, known bigint, logs double, part double, rest array<struct<h:bigint,inside:double>>"), "scored")
    rare = (rows.select("row", F.explode("rest").alias("x")).groupBy("row", F.col("x.h").alias("h")).agg(F.count("*").alias("k"), F.sum("x.inside").alias("inside"))
            .join(model.counts.select("h", "c"), "h", "left")
            .groupBy("row").agg(F.sum(F.when(F.col("c").isNotNull(), F.col("k")).otherwise(0)).alias("more"),
                                F.sum(F.when(F.col("c").isNotNull(), F.col("inside")).otherwise(0.0)).alias("rest_part"),
                                F.sum(F.col("k") * F.log10(F.coalesce(F.col("c"), F.lit(0)) + SMOOTH)).alias("rest_logs")))
    total = float(np.log10(model.tokens + SMOOTH * (model.distinct + 1)))
    logs = F.col("logs") + F.coalesce("rest_logs", F.lit(0.0))
    return rows.drop("rest").join(rare, "row", "left").select(
        *keys, "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        (logs - F.col("n_tokens") * F.lit(total)).alias("base_score"), (logs + F.col("part") + F.coalesce("rest_part", F.lit(0.0))).alias("score"))
