"""Toxicity by class-conditional Kneser-Ney models over the bytes of words.

A word is a run of ASCII letters and bytes above 0x7F, lower-cased.  Each class (toxic, ordinary) has its own
discounted counts of six-byte grams inside words; both back off to ONE chain of continuation counts pooled over the
classes, so a rare inflection is smoothed by the shared shape of words and only what the classes
themselves have seen tells them apart.  A text's evidence is the difference of its two log-likelihoods,
normalised by length over the whole text and, for the part of each word's difference above a floor, over its windows
of 128 words (an insult in a long text is not diluted, a word repeated a thousand times adds no slight
bias up); a logistic curve fitted on the training rows turns it into a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from . import textkernel as K
from .store import freeze, map_batches

ORDER = 6
DISCOUNT = 0.75
SAMPLE = 6000
WINDOW = 128
FLOOR = 5.0
CACHE = 1_000_000
_BETWEEN = np.ones(256, bool)
_BETWEEN[65:91] = _BETWEEN[97:123] = False
_BETWEEN[128:] = False
_LOW = np.arange(256, dtype=np.uint64)
_LOW[65:91] += 32
_END = 32


def _lowered(column):
    return K.utf8(pc.utf8_lower(column.cast(pa.large_string())))


def _grams(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Six-byte grams of words as integers (each word between five start marks and an end mark), and the
    position of each word's first gram."""
    size = end - start + 1
    first = np.cumsum(size) - size
    word = np.repeat(np.arange(len(start)), size)
    place = np.arange(len(word)) - first[word]
    at = start[word] + place
    key = np.zeros(len(word), np.uint64)
    for back in range(ORDER - 1, -1, -1):
        p = at - back
        ok = place >= back
        b = np.where(ok, _LOW[raw[np.clip(p, 0, len(raw) - 1)]], 0).astype(np.uint64)
        if back == 0:
            b[first + size - 1] = _END
        key = key << np.uint64(8) | b
    return key.astype(np.int64), first


def gram_counts(docs: DataFrame, text: str = "text", label: str = "toxic") -> DataFrame:
    """``(gram, toxic, ordinary)``: occurrences of each six-byte gram in texts of either class."""
    def run(batches):
        for batch in batches:
            raw, off = _lowered(batch.column(0))
            toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j in K.chunks(off):
                start, end, _, first = K.words(raw[off[i]:off[j]], off[i:j + 1] - off[i], _BETWEEN)
                if not len(start):
                    continue
                grams, at = _grams(raw[off[i]:off[j]], start, end)
                owner = np.repeat(np.repeat(toxic[i:j], np.diff(first)), np.diff(np.append(at, len(grams))))
                key, back = np.unique(grams, return_inverse=True)
                t = np.bincount(back, owner, len(key)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(t), pa.array(np.bincount(back, minlength=len(key)) - t)],
                                                 names=["gram", "toxic", "ordinary"])
    parts = map_batches(docs.select(docs[text], docs[label].cast("int")), run, "gram bigint, toxic bigint, ordinary bigint")
    return parts.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def _shared(grams: np.ndarray) -> np.ndarray:
    """Pooled Kneser-Ney probability of the last byte of each gram given the four before it, backing off
    order by order to the uniform distribution; ``grams`` are the distinct six-byte grams of both classes."""
    levels = []
    g = np.unique(grams)
    for k in range(ORDER - 1, 0, -1):
        mask = np.int64((1 << 8 * k) - 1)
        short, count = np.unique(g & mask, return_counts=True)
        levels.append((k, short, count))
        g = short
    p = np.full(len(grams), 1 / 256)
    for k, short, count in reversed(levels):
        context, inverse = np.unique(short >> 8, return_inverse=True)
        total = np.bincount(inverse, count)
        kinds = np.bincount(inverse)
        want = grams & np.int64((1 << 8 * k) - 1)
        c = count[np.searchsorted(short, want)]
        h = np.searchsorted(context, want >> 8)
        p = np.maximum(c - DISCOUNT, 0) / total[h] + DISCOUNT * kinds[h] / total[h] * p
    return p


class Model:
    """Log-likelihood ratios of grams: for a gram that either class has seen, and for the context of one that neither has."""

    def __init__(self, gram: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray):
        order = np.argsort(gram)
        self.gram = gram[order]
        context, inverse = np.unique(self.gram >> 8, return_inverse=True)
        below = _shared(self.gram) if len(gram) else np.zeros(0)
        logs, rest = [], []
        for c in (toxic[order].astype(float), ordinary[order].astype(float)):
            total = np.bincount(inverse, c, len(context))
            kinds = np.bincount(inverse, c > 0, len(context))
            gap = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
            p = np.maximum(c - DISCOUNT, 0) / np.maximum(total, 1)[inverse] + gap[inverse] * below
            logs.append(np.log(np.maximum(p, 1e-300)))
            rest.append(np.log(np.maximum(gap, 1e-300)))
        self.context = context
        self.ratio = (logs[0] - logs[1]).astype(np.float32) if len(gram) else np.zeros(0, np.float32)
        self.rest = (rest[0] - rest[1]).astype(np.float32) if len(gram) else np.zeros(0, np.float32)
        self.curve = np.zeros(4)
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros(0, np.float32)

    def _words(self, raw, start, end) -> np.ndarray:
        if not len(self.gram):
            return np.zeros(len(start), np.float32)
        grams, first = _grams(raw, start, end)
        at = np.minimum(np.searchsorted(self.gram, grams), len(self.gram) - 1)
        hit = self.gram[at] == grams
        ctx = np.minimum(np.searchsorted(self.context, grams >> 8), len(self.context) - 1)
        r = np.where(hit, self.ratio[at], np.where(self.context[ctx] == grams >> 8, self.rest[ctx], 0))
        return np.add.reduceat(r, first).astype(np.float32)

    def word_ratios(self, raw, start, end, h) -> np.ndarray:
        """Log-likelihood ratio of each word, through a bounded cache by word hash."""
        distinct, first, back = np.unique(h, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, distinct), max(0, len(self.keys) - 1))
        known = self.keys[at] == distinct if len(self.keys) else np.zeros(len(distinct), bool)
        out = np.zeros(len(distinct), np.float32)
        out[known] = self.values[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            out[new] = self._words(raw, start[first[new]], end[first[new]])
            if len(self.keys) + len(new) > CACHE:
                self.keys, self.values = distinct, out
            else:
                put = np.searchsorted(self.keys, distinct[new])
                self.keys, self.values = np.insert(self.keys, put, distinct[new]), np.insert(self.values, put, out[new])
        return out[back]

    def evidence(self, column) -> np.ndarray:
        """Per text: mean difference per word, excess over the floor in its richest window, excess per 100 words."""
        raw, off = _lowered(column)
        out = np.zeros((len(off) - 1, 3))
        for i, j in K.chunks(off):
            part = raw[off[i]:off[j]]
            start, end, h, first = K.words(part, off[i:j + 1] - off[i], _BETWEEN)
            if not len(start):
                continue
            r = self.word_ratios(part, start, end, h).astype(np.float64)
            total = np.concatenate([[0], np.cumsum(r)])
            excess = np.concatenate([[0], np.cumsum(np.maximum(r - FLOOR, 0))])
            n = np.diff(first)
            full = np.flatnonzero(n)
            # Windows start at every half window of a text and overlap by half; the last may be short.
            count = np.maximum(1, -(-n // (WINDOW // 2))) * (n > 0)
            owner = np.repeat(np.arange(j - i), count)
            low = first[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * (WINDOW // 2)
            high = np.minimum(low + WINDOW, first[owner + 1])
            best = np.zeros(j - i)
            best[full] = np.maximum.reduceat(excess[high] - excess[low], (np.cumsum(count) - count)[full])
            n = np.maximum(n, 1)
            out[i:j, 0], out[i:j, 1] = (total[first[1:]] - total[first[:-1]]) / n, best
            out[i:j, 2] = (excess[first[1:]] - excess[first[:-1]]) / n * 100
        return out

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_design(evidence) @ self.curve, -35, 35)))


def _design(e: np.ndarray) -> np.ndarray:
    """Intercept and the normalised differences (limited, so that no single text rules the fit)."""
    return np.column_stack([np.ones(len(e)), np.clip(e[:, 0], -1, 1), np.log1p(e[:, 1]), np.log1p(np.minimum(e[:, 2], 100))])


def fit_curve(e: np.ndarray, y: np.ndarray, ridge: float = 1e-2, weight: np.ndarray | None = None) -> np.ndarray:
    """Ridge logistic regression by Newton steps, each row counted ``weight`` times (once without weights)."""
    x = _design(e)
    m = np.ones(len(x)) if weight is None else weight
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (m * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (m * (y - p)) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, train: str, key: str = "doc_id", text: str = "text", label: str = "toxic",
        sample: int = SAMPLE) -> Model:
    """Fit on labelled rows for which the SQL condition ``train`` over the key holds.

    ``sample`` bounds the labelled documents of each class (the first in the order of a hash of the key); labels without a
    document among ``docs`` count for nothing.  Two
    thirds of them give the gram counts, the others the logistic curve, in which each stands for as many as its class
    has for one of the sample: the share of toxic texts is that of all labels, whatever the bound.  A key with several
    labels counts as toxic if one of them says so; null labels and keys are left out.  Without labelled rows every score is 0.5.
    """
    ids = (labels.where(labels[key].isNotNull() & labels[label].isNotNull()).groupBy(labels[key].alias("k"))
           .agg(F.max(labels[label].cast("int")).alias("y")).withColumnRenamed("k", key).where(train)
           .select(F.col(key).alias("k"), "y"))
    ids = freeze(ids.join(docs.select(docs[key].alias("k")), "k", "left_semi"), "labels", compact=True)
    sizes = {r["y"]: r["n"] for r in ids.groupBy("y").agg(F.count("*").alias("n")).collect()}  # one row per class
    order = F.xxhash64("k")
    chosen = ids.where("y = 1").orderBy(order, "k").limit(sample).unionByName(ids.where("y = 0").orderBy(order, "k").limit(sample))
    # At most 2 * sample rows of 12 bytes.
    rows = freeze(docs.select(docs[key].alias("k"), docs[text].alias("text")).join(F.broadcast(chosen), "k")
                  .select("text", "y", (F.pmod(order, F.lit(3)) == 0).alias("held")), "labelled")
    counts = gram_counts(rows.where("not held"), "text", "y").toArrow()
    model = Model(*(counts.column(c).to_numpy() for c in ("gram", "toxic", "ordinary")))

    def run(batches):
        for batch in batches:
            e = model.evidence(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*e.T, batch.column(1).to_numpy())], names=["a", "b", "c", "y"])

    found = map_batches(rows.where("held").select("text", "y"), run, "a double, b double, c double, y int").toPandas()
    y = found["y"].to_numpy()
    stands_for = [max(1.0, sizes.get(k, 0) / max(1, sample)) for k in (0, 1)]
    model.curve = fit_curve(found[["a", "b", "c"]].to_numpy(), y, weight=np.where(y == 1, stands_for[1], stands_for[0]))
    return model


def score(docs: DataFrame, model: Model, keys=("doc_id",), text: str = "text") -> DataFrame:
    """``(*keys, score)`` of every row's whole text, from 0 (ordinary) to 1 (toxic).

    Null and empty texts get the curve's value without evidence.  Rows may repeat; only ``text`` is looked at, so other columns
    cannot clash or matter.  A map over batches without shuffle; the broadcast model is bounded by the fit's sample.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys) + ", score double"

    def run(batches):
        m = shared.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keys))), pa.array(m.score(m.evidence(batch.column(len(keys)))))],
                                             names=[*keys, "score"])

    return map_batches(docs.select(*keys, docs[text].alias("__text")), run, schema)
