"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

The leaves of a piece's tree hold ``rank << 24 | position`` of each adjacent pair
(or a sentinel), every inner node the smaller of its children.  So the root is
the leftmost pair of lowest rank.  A merge changes three leaves, and each change climbs to the root in
logarithmically many steps; encoding ends when the root holds the sentinel.
Pieces of up to 64 signs go through the trees in lock step, one numpy row per piece; a longer piece walks
its own tree, so a piece of a million signs takes n log n steps.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import tokens
from .store import map_batches

SPLIT = 64
_NONE = np.int64(2**62)


def _byte_signs() -> dict[int, str]:
    """Printable sign that stands for each byte: itself if printable, else the next free one from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


@functools.lru_cache(2)
def merges(path: str):
    """Ids of bytes (inside, at a word's end), sorted pair keys with rank and merged id, id -> token."""
    model = tokens.vocabulary(path)["model"]
    vocab, end = model["vocab"], model["end_of_word_suffix"]
    sign = _byte_signs()
    inner = np.array([vocab[sign[b]] for b in range(256)], np.int64)
    last = np.array([vocab[sign[b] + end] for b in range(256)], np.int64)
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    key = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
    made = np.array([vocab[a + b] for a, b in pairs], np.int64)
    order = np.argsort(key)
    names = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in tokens.vocabulary(path)["added_tokens"]}
    as_dict = dict(zip(key.tolist(), zip(range(len(pairs)), made.tolist())))
    return inner, last, key[order], order.astype(np.int64), made[order], as_dict, names


def _find(key, rank, made, left, right):
    """Rank (or the sentinel's) and merged id of pairs; a negative id is no token."""
    want = (left << 20) | right
    at = np.minimum(np.searchsorted(key, want), len(key) - 1)
    hit = (key[at] == want) & (left >= 0) & (right >= 0)
    return hit, rank[at], made[at]


def _lock_step(ids: np.ndarray, size: np.ndarray, tables) -> tuple[np.ndarray, np.ndarray]:
    """Merge rows of ``ids`` (padded with -1 to a power of two) through one segment tree per row."""
    key, rank, made = tables
    n, width = ids.shape
    rows = np.arange(n)
    nxt = np.broadcast_to(np.arange(1, width + 1), (n, width)).copy()
    prv = np.broadcast_to(np.arange(-1, width - 1), (n, width)).copy()
    tree = np.full((n, 2 * width), _NONE, np.int64)
    if width > 1:
        hit, r, _ = _find(key, rank, made, ids[:, :-1], ids[:, 1:])
        tree[:, width:2 * width - 1] = np.where(hit, r << 24 | np.arange(width - 1), _NONE)
        level = width
        while level > 1:
            tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level //= 2

    def put(r, leaf, value):
        node = leaf + width
        tree[r, node] = value
        node >>= 1
        while node[0]:
            tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])
            node >>= 1

    while width > 1:
        rows = rows[tree[rows, 1] != _NONE]
        if not len(rows):
            break
        i = tree[rows, 1] & 0xFFFFFF
        j = nxt[rows, i]
        _, _, new = _find(key, rank, made, ids[rows, i], ids[rows, j])
        ids[rows, i], ids[rows, j] = new, -1
        after = nxt[rows, j]
        nxt[rows, i] = after
        some = after < size[rows]
        prv[rows[some], after[some]] = i[some]
        put(rows, j, _NONE)
        right = np.where(some, ids[rows, np.minimum(after, width - 1)], -1)
        hit, r, _ = _find(key, rank, made, new, right)
        put(rows, i, np.where(hit, r << 24 | i, _NONE))
        before = prv[rows, i]
        has = before >= 0
        if has.any():
            sub, b = rows[has], before[has]
            hit, r, _ = _find(key, rank, made, ids[sub, b], new[has])
            put(sub, b, np.where(hit, r << 24 | b, _NONE))
    return ids[ids >= 0], (ids >= 0).sum(axis=1)


def _single(ids: list[int], table: dict) -> list[int]:
    """The same tree for one long piece, in plain lists."""
    n, width = len(ids), 1
    while width < n:
        width *= 2
    none = (1 << 62, 0)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    get = lambda a, b: table.get(a << 20 | b)
    tree = [none] * (2 * width)
    for i in range(n - 1):
        if found := get(ids[i], ids[i + 1]):
            tree[width + i] = (found[0], i)
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(leaf, value):
        node = leaf + width
        tree[node] = value
        node >>= 1
        while node:
            best = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
            node >>= 1

    while tree[1] is not none and tree[1] != none:
        i = tree[1][1]
        j = nxt[i]
        ids[i] = get(ids[i], ids[j])[1]
        ids[j] = -1
        nxt[i] = nxt[j]
        if nxt[i] < n:
            prv[nxt[i]] = i
        put(j, none)
        found = get(ids[i], ids[nxt[i]]) if nxt[i] < n else None
        put(i, (found[0], i) if found else none)
        if prv[i] >= 0:
            found = get(ids[prv[i]], ids[i])
            put(prv[i], (found[0], prv[i]) if found else none)
    return [x for x in ids if x >= 0]


def tree_merge(path: str, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the pieces by segment-tree merging, and the number of ids of each piece
    (the ``merge`` step of :class:`tokens.Encoder`)."""
    inner, last, key, rank, made, table, _ = merges(path)
    raw = [p.encode("utf-8") for p in pieces]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    ends = np.cumsum(size)
    signs = inner[np.frombuffer(b"".join(raw), np.uint8)]
    signs[ends - 1] = last[[r[-1] for r in raw]]
    lens = np.zeros(len(raw), np.int64)
    done: list = []
    width, low = 1, 0
    while width <= SPLIT:
        group = np.flatnonzero((size > low) & (size <= width))
        step = max(1, (1 << 19) // width)
        for part in (group[k:k + step] for k in range(0, len(group), step)):
            place = np.arange(width) - size[part][:, None]
            ids = np.where(place < 0, signs[np.minimum(place + ends[part][:, None], len(signs) - 1)], -1)
            flat, lens[part] = _lock_step(ids, size[part], (key, rank, made))
            done.append((part, flat))
        low, width = width, width * 2
    for k in np.flatnonzero(size > SPLIT):
        flat = np.array(_single(signs[ends[k] - size[k]:ends[k]].tolist(), table), np.int64)
        lens[k] = len(flat)
        done.append((np.array([k]), flat))
    out = np.zeros(int(lens.sum()), np.int64)
    base = np.cumsum(lens) - lens
    for part, flat in done:
        n = lens[part]
        out[np.arange(len(flat)) + np.repeat(base[part] - np.cumsum(n) + n, n)] = flat
    return out, lens


def encode(docs: DataFrame, path: str | None = None, text: str = "text", keys=("doc_id",), decode: bool = True) -> DataFrame:
    """Every row of ``docs`` as ``(*keys, ids array<int>, decoded string)``.

    Ids are those of the tokenizers library without added special tokens; ``decoded`` is the tokens joined
    by one space, as the library decodes a vocabulary without decoder.  Null and empty texts have no ids
    and decode to the empty text.  Repeated rows and keys are kept as they are; other columns are ignored.  A map over
    batches: no shuffle, memory bounded by one batch and one text.
    """
    path = path or tokens.default_path()
    src = docs.select(*keys, docs[text].alias("__text"))
    schema = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys) + ", ids array<int>, decoded string"

    def run(batches):
        enc = tokens.encoder(path, tree_merge)
        names = merges(path)[-1]
        table = np.array([names.get(i, "") for i in range(max(names) + 1)], object)
        for batch in batches:
            col = batch.column(len(keys))
            for at in range(0, len(col), 256):
                part = [x or "" for x in col.slice(at, 256).to_pylist()]
                got = list(enc.encode(part))
                text_ = [" ".join(table[x]) if decode else "" for x in got]
                off = np.concatenate([[0], np.cumsum([len(x) for x in got])]).astype(np.int32)
                flat = np.concatenate(got).astype(np.int32) if got else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(at, 256) for k in range(len(keys))), pa.ListArray.from_arrays(off, flat), pa.array(text_, pa.string())],
                    names=[*keys, "ids", "decoded"])

    return map_batches(src, run, schema)
