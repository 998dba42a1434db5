"""Encoding of whole texts with the word BPE vocabulary, piece by distinct piece.

A text is normalised and split into pieces (runs of letters, single digits, runs of other signs) with vectorised
numpy over code points; only the distinct pieces of a batch reach the merge step, through a bounded cache.
``merge`` returns the ids of each piece: :func:`library_merge` asks the tokenizers library,
:mod:`.bpe` merges with segment trees.  Texts with a special token's string, an apostrophe or
signs above U+012F take the normaliser and split of the library instead of the vectorised split.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import regex

from . import textkernel as K

VOCABULARY = "word_bpe_49k.json"
CACHE = 1_500_000
CHUNK = 1 << 21
_SIMPLE = 0x130


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


@functools.lru_cache(2)
def vocabulary(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


@functools.lru_cache(2)
def library(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


@functools.lru_cache(2)
def _piece_library(path: str):
    """The library without normaliser, over pieces that went through them already, one a line."""
    from tokenizers import Tokenizer, pre_tokenizers
    t = Tokenizer.from_file(path)
    t.normalizer = None
    t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split("\n", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    t.encode_special_tokens = True
    return t


@functools.lru_cache(2)
def _word_ends(path: str) -> np.ndarray:
    """Whether an id ends a piece."""
    model = vocabulary(path)["model"]
    ends = np.zeros(65536, bool)
    ends[[i for t, i in model["vocab"].items() if t.endswith(model["end_of_word_suffix"])]] = True
    return ends


def library_merge(path: str, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the pieces one after the other, and the number of ids of each piece."""
    lines = ["\n".join(pieces[k:k + 500]) for k in range(0, len(pieces), 500)]
    found = _piece_library(path).encode_batch_fast(lines, add_special_tokens=False)
    flat = np.concatenate([np.array(e.ids, np.uint16) for e in found])
    return flat, np.diff(np.flatnonzero(_word_ends(path)[flat]), prepend=-1)


@functools.lru_cache(1)
def _tables():
    """Per simple code point: kind (0 white space, 1 letter, 2 digit, 3 other) and lower case."""
    kind = np.zeros(_SIMPLE, np.uint8)
    low = np.arange(_SIMPLE, dtype=np.uint32)
    for c in range(_SIMPLE):
        s = chr(c)
        kind[c] = 1 if regex.match(r"\p{L}", s) else 2 if regex.match(r"\p{N}", s) else 0 if regex.match(r"\p{White_Space}", s) else 3
        low[c] = ord(s.lower())
    return kind, low, np.random.default_rng(7).integers(1, 2**63, _SIMPLE, dtype=np.uint64)


class Encoder:
    """Ids of texts, with a bounded cache from piece hash to ids (sorted arrays; emptied when full)."""

    def __init__(self, path: str, merge=library_merge):
        self.path, self.merge = path, merge
        self.specials = {t["content"]: t["id"] for t in vocabulary(path)["added_tokens"]}
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")")
        self.slow: dict[str, np.ndarray] = {}
        self._empty()

    def _empty(self):
        self.keys, self.base, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint16)

    def _lookup(self, keys: np.ndarray, strings) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of the sorted distinct ``keys`` lie in the pool; ``strings(ks)`` gives those pieces."""
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new) and len(self.keys) + len(new) > CACHE:
            self._empty()
            at, new = np.zeros(len(keys), np.int64), np.arange(len(keys))
        if len(new):
            flat, size = self.merge(self.path, strings(new))
            base = len(self.pool) + np.cumsum(size) - size
            self.pool = np.concatenate([self.pool, flat.astype(np.uint16)])
            self.base, self.size = np.insert(self.base, at[new], base), np.insert(self.size, at[new], size)
            self.keys = np.insert(self.keys, at[new], keys[new])
            at = np.searchsorted(self.keys, keys)
        return self.base[at], self.size[at]

    def _pieces(self, text: str) -> np.ndarray:
        """Slow path: special tokens, then the library's own normaliser and split."""
        out, lib = [], library(self.path)
        for k, part in enumerate(self.split.split(text)):
            if k % 2:
                out.append(np.array([self.specials[part]], np.uint16))
                continue
            part = lib.normalizer.normalize_str(part) if part else ""
            found = [part[a:b] for _, (a, b) in lib.pre_tokenizer.pre_tokenize_str(part)] if part else []
            missing = [p for p in dict.fromkeys(found) if p not in self.slow]
            if len(self.slow) + len(missing) > CACHE // 20:
                self.slow.clear()
                missing = list(dict.fromkeys(found))
            if missing:
                flat, size = self.merge(self.path, missing)
                self.slow.update(zip(missing, np.split(flat.astype(np.uint16), np.cumsum(size)[:-1])))
            out.extend(self.slow[p] for p in found)
        return np.concatenate(out) if out else np.zeros(0, np.uint16)

    def encode(self, texts: list[str]):
        """Yields the ids (uint16) of each text, in order."""
        i = 0
        while i < len(texts):
            j, size = i, 0
            while j < len(texts) and (j == i or size + len(texts[j]) <= CHUNK):
                size += len(texts[j])
                j += 1
            yield from self._chunk(texts[i:j])
            i = j

    def _chunk(self, texts: list[str]):
        kind, low, value = _tables()
        cp = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        odd = (cp >= _SIMPLE) | (cp == 39) | (cp == 60)
        bad = np.concatenate([[0], np.cumsum(odd)])
        bad = bad[off[1:]] > bad[off[:-1]]
        simple = [k for k in range(len(texts)) if not bad[k]]
        if len(simple) < len(texts):
            texts_ = [texts[k] for k in simple]
            cp = np.frombuffer("".join(texts_).encode("utf-32-le"), np.uint32)
            off = np.concatenate([[0], np.cumsum([len(t) for t in texts_])]).astype(np.int64)
        flat, bound = self._simple(cp, off, kind, low, value)
        at = 0
        for k in range(len(texts)):
            if bad[k]:
                yield self._pieces(texts[k])
            else:
                yield flat[bound[at]:bound[at + 1]]
                at += 1

    def _simple(self, cp, off, kind, low, value):
        n = len(cp)
        if n == 0:
            return np.zeros(0, np.uint16), np.zeros(len(off), np.int64)
        cls = kind[cp]
        chars = low[cp]
        begin = np.empty(n, bool)
        begin[0] = True
        begin[1:] = (cls[1:] != cls[:-1]) | (cls[1:] == 2)
        edge = off[(off > 0) & (off < n)]
        begin[edge] = True
        at = np.flatnonzero(begin)
        size = np.diff(np.append(at, n))
        power = K._powers(int(size.max()) + 1)
        h = np.add.reduceat(value[chars] * power[np.arange(n) - np.repeat(at, size)], at)
        keep = cls[at] != 0
        at, size, h = at[keep], size[keep], K.mix(h[keep] ^ size[keep].astype(np.uint64))
        distinct, first, back = np.unique(h, return_index=True, return_inverse=True)

        def strings(new):
            head, length = at[first[new]], size[first[new]] + 1
            ends = np.cumsum(length)
            lines = chars[np.minimum(np.arange(int(ends[-1])) + np.repeat(head - ends + length, length), n - 1)]
            lines[ends - 1] = 10
            return lines[:-1].astype("<u4").tobytes().decode("utf-32-le").split("\n")

        base, lens = self._lookup(distinct, strings)
        count = lens[back]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.pool[np.arange(total) + np.repeat(base[back] - ends + count, count)]
        piece = np.searchsorted(at, off)
        return flat, np.concatenate([[0], ends])[piece]


_encoders: dict = {}


def encoder(path: str, merge=library_merge) -> Encoder:
    """One encoder, and so one cache, per Python worker."""
    key = (path, merge)
    if key not in _encoders:
        _encoders[key] = Encoder(path, merge)
    return _encoders[key]
