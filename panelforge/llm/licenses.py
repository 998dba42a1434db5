"""License scans by a generalised suffix automaton over the tokens of license templates.

Texts stream through the automaton word by word.  After each word its state and length give the matching statistics: the longest run
of words ending here that occurs in any template.  The automaton's suffix links name all shorter runs, so every place
of every template that the text agrees with over MATCH words or more is known; runs on one diagonal are one long match.
Long matches are chained, in order on both sides with bounded gaps, into spans; the share of a template's words
that its best span covers decides on the template's label.  Short phrases are templates too and are found exactly.

Words are handled as 64-bit hashes in numpy; all runs of a batch walk through the automaton in lock step.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import textkernel as K
from .store import map_batches

#: Phrase and label.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: Label and text of templates: statements of public licenses.
TEMPLATES = (
    ("mit-text", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("apache-2.0-notice", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or
agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY
KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("gpl-notice", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program
is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS
FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("bsd-text", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""),
    ("isc-text", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies."""),
    ("mpl-2.0-notice", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("mit-statement", "Released under the MIT License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
)

MATCH = 4
GAP = 24
SHARE = 0.75
TEXTS = 1 << 18
_SEP = np.zeros(256, bool)
_SEP[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


def hashed_words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts, and how many words lie before each text."""
    _, _, h, first = K.tokens(raw, off, _SEP)
    return h, first


def _hashes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return hashed_words(raw, np.array([0, len(raw)]))[0]


@dataclass
class Automaton:
    """Generalised suffix automaton in flat arrays.

    ``vocabulary`` sorted hashes of the templates' words; ``edge`` sorted ``state * len(vocabulary) + word`` with target
    ``to``; ``link`` and ``length`` by state.  ``first``/``template``/``end``/``most`` list, for each state, the places
    (template and number of its last word) of its longest run and of the longer ones among its suffixes, with the most words that agree.
    ``phrase`` is (states below it, words, label) of each phrase; ``sizes`` and ``labels`` belong to the templates.
    """

    vocabulary: np.ndarray
    edge: np.ndarray
    to: np.ndarray
    link: np.ndarray
    length: np.ndarray
    first: np.ndarray
    template: np.ndarray
    end: np.ndarray
    most: np.ndarray
    phrase: list
    sizes: np.ndarray
    labels: list


def build(templates=TEMPLATES, phrases=PHRASES, match: int = MATCH) -> Automaton:
    """The automaton of all templates and phrases; its size is linear in their words."""
    hashed = [_hashes(t) for _, t in templates] + [_hashes(p) for p, _ in phrases]
    vocabulary = np.unique(np.concatenate([*hashed, np.zeros(0, np.uint64)]))
    strings = [np.searchsorted(vocabulary, h).tolist() for h in hashed]
    step, link, length, ends = [{}], [-1], [0], [set()]

    def state(moves, suffix, size):
        step.append(moves)
        link.append(suffix)
        length.append(size)
        ends.append(set())
        return len(step) - 1

    def split(p, w, q):
        copy = state(dict(step[q]), link[q], length[p] + 1)
        link[q] = copy
        while p >= 0 and step[p].get(w) == q:
            step[p][w] = copy
            p = link[p]
        return copy

    for number, words in enumerate(strings):
        last = 0
        for place, w in enumerate(words):
            p, q = last, step[last].get(w)
            if q is not None:
                last = q if length[q] == length[p] + 1 else split(p, w, q)
            else:
                last = state({}, 0, length[p] + 1)
                while p >= 0 and w not in step[p]:
                    step[p][w] = last
                    p = link[p]
                if p >= 0:
                    q = step[p][w]
                    link[last] = q if length[q] == length[p] + 1 else split(p, w, q)
            if number < len(templates):
                ends[last].add((number, place))
    order = sorted(range(1, len(step)), key=length.__getitem__)
    for s in reversed(order):  # places are those of all longer runs that end alike
        ends[link[s]] |= ends[s]
    first, template, end, most = [0], [], [], []
    for s in range(len(step)):
        at, done = s, set()
        while at > 0:
            for x in sorted(ends[at] - done):
                if length[at] >= min(match, len(strings[x[0]])):
                    template.append(x[0])
                    end.append(x[1])
                    most.append(length[at])
            done |= ends[at]
            at = link[at]
        first.append(len(template))
    below = []
    for (text, label), words in zip(phrases, strings[len(templates):]):
        s = 0
        for w in words:
            s = step[s][w]
        under = np.zeros(len(step), bool)
        under[s] = bool(words)
        for t in order:
            under[t] |= under[link[t]]
        below.append((under, len(words), label))
    edges = sorted((s * len(vocabulary) + w, t) for s, moves in enumerate(step) for w, t in moves.items())
    as_int = lambda x: np.array(x, np.int64)
    return Automaton(vocabulary, as_int([e for e, _ in edges]), as_int([t for _, t in edges]), as_int(link), as_int(length), as_int(first),
                     as_int(template), as_int(end), as_int(most), below, as_int([len(s) for s in strings[:len(templates)]]), [name for name, _ in templates])


def matching_statistics(a: Automaton, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State and length of the longest run of words that ends at each word and occurs in a template.  Runs of words that
    templates know walk in lock step, the longest first."""
    n = len(h)
    states, lengths = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not n or not len(a.vocabulary):
        return states, lengths
    word = np.minimum(np.searchsorted(a.vocabulary, h), len(a.vocabulary) - 1)
    known = a.vocabulary[word] == h
    begins = np.zeros(n + 1, bool)
    begins[first] = True
    left = np.append(False, known[:-1])
    start = np.flatnonzero(known & (~left | begins[:-1]))
    right = np.append(known[1:], False)
    size = np.flatnonzero(known & (~right | begins[1:])) + 1 - start
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    active = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), "right")
    s, m = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
    for t, count in enumerate(active.tolist()):
        s, m = s[:count], m[:count]
        w = word[start[:count] + t]
        todo = np.arange(count)
        while len(todo):
            key = s[todo] * len(a.vocabulary) + w[todo]
            at = np.minimum(np.searchsorted(a.edge, key), len(a.edge) - 1)
            found = a.edge[at] == key
            go, stay = todo[found], todo[~found]
            s[go] = a.to[at[found]]
            m[go] += 1
            m[stay[s[stay] == 0]] = 0
            stay = stay[s[stay] > 0]
            s[stay] = a.link[s[stay]]
            m[stay] = a.length[s[stay]]
            todo = stay
        states[start[:count] + t], lengths[start[:count] + t] = s, m
    return states, lengths


def long_matches(a: Automaton, states: np.ndarray, lengths: np.ndarray, text: np.ndarray, match: int = MATCH) -> np.ndarray:
    """Rows ``(text, template, first word in the text, first word in the template, words)``: all runs of ``match`` words or more (or of a
    whole shorter template) that a text and a template share and that can't be longer."""
    i = np.flatnonzero(a.first[states + 1] > a.first[states])
    count = a.first[states[i] + 1] - a.first[states[i]]
    at = np.repeat(a.first[states[i]] - np.cumsum(count) + count, count) + np.arange(count.sum())
    i = np.repeat(i, count)
    words = np.minimum(a.most[at], lengths[i])
    long = words >= np.minimum(match, a.sizes[a.template[at]])
    i, at, words = i[long], at[long], words[long]
    template, end = a.template[at], a.end[at]
    order = np.lexsort((i, i - end, template, text[i]))
    i, template, end, words = i[order], template[order], end[order], words[order]
    doc, diagonal = text[i], i - end
    new = np.ones(len(i), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (template[1:] != template[:-1]) | (diagonal[1:] != diagonal[:-1]) | (i[1:] != i[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(i)) - 1 if len(head) else head
    size = words[head] + (tail - head)
    return np.stack([doc[head], template[head], i[tail] + 1 - size, end[tail] + 1 - size, size], axis=1) if len(head) else np.zeros((0, 5), np.int64)


def chain(rows: list[tuple[int, int, int]], gap: int = GAP) -> list[tuple[int, int, int, int, int]]:
    """Spans ``(text from, text to, template from, template to, covered words)`` from the matches ``(text from, template from,
    words)`` of one text with one template.

    A match follows another if it ends later on both sides and starts at most ``gap`` words behind its end; words that both hold count once.
    Every match takes the predecessor with which its chain covers most; each tree of chains gives its best one, unless its
    words lie within those of another that covers as much (a run that the template repeats).  Predecessors lie within a
    window of the text that the gap and the template's length bound.
    """
    rows = sorted(rows)
    best, before, begin, root = [], [], [], []
    low, longest = 0, max((r[2] for r in rows), default=0)
    for k, (x, y, n) in enumerate(rows):
        while rows[low][0] + longest + gap < x:
            low += 1
        value, prev = n, -1
        for j in range(low, k):
            u, v, m = rows[j]
            dx, dy = x - (u + m), y - (v + m)
            if dx <= gap and dy <= gap and x + n > u + m and y + n > v + m and v < y and u < x:
                got = best[j] + n - max(0, -dx, -dy)
                if got > value:
                    value, prev = got, j
        best.append(value)
        before.append(prev)
        begin.append(k if prev < 0 else begin[prev])
        root.append(begin[k])
    tops: dict[int, int] = {}
    for k, r in enumerate(root):
        if r not in tops or best[k] > best[tops[r]]:
            tops[r] = k
    spans = [(rows[r][0], rows[k][0] + rows[k][2], rows[r][1], rows[k][1] + rows[k][2], best[k]) for r, k in tops.items()]
    out, ends, most = [], [], []  # ends rise, the most words of a span that reaches so far fall
    for span in sorted(spans, key=lambda x: (x[0], -x[1], -x[4], x[2])):
        end, words = span[1], span[4]
        k = bisect.bisect_left(ends, end)
        if k < len(ends) and most[k] >= words:
            continue
        j = k
        while j and most[j - 1] <= words:
            j -= 1
        same = k < len(ends) and ends[k] == end
        ends[j:k + same], most[j:k + same] = [end], [words]
        out.append(span)
    return out


PLACES = "places array<struct<start:bigint,label:string>>"
SPANS = "spans array<struct<label:string,start:bigint,end:bigint,template_start:bigint,template_end:bigint,covered:bigint,share:double>>"


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, keys=("doc_id",), text: str = "text", match: int = MATCH, gap: int = GAP) -> DataFrame:
    """``(*keys, n_words, places, spans)`` of every row's whole text.

    ``places``: every place where a phrase's words stand, with its label; ``spans``: chained long matches with
    templates, words counted from 0, ends exclusive, ``share`` of the template's words covered.  Null and empty texts have no words and
    empty lists; repeated rows are scanned each; columns besides ``keys`` and ``text`` are ignored; an empty table gives no rows.
    A text is never cut: one that is longer than a chunk is a chunk of its own.
    """
    automaton = docs.sparkSession.sparkContext.broadcast(build(templates, phrases, match))
    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    place_type, span_type = (pa.struct([("start", pa.int64()), ("label", pa.string())]),
                             pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("template_start", pa.int64()),
                                        ("template_end", pa.int64()), ("covered", pa.int64()), ("share", pa.float64())]))

    def run(batches):
        a = automaton.value
        for batch in batches:
            raw, off = K.utf8(batch.column(len(keys)))
            for i, j in K.chunks(off, TEXTS):
                h, first = hashed_words(raw[off[i]:off[j]], off[i:j + 1] - off[i])
                of = np.repeat(np.arange(j - i), np.diff(first))
                states, lengths = matching_statistics(a, h, first)
                places = []
                for under, size, label in a.phrase:
                    at = np.flatnonzero(under[states] & (lengths >= size))
                    places += [(of[x], x + 1 - size - first[of[x]], label) for x in at.tolist()]
                places.sort()
                spans, group = [], {}
                for d, t, x, y, n in long_matches(a, states, lengths, of, match).tolist():
                    group.setdefault((d, t), []).append((x - int(first[d]), y, n))
                for (d, t), rows in sorted(group.items()):
                    size = int(a.sizes[t])
                    spans += [(d, (a.labels[t], x, to, y, till, n, n / size)) for x, to, y, till, n in chain(rows, gap)]

                def lists(rows, kind):
                    at = np.searchsorted(np.array([r[0] for r in rows], np.int64), np.arange(j - i + 1))
                    names = [f.name for f in kind]
                    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array([dict(zip(names, r[1])) for r in rows], kind))

                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(i, j - i) for k in range(len(keys))), pa.array(np.diff(first)),
                     lists([(d, (x, label)) for d, x, label in places], place_type), lists(spans, span_type)],
                    names=[*keys, "n_words", "places", "spans"])

    return map_batches(docs.select(*keys, docs[text].alias("__text")), run, f"{kinds}, n_words bigint, {PLACES}, {SPANS}")


def scan_files(spark: SparkSession, path: str, **options) -> DataFrame:
    """:func:`scan` of the text files under ``path``: one row per file, keyed by its name."""
    return scan(spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text")), keys=("file",), **options)


def verdict(scanned: DataFrame, share: float = SHARE) -> DataFrame:
    """``scanned`` with ``base_labels``, ``labels`` (comma-joined, distinct, sorted; templates count from ``share`` on) and ``score``:
    the largest share of a template or phrase that is there, 0 to 1."""
    base = F.transform("places", lambda p: p["label"])
    more = F.transform(F.filter("spans", lambda s: s["share"] >= share), lambda s: s["label"])
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    most = F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0))
    return scanned.withColumns({"base_labels": joined(base), "labels": joined(F.concat(base, more)),
                                "score": F.when(F.size("places") > 0, 1.0).otherwise(F.least(most, F.lit(1.0)))})
