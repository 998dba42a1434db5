"""Phrases, license scans and clusters against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.llm import clustering, licenses, phrases

LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id bigint, text string, lang string, h1 string, n bigint, word string, c int"


def _phrases(rows, least, top, cover):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    out = []
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        if len(p) == 2 and any(g == lang and len(q) == 3 and p in (q[:2], q[1:]) and b >= least and 100 * b >= cover * a for (g, q), b in f.items()):
            continue
        cuts = [(10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]], n[lang]))
    got = []
    for lang in {x[0] for x in out}:
        mine = sorted(x for x in out if x[0] == lang)[:top]
        got += [(lang, i, x[3].decode(), -x[2], x[4], x[5], x[6], -x[1]) for i, x in enumerate(mine, 1)]
    return sorted(got)


@pytest.fixture(scope="module")
def talk():
    rng = np.random.default_rng(11)
    vocab = [f"w{i}" for i in range(60)] + ["Über", "日本", "the", "The", "THE", "a\x0bb", "c-d"]
    share = 1 / np.arange(1, len(vocab) + 1)
    rows = []
    for k in range(120):
        w = list(rng.choice(vocab, int(rng.integers(0, 80)), p=share / share.sum()))
        for at in rng.integers(0, max(1, len(w)), 6):
            w.insert(int(at), "hot hot hot" if k % 3 else "New York City")
        rows.append(("".join(x + str(rng.choice([" ", "  ", "\t", ", ", ".", "\n", "? "], p=[.7, .05, .05, .05, .05, .05, .05])) for x in w), ["en", "de", None][k % 3]))
    rows += [(None, "en"), ("", "fr"), (" \t.\n", None), ("w1 " * 3000, "en"), ("solo", "xx")] + rows[:5]
    return rows


@pytest.mark.parametrize("least,top,cover", [(10, 2000, 50), (2, 40, 80)])
def test_collocations(spark, talk, least, top, cover):
    df = spark.createDataFrame([(i, t, g, "x", i, "y", 0) for i, (t, g) in enumerate(talk)], DOCS).repartition(5)
    got = sorted(tuple(r) for r in phrases.collocations(df, least=least, top=top, cover=cover).collect())
    assert got == _phrases(talk, least, top, cover) and len(got) > 50


def test_equal_partitions_are_prefix_counts():
    rng = np.random.default_rng(12)
    cols = [rng.integers(0, 6, 5000).astype(np.uint64) for _ in range(3)]
    weight = rng.integers(1, 4, 5000)
    for w, whole in ((None, 1), (None, 3), (weight, 3)):
        for depth, first, count in phrases.equal_partitions(cols, w, 20, whole):
            want = Counter()
            for i, x in enumerate(zip(*cols)):
                if all(x[:depth]):
                    want[x[:depth]] += 1 if w is None else int(w[i])
            if depth >= whole:
                want = {k: v for k, v in want.items() if v >= 20}
            assert {tuple(c[i] for c in cols[:depth]): n for i, n in zip(first, count.tolist())} == dict(want)
    assert list(phrases.equal_partitions([np.zeros(0, np.uint64)] * 3, None, 1, 1)) == []


def test_no_route_holds_a_hot_prefix(spark):
    """A third of all words are one triple: its pointers are counted before they are sent."""
    rows = [(i, "the same words " * 200 + f"and w{i} others", "en", "", 0, "", 0) for i in range(200)]
    df = spark.createDataFrame(rows, DOCS).repartition(8)
    got = {r["phrase"]: r for r in phrases.collocations(df).collect()}
    assert got["the same words"]["a"] == 40_000 and got["words the same"]["a"] == 199 * 200
    one, two, three = (np.repeat(np.array([x], np.uint64), 50_000) for x in (5, 6, 7))
    sent = list(phrases._route([one, two, three], np.array([5, 6, 7], np.uint64), 64))
    assert [(k, len(p), np.frombuffer(n, np.int64).tolist()) for k, _, p, n in sent] == [(4, 24, [50_000])]


def _words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER).encode())


def _places(words):
    out = []
    for text, label in licenses.PHRASES:
        p = [x.encode() for x in text.split()]
        out += [(i, label) for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    return sorted(out)


@pytest.fixture(scope="module")
def files():
    rng = np.random.default_rng(13)
    by = dict(licenses.TEMPLATES)
    vocab = sorted({w.decode() for _, t in licenses.TEMPLATES for w in _words(t)} | {"mit", "cc", "by", "gnu", "apache", "license"})
    rows = [None, "", "--- ///", "MIT", "MIT License", "mit-LICENSE cc by CC BY\nGNU General Public License", by["mit-text"], by["apache-2.0-notice"],
            "Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "x " * 50 + by["bsd-text"] + " y" * 50, by["bsd-text"][: len(by["bsd-text"]) // 3]]
    changed = by["gpl-notice"].split()
    for i in range(4, len(changed), 12):
        changed[i] = "other"
    rows.append(" ".join(changed))
    rows += [" ".join(rng.choice(vocab, 60)) for _ in range(60)]
    rows += ["the of and " * 40_000 + "apache license", "MIT License " * 500] + rows[3:8]
    return rows


def test_license_places(spark, files):
    df = spark.createDataFrame([(i, t, "x", 0, "y") for i, t in enumerate(files)], "doc_id bigint, text string, places string, n_words int, label string").repartition(3)
    out = {r["doc_id"]: r for r in licenses.verdict(licenses.scan(df)).collect()}
    assert sorted(out) == list(range(len(files)))
    for i, t in enumerate(files):
        w = _words(t)
        assert out[i]["n_words"] == len(w)
        assert [tuple(p) for p in out[i]["places"]] == _places(w), i
        labels = {x for x in out[i]["labels"].split(",") if x}
        base = {x for x in out[i]["base_labels"].split(",") if x}
        assert base == {x for _, x in _places(w)} <= labels and 0 <= out[i]["score"] <= 1
    for i, label, share in ((6, "mit-text", 1), (7, "apache-2.0-notice", 1), (8, "mit-statement", 1), (9, "cc-by-nc-4.0", 1), (10, "bsd-text", 1)):
        assert label in out[i]["labels"] and out[i]["score"] == share
    assert out[11]["labels"] == "" and 0.2 < out[11]["score"] < 0.5 and out[0]["score"] == 0
    gpl = [s for s in out[12]["spans"] if s["label"] == "gpl-notice"]
    assert len(gpl) == 1 and 0.75 <= gpl[0]["share"] < 1 and "gpl-notice" in out[12]["labels"]
    span = [s for s in out[10]["spans"] if s["label"] == "bsd-text"][0]
    assert (span["start"], span["template_start"]) == (50, 0) and span["end"] - span["start"] == span["template_end"] == span["covered"]


def test_license_empty_table(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert licenses.verdict(licenses.scan(none)).count() == 0
    assert phrases.collocations(spark.createDataFrame([], DOCS)).count() == 0


def test_matching_statistics_brute_force():
    rng = np.random.default_rng(14)
    templates = [(str(k), " ".join(rng.choice(list("abcd"), int(rng.integers(1, 25))))) for k in range(6)]
    a = licenses.build(templates, [("a b", "ab"), ("c", "c")], match=3)
    strings = [t.split() for _, t in templates] + [["a", "b"], ["c"]]
    grams = {tuple(s[i:j]) for s in strings for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    texts = [list(rng.choice(list("abcde"), int(rng.integers(0, 60)))) for _ in range(40)]
    raw = " ".join(" ".join(t) for t in texts).encode()
    parts = [" ".join(t).encode() for t in texts]
    raw, off = np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])
    h, first = licenses.hashed_words(raw, off)
    states, lengths = licenses.matching_statistics(a, h, first)
    of = np.repeat(np.arange(len(texts)), np.diff(first))
    found = {tuple(r) for r in licenses.long_matches(a, states, lengths, of, 3).tolist()}
    want = set()
    for d, t in enumerate(texts):
        for i in range(len(t)):
            n = max([k for k in range(1, i + 2) if tuple(t[i + 1 - k:i + 1]) in grams], default=0)
            assert lengths[first[d] + i] == n
        for k, s in enumerate(strings[:len(templates)]):
            for x in range(len(t)):
                for y in range(len(s)):
                    n = 0
                    while x + n < len(t) and y + n < len(s) and t[x + n] == s[y + n]:
                        n += 1
                    if n >= min(3, len(s)) and (x == 0 or y == 0 or t[x - 1] != s[y - 1]):
                        want.add((d, k, int(first[d]) + x, y, n))
    assert found == want


def test_scan_files(spark, tmp_path):
    for name, text in (("a.txt", "Released under the\nMIT License"), ("b.txt", "none")):
        (tmp_path / name).write_text(text)
    got = {r["file"].rsplit("/", 1)[1]: r["labels"] for r in licenses.verdict(licenses.scan_files(spark, str(tmp_path))).collect()}
    assert got == {"a.txt": "mit,mit-statement", "b.txt": ""}


def _clusters(rows, k, rounds, dim):
    kept = [(i, tuple(int(np.floor(64.0 * float(v))) for v in e)) for i, e in rows
            if e is not None and len(e) == dim and all(v is not None and np.isfinite(v) for v in e)]
    named = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [v for _, v in named[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        centres = [tuple(sum(x) // len(groups[n]) for x in zip(*groups[n])) if n in groups else c for n, c in enumerate(centres)]
    out = [(i, *near(v)[::-1]) for i, v in kept]
    per = Counter()
    for _, c, d in out:
        per[c] += d
    return sorted(((i if i is not None else -1), c, d, per[c], sum(per.values()), list(centres[c])) for i, c, d in out)


@pytest.mark.parametrize("k", [1, 5, 16])
def test_clusters_brute_force(spark, k):
    rng = np.random.default_rng(15)
    rows = [(i, (rng.integers(-4, 5, 6) / 64).tolist()) for i in range(150)]  # coarse: many ties and equal vectors
    rows += rows[:20] + [(None, rows[3][1]), (900, None), (901, [1.0] * 5), (902, [float("nan")] * 6), (903, [None] * 6), (904, [float("inf")] + [0.0] * 5), (905, [])]
    df = spark.createDataFrame([(i, e, 0, 1) for i, e in rows], "vec_id bigint, embedding array<double>, cluster int, v int").repartition(4)
    got, _ = clustering.centroid_clusters(df, k=k, dim=6)
    got = sorted(((r["vec_id"] if r["vec_id"] is not None else -1), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid"]) for r in got.collect())
    assert got == _clusters(rows, k, 3, 6)


def test_orchard_measures_less_than_all():
    rng = np.random.default_rng(16)
    centres = rng.integers(-10_000, 10_000, (64, 8))
    x = centres[rng.integers(0, 64, 3000)] + rng.integers(-200, 200, (3000, 8))
    for start in (None, np.zeros(3000, np.int64), rng.integers(0, 64, 3000)):
        c, d, measured = clustering.orchard(x, centres, start)
        whole = ((x[:, None] - centres[None]) ** 2).sum(2)
        assert (c == whole.argmin(1)).all() and (d == whole.min(1)).all() and measured < 0.8 * whole.size


def test_clusters_few_rows_and_large_numbers(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert clustering.centroid_clusters(spark.createDataFrame([], schema))[0].count() == 0
    few = spark.createDataFrame([(1, [0.5] * 64), (2, [0.25] * 64), (3, None)], schema)
    assert sorted((r["vec_id"], r["distance"], r["inertia"]) for r in clustering.centroid_clusters(few)[0].collect()) == [(1, 0, 0), (2, 0, 0)]
    with pytest.raises(Exception, match="64 bits"):
        clustering.centroid_clusters(spark.createDataFrame([(1, [2.0**21] * 64)], schema))[0].collect()


def test_registered_queries(spark):
    import duckdb

    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    for name in ("op11_phrases", "op13_clusters"):
        a, b = con.execute(E.oracle_sql()[name]).df(), E.queries()[name](spark, sf).toPandas()
        c = sorted(a.columns)
        assert c == sorted(b.columns)
        assert (a[c].sort_values(c).to_numpy() == b[c].sort_values(c).to_numpy()).all()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = E.queries()["op12_licenses"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        w = _words(docs[r["doc_id"]])
        p = _places(w)
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (
            len(w), len(p), p[0][0] if p else None, p[-1][0] if p else None, ",".join(sorted({x for _, x in p})))
