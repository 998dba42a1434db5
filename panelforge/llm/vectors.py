"""Near-duplicate vectors through an inverted multi-index.

Two independent codebooks, one for each half of the vectors, span a grid of cells (i, j).  Every distinct
vector lies in the cell of its two nearest codewords.  A query walks the grid in the order of
d1(i) + d2(j), its squared distances to the codewords; both lists sorted, the cells it has visited when the sum
passes a bound form a staircase.  The bound is calibrated so that a vector at the very threshold, in any direction, is met with the
target recall (closer ones more surely).  All candidates are verified by cosine in double precision.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .store import components, freeze, map_batches

THRESHOLD = 0.98
SAMPLE = 20_000
TARGET = 0.9999
BLOCK = 4096
PER_CELL = 256


@dataclass
class Index:
    """Codebooks of both halves and the bound of the walk, by number of components."""
    books: dict


def _distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ book.T + (book * book).sum(1), 0)


def _kmeans(x: np.ndarray, k: int, rng, rounds: int = 12) -> np.ndarray:
    book = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = _distances(x, book).argmin(1)
        n = np.bincount(near, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, near, x)
        book = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], book)
    return book


def _excess(x: np.ndarray, books) -> list[np.ndarray]:
    """Squared distance to every codeword above that to the nearest, for both halves."""
    cut = x.shape[1] // 2
    out = []
    for part, book in ((x[:, :cut], books[0]), (x[:, cut:], books[1])):
        d = _distances(part, book)
        out.append(d - d.min(1, keepdims=True))
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_index(nodes: DataFrame, total: int, threshold: float = THRESHOLD, target: float = TARGET, sample: int = SAMPLE) -> Index:
    """Codebooks from at most ``sample`` distinct vectors (the first by hash), sized so that a cell holds about
    ``PER_CELL`` of ``total``; the walk's bound from vectors turned to the threshold in random directions."""
    size = 1 << max(4, min(10, int(np.ceil(np.log2(max(1.0, total / PER_CELL) ** 0.5)))))
    rows = nodes.orderBy("node").limit(sample).select("dim", "vector").toPandas()
    books = {}
    for dim, part in rows.groupby("dim"):
        rng = np.random.default_rng(1)
        x = _unit(np.frombuffer(b"".join(part["vector"]), np.float64).reshape(len(part), dim))
        cut = dim // 2
        pair = (_kmeans(x[:, :cut], size, rng), _kmeans(x[:, cut:], size, rng))
        q = x[rng.integers(0, len(x), 20_000)]
        r = rng.standard_normal(q.shape)
        r -= (r * q).sum(1, keepdims=True) * q
        r /= np.maximum(np.linalg.norm(r, axis=1, keepdims=True), 1e-12)
        b = threshold * q + (1 - threshold**2) ** 0.5 * r
        e, home = _excess(q, pair), [d.argmin(1) for d in _excess(b, pair)]
        at = np.arange(len(q))
        books[int(dim)] = (*pair, float(np.quantile(e[0][at, home[0]] + e[1][at, home[1]], target) * 1.05 + 1e-9))
    return Index(books)


def _nodes(df: DataFrame, vec_id: str, embedding: str, label: str) -> tuple[DataFrame, DataFrame]:
    """All rows with the node of their vector (null: links with nothing), and the distinct vectors."""
    x = F.transform(F.col("e"), lambda v: v.cast("double"))
    bad = F.exists("e", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = F.col("label").isNotNull() & F.col("e").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists("e", lambda v: v != 0)
    rows = (df.select(df[vec_id].alias("vec_id"), df[embedding].alias("e"), df[label].alias("label")).withColumn("e", x)
            .withColumn("node", F.when(usable, F.md5(F.to_json(F.struct("label", "e")).cast("binary")))))
    narrow = freeze(rows.select("vec_id", "node"), "vectors")
    distinct = rows.where("node is not null").groupBy("node").agg(F.first("label").alias("label"), F.first("e").alias("e"), F.count("*").alias("n"))

    def pack(batches):
        for b in batches:
            e = b.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), pa.array([len(v) for v in e], pa.int32()),
                                              pa.array([np.asarray(v, np.float64).tobytes() for v in e], pa.binary())],
                                             names=["node", "label", "n", "dim", "vector"])

    kind = rows.schema["label"].dataType.simpleString()
    return narrow, freeze(map_batches(distinct, pack, f"node string, label {kind}, n bigint, dim int, vector binary"), "nodes")


def _verify(threshold: float):
    """For one block of queries and one of indexed vectors that share a first codeword: each query's links, and
    edges that connect what the block links (a forest, not all pairs)."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out_a, out_b, out_n = [], [], []
        if len(left) and len(right):
            dim = int(left["dim"].iloc[0])
            q = np.frombuffer(b"".join(left["vector"]), np.float64).reshape(-1, dim)
            x = np.frombuffer(b"".join(right["vector"]), np.float64).reshape(-1, dim)
            nq, nx = np.sqrt((q * q).sum(1)), np.sqrt((x * x).sum(1))
            cells = np.unpackbits(np.frombuffer(b"".join(left["cells"]), np.uint8).reshape(len(q), -1), axis=1).astype(bool)
            j, names, own, n = right["j"].to_numpy(), right["node"].to_numpy(), left["node"].to_numpy(), right["n"].to_numpy()
            group = np.arange(len(x))
            for a in range(0, len(q), 512):
                c = (q[a:a + 512] @ x.T) / (nq[a:a + 512, None] * nx)
                hit = (c >= threshold) & cells[a:a + 512][:, j] & (own[a:a + 512, None] != names)
                links = hit @ n
                for k in np.flatnonzero(links):
                    linked = np.flatnonzero(hit[k])
                    which, first = np.unique(group[linked], return_index=True)
                    out_a += [own[a + k]] * len(which)
                    out_b += list(names[linked[first]])
                    out_n += [links[k]] + [0] * (len(which) - 1)
                    if len(which) > 1:
                        group[np.isin(group, which)] = which[0]
        return pd.DataFrame({"a": pd.Series(out_a, dtype=object), "b": pd.Series(out_b, dtype=object), "links": np.array(out_n, np.int64)})
    return run


def links(nodes: DataFrame, index: Index, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """Rows ``(a, b, links)``: edges that span the link graph's components; the sum of ``links`` by ``a`` counts the
    rows linked with a.

    Work is dealt by (label, first codeword) and split into blocks of about ``block`` indexed vectors by
    ``2 * block`` queries, so a crowded cell is many tasks and each a bounded one.
    """
    shared = nodes.sparkSession.sparkContext.broadcast(index.books)
    kind = nodes.schema["label"].dataType.simpleString()

    def place(batches):
        books = shared.value
        for b in batches:
            dims = b.column(3).to_numpy()
            for dim in np.unique(dims):
                rows = b.filter(pa.array(dims == dim))
                if int(dim) not in books:
                    # A length that the sample lacks: one cell for all of it.
                    books = books | {int(dim): (np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2)), 0.0)}
                one, two, bound = books[int(dim)]
                x = _unit(np.frombuffer(b"".join(rows.column(4).to_pylist()), np.float64).reshape(-1, dim))
                for a in range(0, len(x), 2048):
                    e = _excess(x[a:a + 2048], (one, two))
                    i, j = e[0].argmin(1), e[1].argmin(1)
                    row, visit = np.nonzero(e[0] <= bound)
                    cells = np.packbits(e[1][row] <= (bound - e[0][row, visit])[:, None], axis=1)
                    part = rows.slice(a, 2048).take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(visit.astype(np.int32)), pa.array((visit == i[row])), pa.array(j[row].astype(np.int32)),
                         pa.array([c.tobytes() for c in cells], pa.binary())],
                        names=["node", "label", "n", "dim", "vector", "i", "home", "j", "cells"])

    rows = freeze(map_batches(nodes, place, f"node string, label {kind}, n bigint, dim int, vector binary, i int, home boolean, j int, cells binary"), "cells")
    cell = ["label", "dim", "i"]
    load = (rows.groupBy(*cell).agg(F.count("*").alias("visits"), F.count_if("home").alias("members"))
            .select(*cell, F.ceil(F.col("members") / block).cast("int").alias("xs"), F.ceil(F.col("visits") / (2 * block)).cast("int").alias("qs")))
    # One row per label and codeword, at most labels * dims * 1024.
    rows = rows.join(load.where("xs > 0"), cell)
    salt = F.xxhash64("node")
    visitors = rows.withColumns({"qb": F.pmod(salt, "qs").cast("int"), "xb": F.explode(F.sequence(F.lit(0), F.col("xs") - 1))})
    members = rows.where("home").withColumns({"xb": F.pmod(salt, "xs").cast("int"), "qb": F.explode(F.sequence(F.lit(0), F.col("qs") - 1))})
    key = [*cell, "xb", "qb"]
    members = members.select(*key, "node", "n", "j", "vector").toDF(*key, "node", "n", "j", "vector")
    return visitors.select(*key, "node", "vector", "cells").groupBy(*key).cogroup(members.groupBy(*key)).applyInPandas(_verify(threshold), "a string, b string, links bigint")


def near_duplicates(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                    threshold: float = THRESHOLD, target: float = TARGET) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row.

    Two rows link when their labels are equal and the cosine of their vectors is at least ``threshold``.  A
    null label, and a vector that is null, empty, zero or holds null or non-finite components, links with nothing; so do
    vectors of different length.  Equal vectors are handled once and count as often as they
    occur; repeated ids are rows of their own.  An empty table gives no rows; other columns are ignored.
    """
    narrow, nodes = _nodes(df, vec_id, embedding, label)
    index = fit_index(nodes, nodes.count(), threshold, target)
    found = freeze(links(nodes, index, threshold), "links")
    roots = components(found.select("a", "b"))
    stats = (nodes.select("node", "n").join(found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links")), "node", "left")
             .join(roots, "node", "left")
             .select("node", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root")))
    rows = narrow.join(stats, "node", "left")
    least = rows.where("root is not null").groupBy("root").agg(F.min("vec_id").alias("component_id"))
    return rows.join(least, "root", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"))
