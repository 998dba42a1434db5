"""Centroid clustering of integer vectors by Orchard's search.

Every centroid keeps a list of the others, nearest first.  A vector starts at some centroid and walks its list; a
centroid that is closer (or as close with a smaller number) is jumped to and its list is walked from the start.
Centroids met once are marked and never measured again.  The walk stops at the first entry that lies strictly beyond twice the
vector's current distance: by the triangle inequality nothing further down can be as close.  All distances
are squared and exact in 64-bit integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .store import freeze, map_batches

K, ROUNDS, DIM, SCALE, SEED = 16, 3, 64, 64, 1
#: Four times a squared distance of 64 components below this stays within 64 bits.
LARGEST = 1 << 26
CELLS = 1 << 22


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = x - y
    return np.einsum("ij,ij->i", d, d)


def orchard(x: np.ndarray, centres: np.ndarray, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (ties: the smaller number) and squared distance of each row of ``x``, and how many distances
    were measured.  All rows walk in lock step; ``start`` is where each begins, any choice gives the same result."""
    k, n = len(centres), len(x)
    between = np.stack([_apart(centres, c[None]) for c in centres])
    near = np.argsort(between, axis=1, kind="stable")
    if start is None:
        part = slice(0, 8)
        guess = x[:, part].astype(np.float64) @ centres[:, part].astype(np.float64).T
        start = ((centres[:, part].astype(np.float64) ** 2).sum(1) - 2 * guess).argmin(1)
    here, d = start.copy(), _apart(x, centres[start])
    seen = np.zeros((n, k), bool)
    seen[np.arange(n), start] = True
    place, live, measured = np.zeros(n, np.int64), np.arange(n), n
    while len(live):
        to = near[here[live], place[live]]
        within = between[here[live], to] <= 4 * d[live]
        live, to = live[within], to[within]
        place[live] += 1
        new = ~seen[live, to]
        row, to = live[new], to[new]
        seen[row, to] = True
        found = _apart(x[row], centres[to])
        measured += len(row)
        closer = (found < d[row]) | ((found == d[row]) & (to < here[row]))
        row = row[closer]
        here[row], d[row], place[row] = to[closer], found[closer], 0
        live = live[place[live] < k]
    return here, d, measured


def integer_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """``(vec_id, v)`` of the rows whose vector has exactly ``dim`` components, none null or non-finite: each
    component x as floor(scale * x), x as double.  The other rows are left out."""
    e = df[embedding]
    usable = e.isNotNull() & (F.size(e) == dim) & ~F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return df.where(F.coalesce(usable, F.lit(False))).select(
        df[vec_id].alias("vec_id"), F.transform(e, lambda v: F.floor(F.lit(float(scale)) * v.cast("double"))).alias("v"))


def _matrix(column, dim: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.int64)
    if len(x) and not (-LARGEST < x.min() and x.max() < LARGEST):
        raise ValueError(f"scaled components must lie within +-{LARGEST}: squared distances would not fit in 64 bits")
    return x


def first_centres(vectors: DataFrame, k: int = K, seed: int = SEED) -> np.ndarray:
    """The ``k`` vectors (or all, if fewer) of the smallest sha256 of ``seed:vec_id``; equal hashes by components,
    null ids last."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.orderBy(name.asc_nulls_last(), "v").limit(k).collect()  # k rows
    return np.array([r["v"] for r in rows], np.int64)


def _nearest(vectors: DataFrame, centres: np.ndarray, each, schema: str) -> DataFrame:
    """``each(ids, vectors, cluster, distance)`` yields the record batches of a part; ``each(None, ...)`` those of the
    end of a task."""
    shared = vectors.sparkSession.sparkContext.broadcast(centres)
    k, dim = centres.shape

    def run(batches):
        c, rows = shared.value, max(1, CELLS // max(k, dim))
        work = each(k, dim)
        for b in batches:
            for a in range(0, b.num_rows, rows):
                part = b.slice(a, rows)
                x = _matrix(part.column(1), dim)
                yield from work(part.column(0), x, *orchard(x, c)[:2])
        yield from work(None, None, None, None)

    return map_batches(vectors.select("vec_id", "v"), run, schema)


def _sums(k: int, dim: int):
    n, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)

    def add(ids, x, cluster, _):
        if ids is not None:
            order = np.argsort(cluster, kind="stable")
            which, first = np.unique(cluster[order], return_index=True)
            total[which] += np.add.reduceat(x[order], first, axis=0)
            n[which] += np.diff(np.append(first, len(order)))
        else:
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(used, dim)), pa.array(np.tile(np.arange(dim), len(used))),
                                              pa.array(np.repeat(n[used], dim)), pa.array(total[used].ravel())], names=["cluster", "i", "n", "total"])

    return add


def _rows(k: int, dim: int):
    def add(ids, x, cluster, distance):
        if ids is not None:
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return add


def move(vectors: DataFrame, centres: np.ndarray) -> np.ndarray:
    """One round: every non-empty centroid becomes its vectors' componentwise floor(sum / count), empty ones stay.
    Tasks send one row per centroid and component; k * dim sums reach the driver."""
    sums = _nearest(vectors, centres, _sums, "cluster bigint, i bigint, n bigint, total bigint").groupBy("cluster", "i").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    new = centres.copy()
    for r in sums.collect():
        new[r["cluster"], r["i"]] = int(r["total"]) // r["n"]
    return new


def assign(vectors: DataFrame, centres: np.ndarray) -> DataFrame:
    """``(vec_id, cluster, distance)``: number of the nearest centroid and squared distance."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    return _nearest(vectors, centres, _rows, f"vec_id {kind}, cluster int, distance bigint")


def centroid_clusters(df: DataFrame, k: int = K, rounds: int = ROUNDS, vec_id: str = "vec_id", embedding: str = "embedding",
                      dim: int = DIM, scale: int = SCALE, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """Rows ``(vec_id, cluster, distance, cluster_inertia, inertia, centroid)`` of the kept vectors, and the centroids.

    Vectors that are null, of another length or with null or non-finite components are left out.  Repeated rows count
    each; a null id is kept, but starts no centroid as long as others are there.  With fewer than ``k`` vectors each starts a
    centroid; an empty table gives no rows.  Other columns are ignored.  Scaled components from 2^26 on raise.
    """
    spark = df.sparkSession
    vectors = freeze(integer_vectors(df, vec_id, embedding, dim, scale), "integers")
    centres = first_centres(vectors, k, seed)
    if not len(centres):
        kind = vectors.schema["vec_id"].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid array<bigint>"), centres
    for _ in range(rounds):
        centres = move(vectors, centres)
    found = freeze(assign(vectors, centres), "assigned")
    per = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows
    whole = sum(per.values())
    about = spark.createDataFrame([(c, s, whole, centres[c].tolist()) for c, s in per.items()],
                                  "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return found.join(F.broadcast(about), "cluster"), centres  # at most k rows are broadcast
