"""Centroid clustering by a progressive search in the Walsh-Hadamard domain.

The transform of an integer vector is exact and keeps distances: the squared
differences of two vectors' 64 coefficients add up to 64 times their squared
distance.  Coefficients are ordered by sign changes, coarse to fine; a centroid's
sum over the first coefficients never exceeds its whole sum, so one that is
already worse than the finished sum of another centroid is eliminated, and only
the remaining pairs go on to the finer ones.  Pairs that stay have all 64
coefficients added, which gives the exact distance.

A round of the clustering is one pass: each task assigns its vectors and adds
them up by centroid, Spark adds up the tasks, and 16 centroids go round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import written

SIZE = 64               # components, a power of two
CENTROIDS, ROUNDS = 16, 3
SCALE, SEED = 64.0, 1
SAFE = 1 << 24          # components up to here keep 64 times a distance within 63 bits
LIMIT = 1 << 27         # components up to here keep a distance within 63 bits
STEP_ROWS = 8192        # vectors that a worker handles at a time


def walsh_order(size: int = SIZE) -> np.ndarray:
    """Rows of the natural-ordered transform by their number of sign changes."""
    h = transform(np.eye(size, dtype=np.int64))
    return np.argsort((np.diff(h, axis=1) != 0).sum(1), kind="stable")


def transform(x: np.ndarray) -> np.ndarray:
    """Unnormalised fast Walsh-Hadamard transform of each row, in integers."""
    n, step = x.shape[1], 1
    while step < n:
        pairs = x.reshape(len(x), n // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        step *= 2
    return x


class ProgressiveSearch:
    """Nearest of a few integer centroids, by exact coefficient sums."""

    def __init__(self, centroids: np.ndarray):
        self.size = centroids.shape[1]
        self.order = walsh_order(self.size)
        self.wide = bool(len(centroids)) and int(abs(centroids).max()) > SAFE
        self.coefficients = self._coefficients(centroids)
        self.finished_pairs = self.pairs = 0

    def _coefficients(self, x: np.ndarray) -> np.ndarray:
        return transform(x.astype(object) if self.wide else x)[:, self.order]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each row (ties: the smaller number)
        and the squared distance."""
        if not len(x):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not self.wide and int(abs(x).max()) > SAFE:
            self.wide, self.coefficients = True, self.coefficients.astype(object)   # Python integers: slower, any size
        a, c = self._coefficients(x), self.coefficients
        rows, cols = (g.ravel() for g in np.indices((len(x), len(c))))              # pairs still open
        sums = np.zeros(len(rows), a.dtype)
        best = np.full(len(x), -1)                                                  # centroid whose sum is finished
        bound = np.zeros(len(x), a.dtype)
        lo, hi = 0, 1
        while lo < self.size:
            d = a[rows, lo:hi] - c[cols, lo:hi]
            sums = sums + (d * d).sum(1)
            lead = self._leaders(rows, cols, sums, len(x))
            new = np.flatnonzero(lead != best)
            d = a[new] - c[lead[new]]
            whole = (d * d).sum(1)
            bound[new] = np.where(best[new] < 0, whole, np.minimum(whole, bound[new]))
            best[new] = lead[new]
            keep = sums <= bound[rows]                                              # equal sums may still tie
            rows, cols, sums = rows[keep], cols[keep], sums[keep]
            lo, hi = hi, min(2 * hi, self.size)
        self.pairs += len(x) * len(c)
        self.finished_pairs += len(rows)
        cluster = self._leaders(rows, cols, sums, len(x))
        at = np.zeros(len(x), a.dtype)
        won = cols == cluster[rows]
        at[rows[won]] = sums[won]
        return cluster, (at // self.size).astype(np.int64)

    @staticmethod
    def _leaders(rows: np.ndarray, cols: np.ndarray, sums: np.ndarray, n: int) -> np.ndarray:
        """The column of the least sum of each row, the smaller one of equal sums.
        Pairs come by row; every row has one."""
        starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        least = np.minimum.reduceat(sums, starts)
        hit = np.flatnonzero(sums == np.repeat(least, np.diff(np.r_[starts, len(rows)])))
        lead = np.zeros(n, np.int64)
        lead[rows[hit][::-1]] = cols[hit][::-1]
        return lead


def usable(vector: str, size: int = SIZE) -> Column:
    """Exactly ``size`` components, none null, NaN or infinite."""
    v = F.col(vector)
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) == size) & F.coalesce(whole, F.lit(False))


def _integers(vectors: pa.Array, size: int, scale: float) -> np.ndarray:
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    x = np.floor(scale * x)
    if len(x) and np.abs(x).max() > LIMIT:
        raise ValueError(f"a component of {np.abs(x).max():.0f} after scaling: squared distances may not fit 64 bits (limit {LIMIT})")
    return x.astype(np.int64)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, STEP_ROWS):
            yield b.slice(at, STEP_ROWS)


def seeds(vectors: DataFrame, k: int, scale: float, seed: int) -> np.ndarray:
    """The ``k`` vectors of the smallest SHA-256 of ``seed:id``, as integers.  Null
    ids count as the empty text; of equal ids the smaller vector comes first."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    v = F.transform("vector", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double"))
    rows = vectors.select(name.alias("name"), v.alias("v")).orderBy("name", "v").limit(k).collect()     # k rows
    x = np.array([r["v"] for r in rows], float).reshape(len(rows), len(rows[0]["v"]) if rows else 0)
    if len(x) and np.abs(x).max() > LIMIT:
        raise ValueError(f"a component of {np.abs(x).max():.0f} after scaling (limit {LIMIT})")
    return x.astype(np.int64)


def cluster_sums(vectors: DataFrame, centroids: np.ndarray, scale: float) -> list:
    """For each centroid the number and the component sums of its vectors: one
    row per centroid and task, added up by Spark (decimals: exact at any size)."""
    k, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, n, total = ProgressiveSearch(centroids), np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for b in _steps(batches):
            x = _integers(b.column(0), size, scale)
            cluster, _ = search.nearest(x)
            n += np.bincount(cluster, minlength=k)
            np.add.at(total, cluster, x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(n), pa.array(list(total), pa.list_(pa.int64()))],
                                         names=["cluster", "n", "total"])
    per_task = vectors.select("vector").mapInArrow(run, "cluster int, n bigint, total array<bigint>")
    return per_task.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i].cast("decimal(38,0)")) for i in range(size)]).alias("total")).collect()


def fit(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, scale: float = SCALE, seed: int = SEED) -> np.ndarray:
    """Integer centroids of ``vectors(id, vector)`` after ``rounds`` rounds: the
    exact floor of each component's mean; an empty centroid stays."""
    centroids = seeds(vectors, k, scale, seed)
    for _ in range(rounds if len(centroids) else 0):
        for r in cluster_sums(vectors, centroids, scale):
            if r["n"]:
                centroids[r["cluster"]] = [int(s) // r["n"] for s in r["total"]]
    return centroids


def assign(vectors: DataFrame, centroids: np.ndarray, scale: float = SCALE) -> DataFrame:
    """``id, cluster, distance`` of each of ``vectors(id, vector)``."""
    size = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = ProgressiveSearch(centroids)
        for b in _steps(batches):
            cluster, distance = search.nearest(_integers(b.column(1), size, scale))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])
    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.select("id", "vector").mapInArrow(run, f"id {kind}, cluster int, distance bigint")


def cluster_vectors(table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS,
                    scale: float = SCALE, seed: int = SEED, size: int = SIZE) -> DataFrame:
    """One row per usable vector: its id, ``cluster``, squared ``distance``,
    ``cluster_inertia`` and ``inertia`` (distances summed over its cluster and over
    all) and the ``centroid_sha256`` of its final centroid.

    Vectors that are null, of another size, or hold a null, NaN or infinite
    component give no row.  Null and repeated ids keep a row each; equal vectors
    share a cluster; with fewer than ``k`` usable vectors each is a centroid, of
    equal centroids the first takes all; an empty table gives no row.  A scaled
    component beyond 2^27 fails the job, as distances are 64-bit.  Other columns
    are not read."""
    rows = table.select(F.col(id_column).alias("id"), F.col(vector_column).alias("vector")).where(usable("vector", size))
    centroids = fit(rows, k, rounds, scale, seed)
    if not len(centroids):
        centroids = np.zeros((1, size), np.int64)           # no vector, so no row reads it
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    found = written(assign(rows, centroids, scale), "clusters")
    per = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    by = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("cluster") + 1)
    return found.select(F.col("id").alias(id_column), "cluster", "distance", by([per.get(i, 0) for i in range(len(names))]).cast("bigint").alias("cluster_inertia"),
                        F.lit(sum(per.values())).cast("bigint").alias("inertia"), by(names).alias("centroid_sha256"))
