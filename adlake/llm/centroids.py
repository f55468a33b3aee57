"""Exact integer k-means with bounded vectors (Shallot search).

Every vector keeps, from round to round, its centroid, the centroid that was
second nearest, an upper bound of the distance to the first and a lower bound
of the distance to all others.  A round moves the bounds by how far the
centroids moved.  Vectors whose upper bound stays below the lower bound (or
below half the way from their centroid to its nearest neighbour) keep their
centroid without a distance being computed.  The others start from the closer
of the two remembered centroids and scan that centroid's neighbours in order
of distance: one further away than the sum of the distances to the start and
to the second best so far can be neither first nor second, and that search
ball shrinks with every better second that turns up.  Distances of survivors
are compared as exact integers, ties by the smaller number; the bounds are
doubles with a margin far above their rounding, so no tie is cut off.

A round is one pass over the vectors: the task that finds the centroids also
sums its vectors by centroid.  What leaves the tasks is the moved bounds
(written to the shared folder) and a row of sums for each centroid and Arrow
batch; the driver sees ``k`` rows of exact sums.

Defined results:

* vectors of another number of components, with a null or a non-finite
  component, or null, are left out (no row in the result);
* a component is ``floor(scale * x)``; beyond 2**26 in size squared distances
  would leave 64 bits, and the job ends with an error instead of a wrong sum;
* the first centroids are the vectors with the smallest SHA-256 of
  ``<seed>:<id>``; rows of equal ids by their components; rows without an id
  come last and keep their null id;
* repeated rows are vectors of their own; fewer vectors than ``k`` give as many
  centroids as there are; an empty table gives an empty result;
* extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import arrow, stage, unstage

#: Components up to this size keep 4096 of their squared differences within 64 bits.
MAX_COMPONENT = 1 << 26
#: The margin of the bounds, relative; doubles of square roots are right to 2**-52.
MARGIN = 1e-9

_STATE = "id {id}, vector array<int>, near int, second int, upper double, lower double, sums array<bigint>, n bigint"


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    """(id, vector array<int>): the usable vectors as integers ``floor(scale * x)``."""
    v = F.col(vector_col)
    usable = v.isNotNull() & (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = df.where(usable).select(F.col(id_col).alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("w"))
    fits = F.forall("w", lambda x: F.abs(x) <= MAX_COMPONENT)
    vector = F.when(fits, F.col("w").cast("array<int>")).otherwise(F.raise_error(F.lit("a component beyond 2**26 after scaling")).cast("array<int>"))
    return scaled.select("id", vector.alias("vector"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of their ids (a top-k, k rows)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = vectors.select(key.alias("key"), "vector").orderBy(F.col("key").asc_nulls_last(), "vector").limit(k).collect()
    return np.array([r["vector"] for r in rows], np.int64)


class Centroids:
    """What a task needs to know of ``k`` centroids: their distances, and the
    neighbours of each in order."""

    def __init__(self, at: np.ndarray, before: np.ndarray | None = None):
        self.at, k = at, len(at)
        apart = np.sqrt(((at[:, None, :] - at[None, :, :]) ** 2).sum(2).astype(np.float64))
        self.order = np.argsort(apart + np.diag(np.full(k, -1.0)), axis=1, kind="stable")[:, 1:]
        self.apart = np.take_along_axis(apart, self.order, 1)
        self.half = self.apart[:, 0] / 2 * (1 - MARGIN) if k > 1 else np.full(k, np.inf)
        moved = np.zeros(k) if before is None else np.sqrt(((at - before) ** 2).sum(1).astype(np.float64)) * (1 + MARGIN)
        self.moved = moved
        # The furthest move of any other centroid.
        top = np.sort(moved)[::-1]
        self.others = np.where(moved == top[0], top[1] if k > 1 else 0.0, top[0]) if (moved == top[0]).sum() == 1 else np.full(k, top[0])

    def squared(self, x: np.ndarray, to: np.ndarray) -> np.ndarray:
        d = x - self.at[to]
        return np.einsum("ij,ij->i", d, d)


def search(c: Centroids, x: np.ndarray, near: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, ...]:
    """The nearest and second nearest centroid of each vector, with bounds, and
    the number of distances computed.  ``near`` and ``second`` are those
    remembered (any two different centroids at first, with no bounds)."""
    near, second = near.copy(), second.copy()
    upper = upper + c.moved[near]
    lower = np.maximum(lower - c.others[near], 0.0)
    if len(c.at) == 1:
        return near, second, upper, lower, 0
    computed = 0
    rows = np.flatnonzero(upper >= np.maximum(lower, c.half[near]))
    first = c.squared(x[rows], near[rows])
    computed += len(rows)
    upper[rows] = np.sqrt(first.astype(np.float64)) * (1 + MARGIN)
    open_ = upper[rows] >= np.maximum(lower[rows], c.half[near[rows]])
    rows, first = rows[open_], first[open_]
    if not len(rows):
        return near, second, upper, lower, computed
    xs, a, b = x[rows], near[rows], second[rows]
    other = c.squared(xs, b)
    computed += len(rows)
    closer = (other < first) | ((other == first) & (b < a))
    a, b = np.where(closer, b, a), np.where(closer, a, b)
    d1, d2 = np.where(closer, other, first), np.where(closer, first, other)
    start, radius = a.copy(), np.sqrt(d1.astype(np.float64))
    best, runner = a, b
    on = np.arange(len(rows))
    for j in range(c.order.shape[1]):
        # The ball about the start: beyond it, nothing is nearer than the second best.
        on = on[c.apart[start[on], j] <= (radius[on] + np.sqrt(d2[on].astype(np.float64))) * (1 + MARGIN)]
        if not len(on):
            break
        to = c.order[start[on], j]
        new = (to != best[on]) & (to != runner[on])
        now, to = on[new], to[new]
        if not len(now):
            continue
        d = c.squared(xs[now], to)
        computed += len(now)
        first_ = (d < d1[now]) | ((d == d1[now]) & (to < best[now]))
        second_ = ~first_ & ((d < d2[now]) | ((d == d2[now]) & (to < runner[now])))
        w = now[first_]
        d2[w], runner[w] = d1[w], best[w]
        d1[w], best[w] = d[first_], to[first_]
        w = now[second_]
        d2[w], runner[w] = d[second_], to[second_]
    near[rows], second[rows] = best, runner
    upper[rows] = np.sqrt(d1.astype(np.float64)) * (1 + MARGIN)
    lower[rows] = np.sqrt(d2.astype(np.float64)) * (1 - MARGIN)
    return near, second, upper, lower, computed


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.int64)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The rows of a matrix as a list column."""
    n, dim = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * dim), pa.array(values.ravel(), kind))


def _round(c: Centroids, first: bool):
    """Rows with their moved bounds, and for each batch a row of sums for each centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dim = c.at.shape
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _matrix(batch.column("vector"), dim)
            if first:
                near, second = np.zeros(n, np.int64), np.full(n, min(1, k - 1))
                upper, lower = np.full(n, np.inf), np.zeros(n)
            else:
                near, second = (batch.column(i).to_numpy().astype(np.int64) for i in ("near", "second"))
                upper, lower = (batch.column(i).to_numpy() for i in ("upper", "lower"))
            near, second, upper, lower, _ = search(c, x, near, second, upper, lower)
            some, at = np.unique(near, return_inverse=True)
            sums = np.zeros((len(some), dim), np.int64)
            np.add.at(sums, at, x)
            ids, vector = batch.column("id"), batch.column("vector")
            m = len(some)
            count = np.bincount(at, minlength=m)
            yield pa.RecordBatch.from_arrays(
                [ids, vector, *(pa.array(v, t) for v, t in ((near, pa.int32()), (second, pa.int32()), (upper, pa.float64()), (lower, pa.float64()))),
                 pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.int64())],
                names=["id", "vector", "near", "second", "upper", "lower", "sums", "n"])
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, ids.type), pa.nulls(m, vector.type), pa.array(some, pa.int32()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.float64()), pa.nulls(m, pa.float64()),
                 _lists(sums, pa.int64()), pa.array(count, pa.int64())],
                names=["id", "vector", "near", "second", "upper", "lower", "sums", "n"])

    return run


def _distances(c: Centroids):
    """The last assignment, with the exact squared distance of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim = c.at.shape[1]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("vector"), dim)
            state = [batch.column(i).to_numpy() for i in ("near", "second", "upper", "lower")]
            near, *_ = search(c, x, state[0].astype(np.int64), state[1].astype(np.int64), *state[2:])
            yield arrow({"id": (batch.column("id"), None), "cluster": (near, pa.int32()), "distance": (c.squared(x, near), pa.int64())})

    return run


def _moved(sums: DataFrame, at: np.ndarray) -> np.ndarray:
    """The centroids as floors of exact means (k rows reach the driver); empty ones stay."""
    parts = sums.select("near", "n", F.posexplode("sums").alias("i", "s"))
    wide = parts.groupBy("near", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    rows = wide.groupBy("near").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("i", "s"))).alias("s")).collect()
    moved = at.copy()
    for r in rows:
        moved[r["near"]] = [int(x["s"]) // r["n"] for x in r["s"]]
    return moved


def shallot_clusters(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 16, dim: int = 64, scale: int = 64, rounds: int = 3, seed: int = 1) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector.

    ``rounds`` times all vectors are assigned and the centroids moved to the
    floors of their means, then all are assigned once more.
    """
    spark = df.sparkSession
    id_type = df.schema[id_col].dataType.simpleString()
    state = stage(integer_vectors(df, id_col, vector_col, dim, scale), "vectors")
    vectors = state
    at, before = first_centroids(vectors, k, seed), None
    if not len(at):
        unstage(state)
        return spark.createDataFrame([], f"id {id_type}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    for i in range(rounds):
        told = stage(vectors.mapInArrow(_round(Centroids(at, before), i == 0), _STATE.format(id=id_type)), "vectors")
        unstage(state)
        state = told
        at, before = _moved(state.where("sums is not null"), at), at
        vectors = state.where("sums is null")
    if not rounds:
        vectors = vectors.select("id", "vector", F.lit(0).alias("near"), F.lit(min(1, len(at) - 1)).alias("second"), F.lit(float("inf")).alias("upper"), F.lit(0.0).alias("lower"))
    found = stage(vectors.select("id", "vector", "near", "second", "upper", "lower").mapInArrow(_distances(Centroids(at, before)), f"id {id_type}, cluster int, distance bigint"), "clusters")
    unstage(state)
    inertia = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    named = [(j, int(inertia.get(j, 0)), sum(inertia.values()), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for j, c in enumerate(at)]
    facts = spark.createDataFrame(named, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
