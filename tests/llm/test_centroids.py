"""Integer k-means by Shallot search against plain assignment of every vector."""

import hashlib
import math
import random

import numpy as np
import pytest

from adlake.llm import centroids, queries


def brute(rows, k, dim, scale, rounds, seed=1):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    at = [list(v) for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(at))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        at = [[sum(x) // len(groups[j]) for x in zip(*groups[j], strict=True)] if j in groups else c for j, c in enumerate(at)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = {}
    for _, j, d in found:
        inertia[j] = inertia.get(j, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), sha[j]) for i, j, d in found), key=str)


def run(spark, rows, k, dim, scale, rounds, extra=False):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    if extra:
        df = df.selectExpr("*", "1 as id", "vec_id as near", "'x' as vector", "2 as cluster")
    return sorted(map(tuple, centroids.shallot_clusters(df, k=k, dim=dim, scale=scale, rounds=rounds).collect()), key=str)


@pytest.mark.parametrize(("k", "dim", "scale", "rounds"), [(16, 3, 4, 3), (5, 2, 2, 4), (1, 2, 64, 2), (2, 1, 1, 3), (7, 2, 8, 0)])
def test_against_brute_force(spark, k, dim, scale, rounds):
    rnd = random.Random(k)
    # Coarse grids, so that there are ties, equal vectors and equal centroids.
    rows = [(i, [rnd.randrange(-6, 7) / 4 for _ in range(dim)]) for i in range(300)]
    rows += [(1000 + i, list(rows[7][1])) for i in range(150)]  # a hot group of copies
    rows += [(5, [0.5] * dim), (5, [-0.5] * dim), (None, [0.25] * dim)]
    rows += [(2000, None), (2001, []), (2002, [0.1] * (dim + 1)), (2003, [None] * dim), (2004, [math.nan] * dim), (2005, [math.inf] * dim)]
    assert run(spark, rows, k, dim, scale, rounds, extra=True) == brute(rows, k, dim, scale, rounds)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [0.5, 1.0]), (2, [0.5, 1.0]), (3, [-1.0, 0.0])]
    assert run(spark, rows, 16, 2, 64, 3) == brute(rows, 16, 2, 64, 3)
    assert run(spark, [], 16, 2, 64, 3) == []


def test_too_large_a_component_is_an_error(spark):
    with pytest.raises(Exception, match="beyond"):
        run(spark, [(1, [1e12, 0.0])], 2, 2, 64, 1)


def test_search_is_exact_and_saves_distances():
    rnd = np.random.default_rng(2)
    groups = rnd.integers(-300, 300, (40, 8))
    x = (groups[rnd.integers(0, 40, 4000)] + rnd.integers(-20, 20, (4000, 8))).astype(np.int64)
    at, before = x[:40].copy(), None
    near, second = np.zeros(4000, np.int64), np.ones(4000, np.int64)
    upper, lower = np.full(4000, np.inf), np.zeros(4000)
    saved = []
    for _ in range(6):
        near, second, upper, lower, computed = centroids.search(centroids.Centroids(at, before), x, near, second, upper, lower)
        d = ((x[:, None, :] - at[None]) ** 2).sum(2)
        assert (near == d.argmin(1)).all()
        assert (upper >= np.sqrt(d.min(1))).all()
        rest = d.copy()
        rest[np.arange(4000), near] = np.iinfo(np.int64).max
        assert (lower <= np.sqrt(rest.min(1)) + 1e-6).all()
        saved.append(computed)
        before, at = at, np.array([x[near == j].sum(0) // (near == j).sum() if (near == j).any() else at[j] for j in range(40)])
    assert saved[-1] < 4000 * 40 / 10


def test_query_against_brute_force(spark, sf_small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()]
    got = queries.QUERIES["op13_shallot_clusters"](spark, sf_small)
    assert got.columns[0] == "vec_id"
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 16, 64, 64, 3)
