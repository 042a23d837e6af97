import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsift.llm import centroids as C


def plain(rows, k=40, rounds=5, scale=256, dims=64, seed=2):
    """The definition, one vector at a time in Python integers."""
    import math
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(x) < C.LARGEST / scale for x in v)]
    start = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    cents = [v for _, v in start[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for j, g in groups.items():
            cents[j] = [sum(col) // len(g) for col in zip(*g)]
    return [(i, near(v)[1], near(v)[0]) for i, v in kept], cents


def vectors(n, dims, seed=1, spread=0.3):
    rnd = random.Random(seed)
    middles = [[rnd.uniform(-1, 1) for _ in range(dims)] for _ in range(5)]
    return [(i, [m + rnd.gauss(0, spread) for m in middles[i % 5]]) for i in range(n)]


@pytest.mark.parametrize("spread,pivots", [(0.05, 4), (0.5, 12), (0.5, 1), (0.0, 3)])
def test_against_the_definition(spark, spread, pivots):
    rows = vectors(150, 6, spread=spread)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = C.cluster(df, dims=6, k=9, n_pivots=pivots)
    want, cents = plain(rows, k=9, dims=6)
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got.assigned.collect()) == sorted(want)
    assert got.centroids.tolist() == cents


def test_ties_repeats_nulls_and_clashing_names(spark):
    one = [0.5, -0.25, 0.1]
    bad = [(20, None), (21, []), (22, [0.1, 0.2]), (23, [0.1, None, 0.2]), (24, [float("nan"), 0.0, 0.0]), (25, [0.0, float("inf"), 0.0]), (26, [1e300, 0.0, 0.0])]
    rows = [(1, one), (1, one), (1, [0.0, 0.0, 0.0]), (2, one), (None, [1.0, 1.0, 1.0]), (None, one), (3, [-1.0, 0.0, 0.0]), (4, [1.0, 0.0, 0.0]), (5, [5000.0, -5000.0, 3.0])] + bad
    df = spark.createDataFrame([(i, v, "x", "y", 1) for i, v in rows], "vec_id long, embedding array<double>, cluster string, _v string, distance int")
    got = C.cluster(df, dims=3, k=4, keep=("vec_id", "cluster", "distance", "_v"))
    assert got.assigned.columns == ["vec_id", "cluster", "distance", "n_exact"]
    want, cents = plain(rows, k=4, dims=3)
    assert sorted(map(str, ((r.vec_id, r.cluster, r.distance) for r in got.assigned.collect()))) == sorted(map(str, want))
    assert got.centroids.tolist() == cents


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = vectors(3, 4)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted((r.cluster, r.distance) for r in C.cluster(df, dims=4, k=10).assigned.collect()) == [(0, 0), (1, 0), (2, 0)]
    none = C.cluster(df.limit(0), dims=4, k=10)
    assert none.assigned.collect() == [] and none.assigned.columns == ["vec_id", "cluster", "distance", "n_exact"]


def test_bounds_prune_and_lose_nothing():
    rnd = np.random.default_rng(5)
    middles = rnd.integers(-3000, 3000, (20, 16))
    v = (middles[rnd.integers(0, 20, 4000)] + rnd.integers(-40, 40, (4000, 16))).astype(np.int64)
    cents = np.concatenate([middles, middles[:3]]).astype(np.int64)             # equal centroids: the smaller number
    piv = C.far_apart(cents, 8)
    best, square, count = C.nearest(v, C.distances(v, piv), cents, C.distances(cents, piv))
    every = ((v[:, None, :] - cents[None]) ** 2).sum(2)
    assert (best == every.argmin(1)).all() and (square == every.min(1)).all()
    assert count.mean() < 6                                                     # of 23
    big = np.array([[C.LARGEST - 1] * 64, [-C.LARGEST] * 64], np.int64)
    best, square, _ = C.nearest(big, C.distances(big, big), big[::-1], C.distances(big[::-1], big))
    assert best.tolist() == [1, 0] and square.tolist() == [0, 0]


def test_query(spark):
    from docsift.llm.queries import QUERIES
    got = QUERIES["op12_centroids"](spark, "/root/testdata/sf0.001").collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    want, cents = plain(rows)
    inertia = {}
    for _, c, d in want:
        inertia[c] = inertia.get(c, 0) + d
    out = {(r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got}
    assert out == {(i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()) for i, c, d in want}


def test_query_on_an_empty_table(spark, scratch_dir):
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{scratch_dir}/embeddings.parquet")
    assert C.op12_centroids(spark, scratch_dir).collect() == []
    spark.createDataFrame([(1, [0.5] * 64)], "vec_id long, embedding array<float>").select("*", F.lit("a").alias("cluster")).write.parquet(f"{scratch_dir}/two/embeddings.parquet")
    assert C.op12_centroids(spark, f"{scratch_dir}/two").first().distance == 0
