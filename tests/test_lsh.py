import numpy as np
from pyspark.sql import functions as F

from docsift.operators import lsh as L
from docsift.operators import search as S


def clustered(spark, n=600, dim=16, groups=60, spread=0.08, seed=3):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(groups, dim))
    v = middles[np.arange(n) % groups] + spread * rng.normal(size=(n, dim))
    return spark.createDataFrame([(i, [float(x) for x in r], f"p{i}") for i, r in enumerate(v)], "chunk_id long, embedding array<float>, path string").repartition(3)


def hits(df):
    return {(r.query_id, r["rank"]): (r.chunk_id, r.score) for r in df.collect()}


def test_near_neighbours_are_found_with_a_small_share_of_pairs(spark):
    c = clustered(spark)
    q = c.where("chunk_id % 3 = 0").select(F.col("chunk_id").alias("query_id"), "embedding")
    planes = L.Planes(16, tables=6, bits=8)
    got = L.knn_lsh(q, c, planes, k=5, probes=6, carry=("path",), exclude_self=True)
    exact = S.knn(q, c, k=5, exclude_self=True)
    assert S.recall_at_k(got, exact).first().recall >= 0.95
    assert L.scored_share(q, c, planes, probes=6) < 0.4
    rows = got.collect()
    assert all(r.path == f"p{r.chunk_id}" for r in rows)
    per = {}
    for r in rows:
        per.setdefault(r.query_id, []).append((r["rank"], r.chunk_id))
    assert all(sorted(r for r, _ in x) == list(range(1, len(x) + 1)) and len({i for _, i in x}) == len(x) <= 5 for x in per.values())


def test_all_buckets_give_the_exact_answer(spark):
    c = clustered(spark, n=90)
    q = c.limit(20).select(F.col("chunk_id").alias("query_id"), "embedding")
    got = L.knn_lsh(q, c, L.Planes(16, tables=2, bits=3), k=4, probes=8, flips=3)
    assert hits(got) == hits(S.knn(q, c, k=4))


def test_probes_are_the_cheapest_flips():
    p = L.Planes(5, tables=2, bits=4, seed=2)
    m = np.random.default_rng(1).normal(size=(7, 5))
    sides = p.sides(m)
    found = p.probes(sides, 16, 4)
    assert (found[:, :, 0] == p.buckets(sides)).all()
    assert all(len(set(found[i, t])) == 16 and {x >> 4 for x in found[i, t]} == {t} for i in range(7) for t in range(2))
    cost = [[sum(sides[i, t, b] ** 2 for b in range(4) if (int(found[i, t, j]) ^ int(found[i, t, 0])) >> b & 1) for j in range(16)] for i in range(7) for t in range(2)]
    assert all((np.diff(x) >= -1e-12).all() for x in cost)


def test_a_hot_bucket_nulls_repeated_ids_and_empty_sides(spark, monkeypatch):
    monkeypatch.setattr(S, "GROUP_ROWS", 8)                                  # the hot bucket is split
    same = [(i % 5, [1.0, 0.0, 0.0]) for i in range(100)] + [(None, [0.9, 0.1, 0.0]), (7, None), (8, [float("nan"), 0.0, 0.0])]
    c = spark.createDataFrame(same, "chunk_id long, embedding array<float>")
    q = spark.createDataFrame([(1, [1.0, 0.0, 0.0]), (2, None)], "query_id long, embedding array<float>")
    planes = L.Planes(3, tables=3, bits=3)
    got = L.knn_lsh(q, c, planes, k=6, probes=2).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.chunk_id) for r in got] == [(1, i + 1, 0) for i in range(6)]     # rows of one id are candidates of their own
    assert L.knn_lsh(q.limit(0), c, planes).collect() == [] and L.knn_lsh(q, c.limit(0), planes).collect() == []
