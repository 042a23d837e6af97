import numpy as np
import pytest
from pyspark.sql import functions as F

from docsift.operators import search as S
from docsift.operators.embedding import sparse_vector


def brute(q, c, cids, k, metric):
    out = {}
    for qi, qv in enumerate(q):
        if metric == "cosine":
            den = np.linalg.norm(c, axis=1) * np.linalg.norm(qv)
            s = np.where(den > 0, c @ qv / np.where(den > 0, den, 1), 0)
        elif metric == "dot":
            s = c @ qv
        else:
            s = -np.linalg.norm(c - qv, axis=1)
        s = S.round6(s)
        order = sorted(range(len(cids)), key=lambda i: (-s[i], cids[i]))[:k]
        out[qi] = [(int(cids[i]), float(s[i])) for i in order]
    return out


def frames(spark, q, c):
    qdf = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(q)], "query_id long, embedding array<float>")
    cdf = spark.createDataFrame([(int(i), [float(x) for x in v], int(i) % 3) for i, v in enumerate(c)],
                                "chunk_id long, embedding array<float>, label int").repartition(3)
    return qdf, cdf


def as_dict(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["chunk_id"], r["score"]))
    return out


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_knn_matches_brute_force(spark, metric):
    rng = np.random.default_rng(1)
    q = rng.normal(size=(7, 6)).astype(np.float32)
    c = rng.normal(size=(60, 6)).astype(np.float32)
    qdf, cdf = frames(spark, q, c)
    got = as_dict(S.knn(qdf, cdf, k=4, metric=metric))
    exp = brute(q.astype(np.float64), c.astype(np.float64), np.arange(60), 4, metric)
    assert got == exp


def test_k_larger_than_candidates_and_filter(spark):
    rng = np.random.default_rng(2)
    q = rng.normal(size=(3, 4)).astype(np.float32)
    c = rng.normal(size=(9, 4)).astype(np.float32)
    qdf, cdf = frames(spark, q, c)
    got = as_dict(S.knn(qdf, cdf, k=20))
    assert all(len(v) == 9 for v in got.values())
    got = as_dict(S.knn(qdf, cdf, k=5, where="label = 0"))
    assert all(len(v) == 3 and all(cid % 3 == 0 for cid, _ in v) for v in got.values())


def test_ties_lower_id_first(spark):
    qdf = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, embedding array<float>")
    cdf = spark.createDataFrame([(5, [1.0, 0.0]), (2, [2.0, 0.0]), (9, [1.0, 0.0])], "chunk_id long, embedding array<float>")
    got = as_dict(S.knn(qdf, cdf, k=2))
    assert got[0] == [(2, 1.0), (5, 1.0)]


def test_dimension_mismatch_raises(spark):
    qdf = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, embedding array<float>")
    cdf = spark.createDataFrame([(1, [1.0, 0.0, 3.0])], "chunk_id long, embedding array<float>")
    with pytest.raises(Exception):
        S.knn(qdf, cdf, k=1).collect()


def test_blocked_path_equals_broadcast_path(spark):
    rng = np.random.default_rng(3)
    q = rng.normal(size=(20, 5)).astype(np.float32)
    c = rng.normal(size=(40, 5)).astype(np.float32)
    qdf, cdf = frames(spark, q, c)
    a = as_dict(S.knn(qdf, cdf, k=3))
    b = as_dict(S.knn(qdf, cdf, k=3, max_block_bytes=200))   # forces several blocks
    assert a == b


def test_ivf_full_probe_is_exact(spark, scratch_dir):
    rng = np.random.default_rng(4)
    q = rng.normal(size=(5, 8)).astype(np.float32)
    c = rng.normal(size=(200, 8)).astype(np.float32)
    qdf, cdf = frames(spark, q, c)
    cen = S.build_ivf(cdf, scratch_dir + "/ivf", n_lists=4)
    index = spark.read.parquet(scratch_dir + "/ivf")
    exact = S.knn(qdf, cdf, k=4)
    approx = S.knn_ivf(qdf, index, cen, k=4, nprobe=4)
    assert as_dict(exact) == as_dict(approx)
    r = S.recall_at_k(S.knn_ivf(qdf, index, cen, k=4, nprobe=1), exact).first()["recall"]
    assert 0.0 <= r <= 1.0


def test_search_text_and_retrieve(spark):
    chunks = spark.createDataFrame([
        (1, "p1", "the cat sat on the mat"), (2, "p2", "dogs bark loudly"),
        (3, "p1", "a cat and a dog"), (4, "p3", "stock market news")],
        "chunk_id long, path string, content string")
    qs = spark.createDataFrame([(10, "where is the cat"), (11, "market")], "query_id long, question string")
    hits = S.search_text(qs, chunks, k=2, dim=64).orderBy("query_id", "rank").collect()
    assert hits[0]["chunk_id"] == 1 and hits[2]["chunk_id"] == 4
    docs = S.retrieve(qs, chunks, k=2, dim=64).orderBy("query_id").collect()
    assert [d["n_docs"] for d in docs] == [2, 2]
    assert [x["rank"] for x in docs[0]["docs"]] == [1, 2]


def test_sliced_scoring_equals_unsliced(spark, monkeypatch):
    rng = np.random.default_rng(5)
    q = rng.normal(size=(9, 4)).astype(np.float32)
    c = rng.normal(size=(50, 4)).astype(np.float32)
    qdf, cdf = frames(spark, q, c)
    a = as_dict(S.knn(qdf, cdf, k=3))
    monkeypatch.setattr(S, "MAX_SCORES", 7)   # 1-row slices
    b = as_dict(S.knn(qdf, cdf, k=3))
    assert a == b


def test_ivf_exact_mode_equals_exact(spark, scratch_dir):
    rng = np.random.default_rng(6)
    q = rng.normal(size=(12, 8)).astype(np.float32)
    c = np.vstack([rng.normal(size=(150, 8)), np.zeros((2, 8))]).astype(np.float32)
    qdf, cdf = frames(spark, q, c)
    cen = S.build_ivf(cdf, scratch_dir + "/ivf2", n_lists=6)
    index = spark.read.parquet(scratch_dir + "/ivf2")
    exact = as_dict(S.knn(qdf, cdf, k=4))
    got = as_dict(S.knn_ivf(qdf, index, cen, k=4, nprobe=1, exact=True))
    assert got == exact


def test_float32_dots_exact_for_integer_vectors():
    rng = np.random.default_rng(9)
    cm = rng.integers(-20, 20, size=(300, 64)).astype(np.float64)
    qm = rng.integers(-5, 5, size=(7, 64)).astype(np.float64)
    d = S._dots(cm, qm, qm.astype(np.float32), float(np.abs(qm).sum(axis=1).max()))
    assert np.array_equal(d, cm @ qm.T)
    frac = cm + 0.5
    assert np.array_equal(S._dots(frac, qm, qm.astype(np.float32), 1.0), frac @ qm.T)


def test_merge_does_not_depend_on_buckets(spark, monkeypatch):
    rng = np.random.default_rng(12)
    q = rng.normal(size=(3, 4)).astype(np.float32)
    c = rng.normal(size=(120, 4)).astype(np.float32)
    qdf, cdf = frames(spark, q, c)
    a = as_dict(S.knn(qdf, cdf.repartition(12), k=5))
    monkeypatch.setattr(S, "MERGE_BUCKETS", 2)
    b_df = S.knn(qdf, cdf.repartition(12), k=5)
    assert "_b" not in b_df.columns
    assert as_dict(b_df) == a


def test_question_matrix_sparse_dots():
    rng = np.random.default_rng(13)
    dense_q = rng.integers(-3, 4, size=(9, 16)).astype(np.float64)
    dense_q[rng.random(dense_q.shape) < 0.7] = 0
    dense_q[2] = 0  # a question without terms
    dense_q[8] = 0  # ... also the last one
    indptr = np.concatenate([[0], np.cumsum((dense_q != 0).sum(axis=1))])
    rr, cc = np.nonzero(dense_q)
    Q = S.QuestionMatrix(np.arange(9), 16, indptr=indptr, indices=cc, values=dense_q[rr, cc])
    cm = rng.integers(-5, 6, size=(7, 16)).astype(np.float64)
    assert np.array_equal(Q.sparse_dots(cm, 0, 9), cm @ dense_q.T)
    assert np.array_equal(Q.sparse_dots(cm, 2, 5), cm @ dense_q[2:5].T)
    assert np.allclose(Q.norms, np.linalg.norm(dense_q, axis=1))


def test_search_text_sliced_sparse_questions(spark, monkeypatch):
    chunks = spark.createDataFrame([(i, f"p{i % 3}", " ".join(f"w{(i * 7 + j) % 23}" for j in range(12)))
                                    for i in range(40)], "chunk_id long, path string, content string")
    qs = spark.createDataFrame([(i, " ".join(f"w{(i * 5 + j) % 23}" for j in range(4))) for i in range(15)] + [(99, "")],
                               "query_id long, question string")
    a = S.search_text(qs, chunks, k=3, dim=64, carry=("path",)).orderBy("query_id", "rank").collect()
    monkeypatch.setattr(S, "MAX_SCORES", 20)   # forces tiny row and question slices
    b = S.search_text(qs, chunks, k=3, dim=64, carry=("path",)).orderBy("query_id", "rank").collect()
    c = S.search_text(qs, chunks.withColumn("embedding", __import__("docsift.operators.embedding", fromlist=["x"])
                                            .hash_vector(F.col("content"), 64)),
                      k=3, dim=64, carry=("path",), embedded=True).orderBy("query_id", "rank").collect()
    assert a == b == c


def test_sparse_gather_path_equals_dense_path(spark, monkeypatch):
    chunks = spark.createDataFrame([(i, f"p{i % 3}", " ".join(f"w{(i * 3 + j) % 31}" for j in range(10)))
                                    for i in range(30)], "chunk_id long, path string, content string")
    qs = spark.createDataFrame([(i, " ".join(f"w{(i * 7 + j) % 31}" for j in range(5))) for i in range(12)],
                               "query_id long, question string")
    a = S.search_text(qs, chunks, k=3, dim=64, carry=("path",)).orderBy("query_id", "rank").collect()
    monkeypatch.setattr(S, "DENSE_QUESTIONS", 0)    # keep questions sparse inside the task
    b = S.search_text(qs, chunks, k=3, dim=64, carry=("path",)).orderBy("query_id", "rank").collect()
    monkeypatch.setattr(S, "MAX_SCORES", 100)
    c = S.search_text(qs, chunks, k=3, dim=64, carry=("path",)).orderBy("query_id", "rank").collect()
    assert a == b == c


def test_vectors_with_nan_are_never_hits(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, embedding array<float>")
    c = spark.createDataFrame([(1, [1.0, float("nan")]), (2, [1.0, 0.1]), (3, [0.0, 1.0]), (4, [float("inf"), 1.0])],
                              "chunk_id long, embedding array<float>")
    for metric in S.METRICS:
        assert [r.chunk_id for r in S.knn(q, c, k=2, metric=metric).orderBy("rank").collect()] == [2, 3]
    bad = spark.createDataFrame([(1, [float("nan"), 0.0])], "query_id long, embedding array<float>")
    with pytest.raises(ValueError, match="NaN"):
        S.knn(bad, c, k=2)


def test_l2_keeps_small_distances_between_long_vectors(spark):
    base = np.full(64, 462.5)
    near = [base + d * np.eye(64)[0] for d in (0.0003, 0.0001, 0.0002, 5.0)]
    q = spark.createDataFrame([(1, base.tolist())], "query_id long, embedding array<double>")
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(near)], "chunk_id long, embedding array<double>")
    got = [(r.chunk_id, r.score) for r in S.knn(q, c, k=3, metric="l2").orderBy("rank").collect()]
    assert got == [(1, -0.0001), (2, -0.0002), (0, -0.0003)]


def test_no_content_below_the_merge(spark):
    q = spark.createDataFrame([(1, "red fox")], "query_id long, question string")
    c = spark.createDataFrame([(1, "p", "red fox"), (2, "p", "blue")], "chunk_id long, path string, content string")
    hits = S.search_text(q, c, k=1)
    assert [(r.chunk_id, r.content) for r in hits.collect()] == [(1, "red fox")]
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    merge = plan[plan.index("Window"):]
    assert "content#" not in merge[:merge.index("MapInArrow")]


def test_ivf_without_questions(spark):
    c = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "chunk_id long, embedding array<float>")
    cen = np.eye(2)
    q = spark.createDataFrame([], "query_id long, embedding array<float>")
    assert S.knn_ivf(q, S.assign_cells(c, cen), cen, k=1).collect() == []


def test_never_more_than_k_hits_with_repeated_ids(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, embedding array<float>")
    c = spark.createDataFrame([(1, [1.0, 0.0], "a"), (1, [0.9, 0.1], "b"), (2, [0.5, 0.5], "c"), (None, [1.0, 0.01], "d")],
                              "chunk_id long, embedding array<float>, path string")
    got = S.knn(q, c, k=2, carry=("path",)).orderBy("rank").collect()
    assert [(r["rank"], r.chunk_id, r.path) for r in got] == [(1, 1, "a"), (2, None, "d")]
    assert [(r["rank"], r.path) for r in S.knn(q, c, k=9, carry=("path",)).orderBy("rank").collect()] == [(1, "a"), (2, "d"), (3, "b"), (4, "c")]


def test_several_id_columns(spark):
    q = spark.createDataFrame([(1, "red fox")], "query_id long, question string")
    c = spark.createDataFrame([(5, 1, "red fox"), (5, 0, "red fox"), (4, 7, "red fox"), (5, 0, "blue")], "doc_id long, chunk_no int, content string")
    got = S.search_text(q, c, k=3, chunk_id=("doc_id", "chunk_no"), carry=("content",)).orderBy("rank").collect()
    assert [(r.doc_id, r.chunk_no, r.content) for r in got] == [(4, 7, "red fox"), (5, 0, "red fox"), (5, 1, "red fox")]


def test_many_groups_equal_one(spark, monkeypatch):
    rng = np.random.default_rng(21)
    q, c = rng.normal(size=(30, 6)).astype(np.float32), rng.normal(size=(300, 6)).astype(np.float32)
    qdf, cdf = frames(spark, q, c)
    a = {m: as_dict(S.knn(qdf, cdf, k=4, metric=m)) for m in S.METRICS}
    cen = S.sample_centroids(cdf, 7, "chunk_id")
    monkeypatch.setattr(S, "GROUP_ROWS", 16)
    for m in S.METRICS:
        assert as_dict(S.knn(qdf, cdf, k=4, metric=m, max_block_bytes=300)) == a[m]
    assert as_dict(S.knn_ivf(qdf, S.assign_cells(cdf, cen), cen, k=4, nprobe=2, exact=True, max_block_bytes=300)) == a["cosine"]
    monkeypatch.setattr(S, "WINNERS", 0)                                     # the winners join without a broadcast
    late = S.knn(qdf, cdf, k=4, carry=("label",)).collect()
    assert all(r.label == r.chunk_id % 3 for r in late) and len(late) == 120




def test_normalize_sums_the_norm_once_per_vector(spark):
    """The norm is one sum per vector, not one for each component as well."""
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([],), (None,)], "v array<float>").select(S.normalize(F.col("v")).alias("u"))
    assert df._jdf.queryExecution().analyzed().toString().count("aggregate(") == 1
    assert [r.u if r.u is None else [round(x, 6) for x in r.u] for r in df.collect()] == [[0.6, 0.8], [0.0, 0.0], [], None]


def _streamed(q, c, k, metric, exclude_self=False, limits=None):
    import pyarrow as pa
    g = S._Group(S.QuestionMatrix(np.arange(len(q)), q.shape[1], dense=q), k, metric, exclude_self, limits or (S.MAX_SCORES, S.DENSE_QUESTIONS))
    for a in range(0, len(c), 1300):
        ids = np.arange(a, min(len(c), a + 1300))
        vecs = pa.array(list(c[ids]), pa.list_(pa.float64()))
        g.add(pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.zeros(len(ids), np.int64)), vecs], ["_k0", "_row", "_v"]), ["_k0", "_row"])
    got = {}
    for qi, sc, cid, _ in zip(*g.best()):
        got.setdefault(int(qi), []).append((int(cid), float(sc)))
    return got


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_few_pairs_are_scored_in_float64(metric, monkeypatch):
    """Of the pairs that meet, only those near the k best so far are scored in float64."""
    rng = np.random.default_rng(31)
    q, c = rng.normal(size=(40, 12)), rng.normal(size=(4000, 12)) * rng.uniform(0.5, 2, size=(4000, 1))
    scored = []
    exact, whole = S._Group._exact, S._Group._whole
    monkeypatch.setattr(S._Group, "_exact", lambda self, cm, cn, qm, qn, qi, ri: (scored.append(len(qi)), exact(self, cm, cn, qm, qn, qi, ri))[1])
    monkeypatch.setattr(S._Group, "_whole", lambda self, cm, cn, qm, *a: (scored.append(len(cm) * len(qm)), whole(self, cm, cn, qm, *a))[1])
    assert _streamed(q, c, 5, metric) == brute(q, c, np.arange(len(c)), 5, metric)
    assert 0 < sum(scored) < len(q) * len(c) / 20


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_streamed_ties_zeros_and_long_vectors(metric):
    rng = np.random.default_rng(32)
    base = np.vstack([rng.normal(size=(9, 6)), np.zeros((2, 6)), 1e-30 * rng.normal(size=(2, 6))])
    few = base[:11]
    long = few if metric == "dot" else np.vstack([few, 3e4 + rng.normal(size=(5, 6))])      # products of 1e9 have no 6 places
    for v, limits in ((few, None), (few, (50, 0)), (long, None), (base, None)):
        c = v[rng.integers(0, len(v), 2000)]              # about 150 copies of every vector
        with np.errstate(all="ignore"):
            assert _streamed(v, c, 7, metric, limits=limits) == brute(v, c, np.arange(len(c)), 7, metric)
    c = few[rng.integers(0, len(few), 900)]
    c[::7, 2] = np.nan
    got = _streamed(few, c, 3, metric, exclude_self=True)
    assert all(cid % 7 and cid != qi for qi, hits in got.items() for cid, _ in hits) and all(len(h) == 3 for h in got.values())


def _sparse_rows(rows, dim):
    """As an Arrow list of (bucket, weight); the first row is cut off again, so offsets do not begin at 0."""
    import pyarrow as pa
    whole = all(isinstance(w, int) for r in rows for _, w in r)
    kind = pa.list_(pa.struct([("bucket", pa.int32()), ("weight", pa.int32() if whole else pa.float64())]))
    return pa.array([[{"bucket": b, "weight": w} for b, w in r] for r in [[(1, rows[0][0][1])], *rows]], kind).slice(1)


@pytest.mark.parametrize("rows", [
    [[(0, 1), (9, -3)], [], [(3, 127)]],
    [[(0, 1), (9, -3)], [(2, 70_000), (11, -70_000)], []],
    [[(0, 0.1), (9, -3.5)], [], [(3, 1e300)]],
])
@pytest.mark.parametrize("bits", [False, True])
def test_packed_vectors_are_the_same_vectors(rows, bits):
    dim = 12
    whole = isinstance(rows[0][0][1], int)
    want = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        for b, w in r:
            want[i, b] = w
    col = _sparse_rows(rows, dim)
    packed = S.pack(col, dim, bits, whole)
    assert np.array_equal(S._dense(packed, dim, bits, whole), want)
    assert np.array_equal(S._dense(packed.slice(1), dim, bits, whole), want[1:])
    import pyarrow as pa
    mixed = pa.concat_arrays([packed, S.pack(_sparse_rows([[(5, -1 if whole else -1.0)]], dim), dim, bits, whole)])   # batches differ in width
    assert np.array_equal(S._dense(mixed, dim, bits, whole), np.vstack([want, -np.eye(dim)[5]]))
    with pytest.raises(ValueError, match="bucket"):
        S.pack(_sparse_rows([[(dim, 1)]], dim), dim, bits, whole)


def test_search_moves_packed_vectors(spark):
    """What the join shuffles are bytes, a tenth or so of the array of structs."""
    n = 400
    words = [" ".join(f"w{x}" for x in r) for r in np.random.default_rng(41).integers(0, 20_000, size=(n, 150))]
    c = spark.createDataFrame([(i, t) for i, t in enumerate(words)], "_k0 long, content string") \
        .select("_k0", F.lit(0).cast("long").alias("_row"), F.lit(0).alias("_cell"), sparse_vector(F.col("content"), 1024).alias("_v"))
    q = spark.createDataFrame([(i, " ".join(t.split()[:20])) for i, t in enumerate(words[:50])], "query_id long, t string") \
        .select("query_id", F.lit(0).alias("_cell"), sparse_vector(F.col("t"), 1024).alias("_v"))
    found, _ = S._groups(q, c, ["_k0", "_row"], 3, "cosine", False, 1024, {0: n}, S.MAX_BLOCK_BYTES, 140)
    plan = found._jdf.queryExecution().optimizedPlan()
    joined = next(x for x in iter_plan(plan) if x.nodeName() == "RepartitionByExpression")
    kinds = {f.name(): f.dataType().simpleString() for f in seq(joined.schema())}
    assert kinds["_v"] == "struct<at:binary,weight:binary>"
    best = {(r.query_id, r["_k0"]) for r in found.collect()}
    assert all((i, i) in best for i in range(50))


def seq(schema):
    return [schema.apply(i) for i in range(schema.size())]


def iter_plan(node):
    yield node
    for i in range(node.children().size()):
        yield from iter_plan(node.children().apply(i))


def test_groups_move_few_bytes():
    """300,000 questions of 60 numbers and 5 million candidates of 180, 200 tasks, 8 cores: before, 9 copies of the candidates."""
    block = lambda n, t: -(-(3 * t + 16 * n) // S.MAX_BLOCK_BYTES)
    (cell, salts, blocks), = S._deal({0: (300_000, 18_000_000)}, {0: 5_000_000}, block, 380, 350, 200, 8)
    assert cell == 0 and blocks == block(300_000, 18_000_000) == 2 and salts * blocks >= 32
    assert 5_000_000 * 350 / salts <= S.GROUP_BYTES
    assert salts * 300_000 * 380 + blocks * 5_000_000 * 350 < 7e9
    # few candidates and many questions: blocks of questions, not a copy of them for every task
    (_, salts, blocks), = S._deal({0: (2_000_000, 8_000_000)}, {0: 20_000}, lambda n, t: 1, 380, 350, 200, 8)
    assert salts * 2_000_000 < 2_000_000 * 10 and salts * blocks >= 32
    assert S._deal({0: (5, 50), 1: (4, 40)}, {1: 3, 2: 9}, lambda n, t: 1, 380, 350, 200, 8) == [(1, 1, 1)]


def test_only_rows_that_won_are_joined(spark, monkeypatch):
    """Rows are found by a bit each, across several bitmaps; all of them come where the bits are too many."""
    ids = [0, 1, 7, 8, 32_767, 32_768, 32_769, 70_000, (3 << 33) + 5]
    late = spark.createDataFrame([(i, f"t{i}") for i in [*ids, 2, 9, 32_770, (3 << 33) + 6, 3 << 33]], "_row long, content string")
    won = spark.createDataFrame([(1, i) for i in ids] + [(2, 7)], "query_id long, _row long")
    assert sorted((r["_row"], r.content) for r in S._only(late, won).collect()) == [(i, f"t{i}") for i in ids]
    monkeypatch.setattr(S, "BITMAPS", 1)
    assert S._only(late, won).count() == 14
