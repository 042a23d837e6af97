import random

from pyspark.sql import functions as F

import chunk_models
from docsift.operators import chunking as C


def chunks_of(spark, text, size, overlap):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(C.chunk_sentences_col("t", size, overlap).alias("c")).first()["c"]


def ntok(s):
    return len(s.split())


def model(units, size, overlap):
    """Plain-Python statement of the chunk contract on token counts."""
    out, cur, n = [], [], 0
    for t in units:
        if n > 0 and n + t > size:
            out.append(list(cur))
            keep, s = [], 0
            for u in reversed(cur):
                if s + u <= overlap:
                    keep.insert(0, u)
                    s += u
                else:
                    break
            if s + t > size:
                keep, s = [], 0
            cur, n = keep + [t], s + t
        else:
            cur.append(t)
            n += t
    if cur:
        out.append(cur)
    return out


def test_empty_and_single(spark):
    assert chunks_of(spark, "", 10, 2) == []
    assert chunks_of(spark, "   ", 10, 2) == []
    assert chunks_of(spark, "One sentence only.", 10, 2) == ["One sentence only."]


def test_long_sentence_is_cut(spark):
    words = " ".join(f"w{i}" for i in range(25))
    ch = chunks_of(spark, words, 10, 0)
    assert [ntok(c) for c in ch] == [10, 10, 5]
    assert " ".join(ch).split() == words.split()


def test_overlap_and_bounds(spark):
    sents = [" ".join(["x"] * n) + "." for n in (4, 3, 5, 2, 6, 1, 3)]
    text = " ".join(sents)
    ch = chunks_of(spark, text, 8, 3)
    assert all(ntok(c) <= 8 for c in ch)
    counts = [len(s.split()) for s in sents]
    assert [sum(c) for c in model(counts, 8, 3)] == [ntok(c) for c in ch]


def test_overlap_unit_larger_than_overlap(spark):
    text = "a b c d. e f g h. i j."
    ch = chunks_of(spark, text, 5, 2)
    # no suffix of <= 2 tokens exists (each unit has 4), so no overlap
    assert ch == ["a b c d.", " e f g h.", " i j."]


def test_suffix_that_does_not_fit(spark):
    text = "a b. c d e f g."
    # chunk 1 = "a b." (2), unit 2 has 5 tokens; suffix 2 + 5 > 6 -> no suffix
    assert chunks_of(spark, text, 6, 2) == ["a b.", " c d e f g."]


def test_random_against_model(spark):
    rng = random.Random(3)
    rows = []
    for i in range(200):
        counts = [rng.randint(1, 9) for _ in range(rng.randint(0, 30))]
        text = " ".join(" ".join(["w"] * c) + "." for c in counts)
        rows.append((i, text, counts))
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "id int, t string")
    got = dict(df.select("id", C.chunk_sentences_col("t", 12, 4).alias("c")).collect())
    for i, text, counts in rows:
        exp = [sum(c) for c in model(counts, 12, 4)]
        assert [ntok(c) for c in got[i]] == exp, (counts, got[i])


def test_without_overlap_concatenates_back(spark):
    text = "Alpha beta. Gamma delta epsilon! Zeta? Eta theta iota kappa. Lambda"
    ch = chunks_of(spark, text, 4, 0)
    assert "".join(ch) == text


def test_window(spark):
    df = spark.createDataFrame([("a b c d e f g",), ("",), ("x",)], "t string")
    got = [r[0] for r in df.select(C.chunk_window_col("t", 3, 1)).collect()]
    assert got[0] == ["a b c", "c d e", "e f g"]
    assert got[1] == []
    assert got[2] == ["x"]


def test_explode_null_and_empty_give_no_rows(spark):
    df = spark.createDataFrame([(1, None), (2, [])], "id int, a array<string>")
    assert C.explode_chunks(df, F.col("a"), ["id"]).count() == 0


def test_profile(spark):
    df = spark.createDataFrame([("p", "a b c"), ("p", "a"), ("q", "a b c d e f")], "path string, content string")
    rows = {r["path"]: r for r in C.profile_chunks(df, limit=5).collect()}
    assert rows["p"]["n_chunks"] == 2 and rows["p"]["max_tokens"] == 3
    assert rows["q"]["n_over_limit"] == 1


def test_dense_id(spark):
    df = spark.createDataFrame([(i, f"r{i}") for i in range(37, 0, -1)], "k long, v string").repartition(5)
    got = sorted((r["id"], r["k"]) for r in C.dense_id(df, ["k"], "id").collect())
    assert got == [(i, i) for i in range(1, 38)]


def test_injected_tokenizer(spark):
    from docsift.functions.text import token_count_with
    df = spark.createDataFrame([("a b c",), (None,), ("",)], "t string")
    got = [r[0] for r in df.select(token_count_with("t", lambda ts: [len(t) for t in ts])).collect()]
    assert got == [5, None, 0]


def test_sentence_chunks_equal_the_model(spark):
    rng = random.Random(11)
    words = ["a", "bb", "ccc", "dé", "x.y", "end!", "why?", "..."]
    rows = []
    for i in range(150):
        parts = []
        for _ in range(rng.randint(0, 60)):
            parts.append(rng.choice(words) + rng.choice([" ", "  ", "\n", "\t", ". ", "? ", ""]))
        rows.append((i, "".join(parts)))
    rows.append((999, None))
    df = spark.createDataFrame(rows, "id int, t string")
    for size, overlap in [(5, 2), (12, 0), (3, 3)]:
        a = dict(df.select("id", C.chunk_sentences_col("t", size, overlap)).collect())
        assert a == {i: chunk_models.chunks(t, size, overlap) for i, t in rows}, (size, overlap)


def test_semantic_chunks_equal_the_model(spark):
    rng = random.Random(5)
    words = ["spark", "data", "Stream", "été", "x1", "chat", "the", "a"]
    rows = [(i, " ".join(rng.choice(words) + rng.choice(["", ".", "!", "?"]) for _ in range(rng.randint(0, 80))))
            for i in range(80)] + [(99, None)]
    df = spark.createDataFrame(rows, "id int, t string")
    for thr, size in [(0.1, 20), (0.5, 7), (0.0, 500)]:
        a = dict(df.select("id", C.chunk_semantic_col("t", thr, size)).collect())
        assert a == {i: chunk_models.semantic(t, thr, size) for i, t in rows}, (thr, size)


def test_a_document_of_100000_sentences(spark):
    text = " ".join(f"sentence number {i} has words." for i in range(100_000))
    df = spark.createDataFrame([(text,)], "t string")
    plan = C.chunk_sentences(df.withColumn("path", F.lit("p")), "t")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert df.select(C.chunk_sentences_col("t", 500, 50)).first()[0] == chunk_models.chunks(text, 500, 50)
    assert df.select(C.chunk_semantic_col("t", 0.1, 200)).first()[0] == chunk_models.semantic(text, 0.1, 200)
    one = "w " * 200_000                                              # a sentence without a stop, cut into pieces
    assert spark.createDataFrame([(one,)], "t string").select(C.chunk_sentences_col("t", 500, 50)).first()[0] == chunk_models.chunks(one, 500, 50)


def test_topics_of_sentences_without_terms(spark):
    from docsift.operators import chunking as CK
    rows = [(d, i, t) for d in range(6) for i, t in enumerate(["red fox runs.", " !!! ", "red fox sleeps.", "stock market falls.", "..."])]
    rows += [(9, 0, " ? "), (9, 1, "red fox runs."), (10, 0, "--"), (10, 1, "!!")]
    got = CK.chunk_topics(spark.createDataFrame(rows, "doc_id long, sent_no int, sentence string"), k=2, max_iter=5).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.chunk_no)):
        by.setdefault(r.doc_id, []).append(r)
    for d, chunks in by.items():
        assert "".join(c.content for c in chunks) == "".join(t for x, _, t in rows if x == d)
        assert all(a.topic != b.topic for a, b in zip(chunks, chunks[1:]))
    assert len(by[9]) == 1 and len(by[10]) == 1 and by[10][0].topic == 0


def test_top_topics_equal_the_model_transform(spark):
    from pyspark.ml.clustering import LDA
    from pyspark.ml.feature import HashingTF
    from pyspark.ml.functions import vector_to_array
    from docsift.operators import topics as TP
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, [rng.choice(words[(i % 3) * 20:][:30]) for _ in range(rng.choice([0, 1, 2, 5, 9, 40]))]) for i in range(600)]
    rows += [(-1, None), (-2, [])]
    df = HashingTF(numFeatures=256, inputCol="w", outputCol="v").transform(
        spark.createDataFrame(rows, "id long, w array<string>").selectExpr("id", "coalesce(w, array()) AS w"))
    model = LDA(k=5, seed=7, maxIter=3, featuresCol="v", topicDistributionCol="d").fit(df)
    want = {r.id: (max(range(5), key=lambda j: r.d[j]) if r.w else None)
            for r in model.transform(df).select("id", "w", vector_to_array("d").alias("d")).collect()}
    assert {r.id: r.top for r in TP.top_topics(df, "v", model, "top", ["id"]).collect()} == want
    assert len(set(want.values())) > 3


def test_topic_runs_are_linear_in_a_document(spark):
    from docsift.operators import chunking as CK
    rows = [(1, i, "red fox runs. " if i % 3 else "stock market falls. ") for i in range(3000)] + [(2, 0, None), (2, 1, "red fox runs."), (3, 0, "..")]
    got = CK.chunk_topics(spark.createDataFrame(rows, "doc_id long, sent_no int, sentence string"), k=2, max_iter=3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "currentrow$(), unboundedfollowing$()" not in plan      # this frame reads the rest of the document for every row
    assert "aggregate(" not in plan                                # a fold copies the text so far for every sentence
    by = {}
    for r in sorted(got.collect(), key=lambda r: (r.doc_id, r.chunk_no)):
        by.setdefault(r.doc_id, []).append(r)
    assert "".join(r.content for r in by[1]) == "".join(t for d, _, t in rows if d == 1)
    assert [r.chunk_no for r in by[1]] == list(range(len(by[1]))) and all(a.topic != b.topic for a, b in zip(by[1], by[1][1:]))
    assert [r.content for r in by[2]] == [None] and [r.content for r in by[3]] == [".."]
