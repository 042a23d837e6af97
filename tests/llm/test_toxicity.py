import zlib

import numpy as np

from docsift.llm import toxicity as X

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_on_labelled_documents(spark):
    got = {r.doc_id: r for r in X.op1_toxicity(spark, SF).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())
    held = [(got[i].predicted, y) for i, y in labels.items() if got[i].held_out]
    assert np.mean([p == y for p, y in held]) > 0.9


def sentences():
    rnd = np.random.default_rng(4)
    plain = ["garden", "river", "window", "teacher", "morning", "silver", "travel", "market", "simple", "winter", "people", "letter", "yellow", "bridge"]
    texts, y = [], []
    for i in range(400):
        w = [plain[k] for k in rnd.integers(0, len(plain), 12)]
        if i % 4 == 0:
            w[int(rnd.integers(0, 12))] = ["idiot", "moron", "loser"][i // 4 % 3]
        texts.append(" ".join(w[:6]) + ". " + " ".join(w[6:]) + ".")
        y.append(i % 4 == 0)
    return texts, np.array(y, float)


def test_gapped_and_inserted_insults_are_found(spark):
    texts, y = sentences()
    m = X.train(texts, y)
    df = spark.createDataFrame([(i, t) for i, t in enumerate([
        "the river is an idiot today.", "window i.d.i.o.t garden.", "what a m-o-r-o-n.", "i d i o t people.", "morning IDIOT market",
        "the river is silver today.", "garden letter bridge window.", "", None])], "doc_id long, text string")
    s = {r.doc_id: r.toxic_score for r in X.score(df, m).collect()}
    assert min(s[i] for i in range(5)) > 0.5 > max(s[i] for i in range(5, 9))
    assert s[7] == s[8]


def test_the_weight_table_is_the_kernel_expansion():
    """part_scores by table equals explicit inner products of feature vectors."""
    rng = np.random.default_rng(1)
    table = rng.normal(size=1 << 15).astype(np.float32)
    words = ["idiot", "ab", "a", "straße", "x" * 90, "i.d.i.o.t", "wörter1"]
    a = X.spread(words, table[:, None])[:, 0]
    b = X.vectors_of(words) @ table
    assert np.allclose(a, b, rtol=1e-3, atol=1e-3)


def test_labels_of_one_class_or_none(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None), (None, "x" * 100_000)], "doc_id long, text string")
    for rows in ([], [(1, 0)], [(1, None), (None, 1)]):
        m = X.fit(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        got = X.score(docs, m).collect()
        assert len(got) == 3 and len({r.toxic_score for r in got}) == 1
    assert X.score(docs.limit(0), m).collect() == []
