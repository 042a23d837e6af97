import zlib

import numpy as np
import pyarrow as pa
import pytest

from docsift.llm import quality_model as Q

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in Q.op9_quality_model(spark, SF).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())
    held = [(got[i].predicted, y) for i, y in labels.items() if got[i].held_out]
    assert np.mean([p == y for p, y in held]) > 0.95


def test_vectorised_walk_equals_a_plain_one():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, len(Q.NAMES)))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    m = Q.train(x, y, trees=20)
    for i in range(0, 500, 25):
        total = m.bias
        for t in range(len(m.feature)):
            k = 0
            while k < m.feature.shape[1]:
                k = 2 * k + 1 + int(x[i, m.feature[t, k]] > m.cut[t, k])
            total += m.leaf[t, k - m.feature.shape[1]]
        assert m.raw(x[i:i + 1])[0] == pytest.approx(total)
    assert ((m.score(x) > 0.5) == y).mean() > 0.9


def test_edge_texts_and_labels(spark):
    docs = spark.createDataFrame([(1, None, "z"), (2, "", "z"), (None, "\n \t", "z"), (3, "x" * 300_000, "z"), (3, "word " * 100, "z"), (3, "word " * 100, "z")],
                                 "doc_id long, text string, quality_score string")
    for rows in ([], [(3, 1)], [(3, 1), (3, 0), (1, 0), (None, 1), (2, None)]):
        model = Q.fit(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
        got = Q.score(docs, model).collect()
        assert len(got) == 6 and all(0 <= r.quality_score <= 1 for r in got)
        assert len({r.quality_score for r in got if r.text is None or not r.text.strip() and not r.text}) == 1
    assert Q.score(docs.limit(0), model).collect() == []


def test_statistics_of_a_chunk_stay_small():
    import tracemalloc

    from docsift.llm.common import CHUNK_BYTES, chunks
    texts = ["Some words, and a line.\nanother line 12 | 3\n" * 40] * (CHUNK_BYTES // 1600)
    (_, t), *_ = chunks(pa.array(texts))
    tracemalloc.start()
    Q.statistics(t)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 * len(t.buf)      # bytes of numpy arrays for each byte of text
