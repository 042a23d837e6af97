import numpy as np
import pytest
from pyspark.sql import functions as F

from docsift.operators import search as S
from docsift.operators import versions as VS
from docsift.plans import ingest


def source(spark, texts):
    return spark.createDataFrame([(i, "p", 0, t) for i, t in texts.items()], "chunk_id long, path string, chunk_no int, content string")


def contents(spark, root, version=None):
    return {r.chunk_id: (r.content, r.embedding) for r in VS.read_version(spark, root, version).collect()}


def anew(spark, texts, dim=16):
    return {r.chunk_id: (r.content, r.embedding) for r in ingest.embed_chunks(source(spark, texts), dim).collect()}


def test_a_sync_writes_touched_cells_only(spark, scratch_dir):
    root = f"{scratch_dir}/idx"
    texts = {i: f"word{i} and w{i % 7}" for i in range(300)}
    seen = []

    def make(rows):
        seen.append(rows.count())
        return ingest.index_rows(None, 16)(rows)
    assert VS.sync(spark, root, source(spark, texts), "chunk_id", make) == 0
    first = VS.manifest(spark, root)
    new = dict(texts) | {5: "other words", 300: "one more"}          # an update, an insert and a delete
    del new[17]
    assert VS.sync(spark, root, source(spark, new), "chunk_id", make) == 1
    assert seen == [300, 2]
    second = VS.manifest(spark, root)
    moved = {c for c, v in second["cells"].items() if v == 1} | (first["cells"].keys() - second["cells"].keys())
    cell = lambda k: str(spark.range(1).select(F.pmod(F.xxhash64(F.lit(k).cast("long")), F.lit(ingest.HASH_CELLS))).first()[0])
    assert moved == {cell(5), cell(300), cell(17)}
    assert contents(spark, root) == anew(spark, new)
    assert contents(spark, root, 0) == anew(spark, texts)             # the old version is as it was
    assert VS.sync(spark, root, source(spark, new), "chunk_id", make) == 1 and seen == [300, 2, 0]
    gone = VS.drop_versions(spark, root)
    assert VS.versions(spark, root) == [1] and len(gone) == len(moved & first["cells"].keys())
    assert contents(spark, root) == anew(spark, new)


def test_nulls_and_values_that_move_are_changes(spark, scratch_dir):
    root = f"{scratch_dir}/idx"
    make = lambda rows: rows.withColumn("centroid", F.lit(0))
    a = spark.createDataFrame([(1, "x", None), (2, None, None), (3, None, "")], "k long, a string, b string")
    b = spark.createDataFrame([(1, None, "x"), (2, None, None), (3, None, None)], "k long, a string, b string")
    VS.sync(spark, root, a, "k", make)
    assert VS.sync(spark, root, b, "k", make) == 1
    assert sorted(map(tuple, VS.read_version(spark, root).select("k", "a", "b").collect())) == [(1, None, "x"), (2, None, None), (3, None, None)]
    assert VS.sync(spark, root, b.limit(0), "k", make) == 2 and VS.read_version(spark, root).count() == 0
    assert VS.sync(spark, root, a, "k", make) == 3 and VS.read_version(spark, root).count() == 3


def test_files_without_a_manifest_are_not_seen(spark, scratch_dir):
    root = f"{scratch_dir}/idx"
    make = ingest.index_rows(None, 16)
    VS.sync(spark, root, source(spark, {1: "a"}), "chunk_id", make)
    spark.range(3).withColumn("centroid", F.lit(0)).write.partitionBy("centroid").parquet(f"{root}/data/v=1")      # cut off
    assert contents(spark, root) == anew(spark, {1: "a"})
    assert VS.sync(spark, root, source(spark, {1: "b"}), "chunk_id", make) == 2
    with pytest.raises(Exception):
        VS._commit(spark, root, VS.manifest(spark, root))             # a version is written once


def test_wrong_vectors_fail_the_sync(spark, scratch_dir):
    root = f"{scratch_dir}/idx"
    bad = lambda texts: [[1.0] * (3 if "bad" in t else 4) for t in texts]
    nan = lambda texts: [[float("nan") if "bad" in t else 1.0] * 4 for t in texts]
    VS.sync(spark, root, source(spark, {1: "a"}), "chunk_id", ingest.index_rows(None, 4, bad))
    for model in (bad, nan):
        with pytest.raises(Exception, match="finite numbers"):
            VS.sync(spark, root, source(spark, {1: "a", 2: "bad"}), "chunk_id", ingest.index_rows(None, 4, model))
    assert set(contents(spark, root)) == {1}


def test_changes_in_order(spark, scratch_dir):
    root = f"{scratch_dir}/idx"
    make = ingest.index_rows(None, 16)
    ch = spark.createDataFrame([(1, "upsert", 1, "a"), (2, "upsert", 1, "b"), (2, "delete", 2, None), (3, "upsert", 1, "c"), (3, "upsert", 3, "cc"), (3, "delete", 2, None)],
                               "chunk_id long, op string, version int, content string")
    VS.apply_changes(spark, root, ch, "chunk_id", make, ["version"])
    assert {k: v[0] for k, v in contents(spark, root).items()} == {1: "a", 3: "cc"}
    VS.apply_changes(spark, root, spark.createDataFrame([(1, "delete", 1, None), (9, "delete", 1, None), (4, "upsert", 1, "d")], ch.schema), "chunk_id", make, ["version"])
    assert {k: v[0] for k, v in contents(spark, root).items()} == {3: "cc", 4: "d"}


def test_search_over_a_stored_version(spark, scratch_dir):
    root = f"{scratch_dir}/idx"
    texts = {i: " ".join(f"w{(i * 7 + j) % 29}" for j in range(6)) for i in range(80)}
    chunks = source(spark, texts)
    cen = S.sample_centroids(ingest.embed_chunks(chunks, 32), 5, "chunk_id")
    make = ingest.index_rows(cen, 32)
    VS.sync(spark, root, chunks, "chunk_id", make)
    index = S.number_rows(VS.read_version(spark, root), ["centroid"])
    qs = spark.createDataFrame([(1, "w3 w4 w5"), (2, "w20 w1")], "query_id long, question string")
    a = S.search_text(qs, chunks, k=3, dim=32).orderBy("query_id", "rank").collect()
    b = S.search_text(qs, index, k=3, dim=32, embedded=True, centroids=cen, nprobe=1, exact=True).orderBy("query_id", "rank").collect()
    assert a == b
    assert np.isclose(np.linalg.norm(cen, axis=1), 1).all()
