import os

import pytest
from pyspark.sql import functions as F

from docsift.operators import joins as J
from docsift.streaming import publish as P


def test_dense_ids_over_batches_and_replays(spark, scratch_dir):
    src, out, ck = (os.path.join(scratch_dir, x) for x in ("src", "out", "ck"))
    stream = lambda: spark.readStream.schema("k long, t string").parquet(src)
    spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k long, t string").write.parquet(src)
    P.publish_dense_ids(stream(), out, ["k"], checkpoint=ck)
    spark.createDataFrame([(9, "i"), (8, "h")], "k long, t string").write.mode("append").parquet(src)
    P.publish_dense_ids(stream(), out, ["k"], checkpoint=ck)
    got = lambda: sorted((r.id, r.k) for r in spark.read.parquet(out).collect())
    assert got() == [(1, 1), (2, 2), (3, 3), (4, 8), (5, 9)]
    os.unlink(f"{ck}/commits/1")                                       # the last micro-batch counts as cut off
    for f in os.listdir(f"{ck}/commits"):
        if f.startswith(".1"):
            os.unlink(f"{ck}/commits/{f}")
    P.publish_dense_ids(stream(), out, ["k"], checkpoint=ck)
    assert got() == [(1, 1), (2, 2), (3, 3), (4, 8), (5, 9)]
    with pytest.raises(ValueError, match="new"):
        P.publish_dense_ids(stream(), out, ["k"], checkpoint=f"{ck}2")


def test_a_small_side_is_broadcast_by_counted_bytes(spark):
    big = spark.createDataFrame([(i % 3, i) for i in range(30)], "k int, v int")
    small = spark.createDataFrame([(0, "x" * 1000), (1, None), (7, "z")], "k int, w string")
    n, size = J.counted_size(small)
    assert n == 3 and 1000 < size < 1200
    want = sorted(map(str, big.join(small, "k", "left").collect()))
    for kw, broadcast in (({}, True), ({"max_bytes": 500}, False), ({"max_rows": 2}, False)):
        got = J.join_small(big, small, ["k"], "left", **kw)
        assert sorted(map(str, got.collect())) == want
        assert ("_salt" not in got._jdf.queryExecution().analyzed().toString()) == broadcast
    hot = spark.range(2000).select(F.lit(1).alias("k"), F.col("id").alias("v"))             # one key has all rows of the big side
    assert J.join_small(hot, small, ["k"], max_bytes=0).count() == 2000
