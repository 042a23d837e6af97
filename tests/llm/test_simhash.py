import hashlib
import itertools
import random

from pyspark.sql import functions as F

from docsift.llm import simhash as H


def test_edited_texts_order_and_equality(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(i, " ".join(f"w{rnd.randrange(500)}" for _ in range(rnd.randrange(0, 80)))) for i in rnd.sample(range(1000), 120)]
    rows += [(2000, None), (2001, ""), (2002, "é😀ü"), (2003, rows[0][1]), (2004, "long " * 30_000)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in H.op7_simhash(spark, str(tmp_path)).collect()}
    rows.sort()
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(rows):
        t, nxt, r = t or "", rows[(k + 1) % len(rows)][1] or "", got[i]
        half = len(t) // 2
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256((t[:len(t) - half] + nxt[:half]).encode()).hexdigest()
        f, g = int(r.fingerprint, 16), int(got[rows[(k + 1) % len(rows)][0]].fingerprint, 16)
        assert r.near_next == 1 - bin(f ^ g).count("1") / 64
        assert r.near_edited == 1 - bin(f ^ int(r.edited_fingerprint, 16)).count("1") / 64
    assert got[2003].fingerprint == got[rows[0][0]].fingerprint or rows[0][1] != got[2003].fingerprint
    same = {}
    for i, t in rows:
        assert same.setdefault(t or "", got[i].fingerprint) == got[i].fingerprint


def test_one_row_and_equal_and_null_ids(spark):
    one = H.ordered(spark.createDataFrame([(9, "only")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.text, r.next, r.pos) for r in one] == [(9, "only", "only", 0)]
    rows = [(1, "a"), (1, "a"), (None, "n"), (0, "z"), (1, "b")]
    got = sorted(H.ordered(spark.createDataFrame(rows, "doc_id long, text string")).collect(), key=lambda r: r.pos)
    assert [r.pos for r in got] == list(range(5)) and [r.doc_id for r in got] == [0, 1, 1, 1, None]
    assert [r.next for r in got] == [r.text for r in got[1:]] + [got[0].text]


def test_search_equals_all_distances(spark):
    rnd = random.Random(5)
    base = [rnd.getrandbits(64) for _ in range(40)]
    fps = set(base)
    for b in base:
        for _ in range(8):
            x = b
            for k in rnd.sample(range(64), rnd.randrange(1, 6)):
                x ^= 1 << k
            fps.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps] + [0, 0, -1]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for radius, blocks in ((0, 2), (2, 4), (3, 6)):
        got = {(r["query"], r["fp"]): (r["n"], r["dist"]) for r in H.search(df, df, radius, blocks).collect()}
        want = {}
        for a, b in itertools.product(set(signed), repeat=2):
            d = bin((a ^ b) & (1 << 64) - 1).count("1")
            if d <= radius:
                want[a, b] = (signed.count(b), d)
        assert got == want


def test_plan_is_native(spark):
    o = H.ordered(spark.createDataFrame([(1, "a b c"), (2, "d e")], "doc_id long, text string"))
    f = H.fingerprints(o.select("pos", "text"), {"fp": "text"}, ["pos"]).withColumn("x", F.lit(1))
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert H.op7_simhash(spark, str(tmp_path)).collect() == []
