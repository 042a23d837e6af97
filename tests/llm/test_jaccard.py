import random
import re

import numpy as np
import pytest

from docsift.llm import jaccard_join as J


def plain(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if k and 100 * k >= 75 * (len(sets[i]) + len(sets[j]) - k):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(s), least.get(find(i), d)) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))], len({find(i) for i in range(len(rows))})


def corpus(seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(2000)]
    some = lambda n: [rnd.choice(vocab) for _ in range(n)]

    def edit(w, k):
        w = list(w)
        for _ in range(k):
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
        return w
    passage, big = some(60), some(220)
    out = []
    for _ in range(30):
        base = some(rnd.randint(1, 200))
        out += [edit(base, rnd.randint(0, max(1, len(base) // 40))) for _ in range(rnd.choice([1, 1, 2, 3, 8]))]
    out += [edit(big, rnd.randint(0, 5)) for _ in range(90)]                     # one large group around the threshold
    out += [some(rnd.randint(0, 40)) + passage + some(rnd.randint(0, 14)) for _ in range(90)]   # a passage in unlike documents
    out += [passage + ["x"] * rnd.randint(0, 3) for _ in range(40)]              # exact copies
    texts = [" ".join(w) for w in out] + ["", None, "  ", "one", "ONE", "one two", "a b c d e", " A b\tc d  E", "one two"]
    ids = rnd.sample(range(5000), len(texts))
    rows = list(zip(ids, texts, strict=True))
    return rows + [(None, texts[3]), (None, "nowhere else seen"), (ids[5], "same id, another text"), rows[0]]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_all_pairs(spark, seed, monkeypatch):
    if seed == 2:                      # several rounds of pivots, and no order by frequency
        monkeypatch.setattr(J, "PIVOTS", (2, 3))
        monkeypatch.setattr(J, "SMALL", 2)
        monkeypatch.setattr(J, "SKETCH_BITS", 64)
        monkeypatch.setattr(J, "LATE", 0)
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], "doc_id long, text string, n int, point string").repartition(5)
    got = J.components(df).select("doc_id", "n_shingles", "component_id").collect()
    want, n = plain(rows)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    if seed == 1:
        kept = J.keep_one(df)
        assert kept.columns == df.columns
        assert kept.count() == n


def test_long_texts(spark):
    long = [f"w{i}" for i in range(40_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:35_000])), (3, " ".join(long[:29_000])), (4, "x" * 200_000), (5, "x" * 200_000 + " y")]
    got = {r.doc_id: r.component_id for r in J.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert J.components(df).collect() == [] and J.keep_one(df).collect() == []


@pytest.mark.parametrize("block", [256, 7])
def test_links_equal_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "COLUMNS", 64 if block == 7 else 4096)
    rows = [(k, t) for k, (_, t) in enumerate(corpus(3))]
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    close = lambda x, y: bool(x & y) and 100 * len(x & y) >= 75 * len(x | y)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.n_links for r in J.joined(df).collect()}
    assert got == {i: sum(close(sets[i], sets[j]) for j in range(len(rows)) if j != i) for i in range(len(rows))}
    if block == 7:
        pairs, members = J.link_pairs(df)
        classes = {r.point: r.doc_id for r in members.collect()}
        distinct = list(set(sets))
        found = [(frozenset([sets[classes[r.a]], sets[classes[r.b]]]), round(r.similarity, 9)) for r in pairs.collect()]
        want = {frozenset([x, y]): round(len(x & y) / len(x | y), 9) for i, x in enumerate(distinct) for y in distinct[:i] if close(x, y)}
        assert len(found) == len(want) and dict(found) == want
    assert J.joined(df.limit(0)).collect() == []


def test_rows_without_words_all_stay(spark):
    rows = [(None, None), (None, ""), (None, ""), (3, None), (3, ""), (3, " \t\x0b"), (3, " \t\x0b"), (4, "one two"), (4, "one two"), (None, "one two"), (5, "\u00a0")]
    kept = J.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [*rows[:7], (4, "one two"), (5, "\u00a0")]))


def test_a_set_moves_once_for_a_slot(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 20)
    rnd = random.Random(5)
    sets = {p: set(rnd.sample(range(2000), rnd.randint(1, 60))) for p in range(90)}
    packed = [(p, b"".join(x.to_bytes(6, "little") for x in sorted(s))) for p, s in sets.items()]
    lists = [(p, len(sets[p]), list(range(30))) for p in range(30, 90)]             # 1,800 pairs
    df = spark.createDataFrame(lists, "point long, n int, others array<long>").repartition(4)
    values = spark.createDataFrame(packed, "point long, s binary").repartition(3)
    moved = J.side_by_side(df, values.withColumnRenamed("s", "v"), "t")
    assert moved.where("others is not null").count() == 60 and moved.count() <= 60 + 3 * 30
    got = {(r.a, r.b): (round(r.dist, 9), r.linked) for r in J.distances(df, values, "t").collect()}
    assert got == {(a, b): (round(1 - len(sets[a] & sets[b]) / len(sets[a] | sets[b]), 9), 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]))
                   for a in range(30) for b in range(30, 90)}


def test_joins_of_a_large_group_have_no_row_per_pair(spark, monkeypatch):
    """Every join on the way has rows by point: none has the two ends of a pair."""
    plans = []
    real = J.stage
    monkeypatch.setattr(J, "stage", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df, name))
    J.components(spark.createDataFrame([(k, t) for k, (_, t) in enumerate(corpus(4))], "doc_id long, text string")).count()
    joins = [line for p in plans for line in p.splitlines() if "Join " in line]
    assert joins and not [line for line in joins if re.search(r"\ba#\d+L? = a#", line)]


def test_a_point_of_a_slot_is_one_row_and_no_row_is_a_pair(spark, monkeypatch):
    plans = []
    real = J.stage
    monkeypatch.setattr(J, "stage", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df, name))
    lists = spark.createDataFrame([(p, 9, list(range(p))) for p in range(1, 60)], "point long, n int, others array<long>")     # 1,770 pairs
    values = spark.createDataFrame([(p, bytes([p])) for p in range(60)], "point long, v binary")
    rows = J.side_by_side(lists, values, "t").collect()
    assert len(rows) == 60 and sum(r.others is not None for r in rows) == 59
    assert not [p for p in plans if "explode(others" in p]
    monkeypatch.setattr(J, "BLOCK_LISTED", 16)         # a slot that lists too many falls into parts
    rows = J.side_by_side(lists, values, "t").collect()
    parts = {}
    for r in rows:
        parts.setdefault(r.slot, []).append(r)
    assert len(parts) == 4 and all(sum(r.listed for r in p) <= 16 for p in parts.values())
    assert sorted((o, r.point) for r in rows for o in r.others or []) == sorted((o, p) for p in range(60) for o in range(p))
    assert all({o for r in p for o in r.others or []} <= {r.point for r in p if r.listed} for p in parts.values())


def test_bits_of_long_texts_tell_them_apart(spark):
    """Long texts with less than half of their shingles in common are not compared set by set."""
    words = [f"w{i}" for i in range(5000)]
    df = spark.createDataFrame([(1, " ".join(words[:2000])), (2, " ".join(words[1200:3200])), (3, " ".join(words[50:2050]))], "doc_id long, text string")
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    pts = {r.doc_id: r for r in J.points(df, none, 5).collect()}
    sketches = spark.createDataFrame([(r.point, r.sketch) for r in pts.values()], "point long, v binary")
    lists = spark.createDataFrame([(pts[1].point, 1996, [pts[2].point, pts[3].point])], "point long, n int, others array<long>")
    assert [(r.point, r.n, r.others) for r in J.plausible(lists, sketches, "t").collect()] == [(pts[1].point, 1996, [pts[3].point])]
    assert J.SKETCH_BITS < len(pts[1].sketch) * 8 < 8 * J.SHINGLE_BITS * 2000


def test_sets_stored_by_point_do_not_move_again(spark):
    real = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sets = J.by_point(spark.createDataFrame([(p, bytes([p])) for p in range(50)], "point long, s binary"), "t")
        out = sets.join(spark.createDataFrame([(p, 1) for p in range(0, 90, 3)], "point long, x int"), "point")
        assert out.count() == 17 and str(out._jdf.queryExecution().executedPlan()).count("Exchange") == 1
        assert sorted(r.s[0] for r in J.with_values(out.select("point"), [sets.where("point < 20"), sets.where("point >= 20")]).collect()) == list(range(0, 50, 3))
        assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("by_point")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", real)


def test_sets_are_made_by_point(spark):
    """The sets are not shuffled by the key of their row first."""
    df = spark.createDataFrame([(k, f"a b c d e {k % 7}") for k in range(20)], "doc_id long, text string")
    pts = J.points(df, (np.zeros(0, np.uint64), np.zeros(0, np.int64)), 5)
    wanted = pts.groupBy("point").agg({"key": "min"}).withColumnRenamed("min(key)", "key")
    sets = J.sets_of(df, wanted, 5)
    moved = re.findall(r"Exchange hashpartitioning\((\w+)#", sets._jdf.queryExecution().executedPlan().toString())
    assert sets.count() == 7 and moved and not [k for k in moved if k == "key"]
