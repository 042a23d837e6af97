import re
from collections import defaultdict

import pytest

from docsift.llm import mixing


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode("utf-8")) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if w[s] * level > cap * sizes[s]}
        if not over:
            target |= {s: w[s] * level for s in open_}
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, mix_rate string, extra int")


def test_targets_and_sizes(spark):
    rows = []
    for i in range(400):
        src = [None, "b", "a", "é", "😀", "hot", "hot", "hot"][i % 8]
        rows.append((i, " ".join("w" * (1 + k % 3) for k in range(i % 37)) + "\x0b\n x y", src, "z", 1))
    rows += [(None, None, "none", "z", 1), (400, "", "none", "z", 1), (5, rows[5][1], rows[5][2], "z", 1)]
    got = mixing.mix(table(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[2]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    want = plain_targets(dict(sizes))
    for r in got:
        assert r.mix_size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert r.mix_source_size == sizes[r.source]
        assert r.mix_target == pytest.approx(want[r.source])
        rate = want[r.source] / sizes[r.source] if sizes[r.source] else 0
        assert int(rate) <= r.mix_copies <= min(2, int(rate) + 1)
    assert got and sorted(map(str, got)) == sorted(map(str, mixing.mix(table(spark, rows).repartition(5)).collect()))


def test_taken_words_come_near_the_targets(spark):
    rows = [(i, "w " * (20 + i % 30), f"s{i % 5}" if i % 3 else "s0", "z", 1) for i in range(6000)]
    m = mixing.mix(table(spark, rows)).groupBy("source").agg({"mix_target": "max"}).collect()
    out = {r.source: r[1] for r in m}
    taken = {r.source: r.n for r in mixing.mix(table(spark, rows)).selectExpr("source", "mix_size * mix_copies t").groupBy("source").agg({"t": "sum"})
             .withColumnRenamed("sum(t)", "n").collect()}
    for s, t in out.items():
        assert taken[s] == pytest.approx(t, rel=0.08)


def test_emit_repeats_rows_and_keeps_columns(spark):
    rows = [(i, "w " * 10, "a" if i < 90 else "b", "z", i) for i in range(100)]
    m = mixing.mix(table(spark, rows))
    out = mixing.emit(m)
    assert out.columns == ["doc_id", "text", "source", "extra"]
    assert out.count() == m.agg({"mix_copies": "sum"}).first()[0]


def test_empty_table(spark):
    assert mixing.emit(mixing.mix(table(spark, []))).collect() == []


def test_rows_of_one_id_draw_for_themselves(spark):
    rows = [(None, f"w{i % 3} " * 10, "a", "z", 1) for i in range(900)] + [(7, f"x{i} y", "b", "z", 1) for i in range(900)] + [(i, "w " * 9, "c", "z", 1) for i in range(900)]
    m = mixing.mix(table(spark, rows).repartition(4)).selectExpr("source", "mix_target", "mix_copies", "mix_size * mix_copies t").collect()
    for s in "abc":
        mine = [r for r in m if r.source == s]
        assert len(mine) == 900
        assert sum(r.t for r in mine) == pytest.approx(mine[0].mix_target, rel=0.1)
    again = mixing.mix(table(spark, rows).repartition(7)).selectExpr("source", "mix_target", "mix_copies", "mix_size * mix_copies t").collect()
    assert sorted(map(str, m)) == sorted(map(str, again))
