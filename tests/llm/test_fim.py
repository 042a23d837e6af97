import hashlib
import re

import pytest
from pyspark.sql import functions as F

from docsift.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = [None, "", " ", " \n\t", "one", "one two  three\n", "  lead and trail  ", "marks <P> stay", "<S", "a<S b>c <M", "dollar $1 \\2 {3}", "日本語 😀😀 smile é",
         "x" * 5000, "no break space", "a\x00b c", "\x0b\x0c v"]


def plain(i, text, seed=42):
    """The rule, step by step."""
    t = text or ""
    units = UNIT.findall(t)
    d = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(d[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", t, None, None
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return n, "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return n, "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def test_against_the_rule(spark):
    rows = [(k, t, "o") for k, t in enumerate(TEXTS * 12)] + [(None, "null id here", "o"), (3, "again and again", "o"), (3, "again and again", "o")]
    df = spark.createDataFrame(rows, "doc_id long, text string, output string")
    got = fim.transform(df).withColumn("back", fim.restore(F.col("output"), F.col("form")))
    assert got.columns == ["doc_id", "text", "output", "n", "form", "prefix_chars", "middle_chars", "back"]
    out = [(r.doc_id, r.text, r.n, r.form, r.output, r.prefix_chars, r.middle_chars, r.back) for r in got.collect()]
    want = [(i, t, *plain(i, t), t or "") for i, t, _ in rows]
    assert sorted(map(str, out)) == sorted(map(str, want))
    assert {r[3] for r in out} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("unit", ["a ", "wörd\n", " ", "😀"])
def test_very_long_texts(spark, unit):
    n = 400_000
    df = spark.range(40).select(F.col("id").alias("doc_id"), F.expr(f"repeat('{unit}', {n})").alias("text"))
    got = fim.transform(df).where("form <> 'plain'").withColumn("back", fim.restore(F.col("output"), F.col("form")))
    rows = got.select("doc_id", "n", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("o"), (F.col("back") == F.col("text")).alias("same")).limit(6).collect()
    assert rows and all(r.same for r in rows)
    for r in rows[:2]:
        w = plain(r.doc_id, unit * n)
        assert (r.n, r.prefix_chars, r.middle_chars, r.o) == (w[0], w[3], w[4], hashlib.sha256(w[2].encode()).hexdigest())


def test_other_settings(spark):
    df = spark.createDataFrame([(k, "one two three four") for k in range(60)], "id long, body string")
    got = fim.transform(df, text="body", doc_id="id", seed=7, fim_percent=100, spm_percent=0)
    assert {r.form for r in got.collect()} == {"psm"}
    assert {r.form for r in fim.transform(df, text="body", doc_id="id", fim_percent=0).collect()} == {"plain"}


def test_query_and_plan(spark):
    from docsift.llm.queries import QUERIES
    q = QUERIES["op11_fill_in_middle"](spark, "/root/testdata/sf0.001")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = {r.doc_id: plain(r.doc_id, r.text) for r in docs}
    for r in q.collect():
        n, form, out, p, m = want[r.doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256) == (n, form, p, m, hashlib.sha256(out.encode()).hexdigest())
    assert q.where("form <> 'plain'").count() > 50


def test_empty_table(spark):
    assert fim.transform(spark.createDataFrame([], "doc_id long, text string")).collect() == []
