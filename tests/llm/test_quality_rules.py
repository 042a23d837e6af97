import re

from docsift.llm import quality_rules as R

WORD = r"[^\x20\x09-\x0D]+"
EIGHT = "one two three four five six seven eight"
TEXTS = [None, "", " \t\n\x0b", "x", "a b c d e f g", EIGHT, EIGHT + " " + EIGHT, EIGHT + " nine " + EIGHT + " ten", "same " * 9, "same " * 50,
         "l1 x\nl1 x\n\n \nl2\nl1 x\r\nl1 x", "a# b* $c %& | <> d", "SHOUT LOUD!! " * 30, "clean words in a plain sentence follow here. " * 3 + "z",
         " ".join(f"w{i % 60}" for i in range(5000)), " ".join(f"w{i}" for i in range(30_000)), "é ü ñ 😀 " * 8, "nbsp joined words"]


def plain(text):
    t = text or ""
    ws = re.findall(WORD, t)
    seen, cover = {}, set()
    for i in range(len(ws) - 7):
        seen.setdefault(tuple(ws[i:i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            for i in at:
                cover.update(range(i, i + 8))
    lines = [x for x in t.split("\n") if re.search(WORD, x)]
    n, rep = len(ws), len(cover)
    return (n, sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), rep, n < 20 or 100 * rep > 30 * n)


def ledger(spark):
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(TEXTS)] + [(0, None, "old")], "doc_id long, text string, n_words string")
    return R.ledger(df)


def test_measures_equal_a_plain_version(spark):
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
           for r in R.apply_policy(ledger(spark)).collect()}
    assert got == {i: plain(t) for i, t in enumerate(TEXTS)}


def test_policies_and_ablation_follow_from_the_bits(spark):
    led = ledger(spark)
    rows = R.apply_policy(led, "v2").collect()
    for r in rows:
        assert r.base_failed == bool(r.rule_bits & R.policy_mask("base"))
        assert r.kept == (not r.rule_bits & (R.policy_mask("base") | R.policy_mask("v2")))
    for a in R.ablation(led, "v2").collect():
        bit = R.bit(a.rule)
        assert a.failed == sum(bool(r.rule_bits & bit) for r in rows)
        assert a.only == sum((r.rule_bits & R.policy_mask("v2")) == bit for r in rows)


def test_no_python_in_the_plan(spark):
    plan = R.apply_policy(ledger(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_empty_table(spark):
    led = R.ledger(spark.createDataFrame([], "doc_id long, text string"))
    assert R.apply_policy(led).collect() == [] and R.ablation(led).collect() == []
