import hashlib
import re

from docsift.llm import secrets as S

TEXTS = [None, "", "nothing here", "password = hunter22", "token: abc", "SECRET:'q/w+e=r_t' and api-key=zzzzzzz api_key=\"longvalue1\" ApiKey: 9999999",
         "secret=token: abcdefgh", "token==abc12", "AKIA" + "A" * 16, "AKIA" + "A" * 15, "AKIAKIA" + "B" * 20 + " AKIA", "é😀 " + "0123456789abcdef" * 2 + "G",
         "deadbeef" * 3 + "g" + "a" * 23, "passwd:   'xyzxyz' passwd=1", "ghp_" + "a1" * 20 + " sk_live_" + "b" * 24, "eyJhbGciOi.eyJzdWIiOj.c2lnbmF0dXJl_and_more",
         "-----BEGIN RSA PRIVATE KEY----- xoxb-123456789012", "x " * 50_000 + "password=whole_text_end", "token=" * 3 + "aaaaaaa", "Key tokKn=abcdefgh"]


def plain(text, rules):
    out = []
    for k, r in enumerate(rules):
        for m in re.finditer(r.pattern, text or ""):
            if len(m.group(r.group)) >= r.least:
                out.append((m.start(), k, r.kind, m.end()))
    return sorted(out)


def joined(spans):
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans)


def docs(spark):
    return spark.createDataFrame([(i, t, "c", "k") for i, t in enumerate(TEXTS)] + [(None, TEXTS[3], "c", "k"), (3, TEXTS[3], "c", "k")],
                                 "doc_id long, text string, secret_spans string, key string")


def test_spans_equal_a_plain_scan(spark):
    rows = S.scan(docs(spark)).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        got = [(s["start"], s["ord"], s["kind"], s["end"]) for s in r.secret_spans]
        assert got == plain(r.text, S.RULES), r.text and r.text[:60]


def test_base_digest(spark, tmp_path):
    docs(spark).select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    for r in S.op3_secret_scan(spark, str(tmp_path)).collect():
        text = TEXTS[r.doc_id if r.doc_id is not None else 3]
        base = plain(text, S.BASE)
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for _, n, _, _ in base) for k in range(3))
        assert r.spans == joined(plain(text, S.RULES))


def test_queries_are_necessary_conditions():
    assert S.trigram_query(r"[0-9a-f]+") is None and S.trigram_query(r"ab|abc") is None
    assert S.trigram_query(r"AKIA[A-Z0-9]+") == [frozenset({"aki", "kia"})]
    assert set(S.trigram_query(r"(?:foo|ba[rz])x?_id")) >= {frozenset({"foo", "oox", "ox_", "x_i", "_id"})}
    for rule in S.RULES:
        q = S.trigram_query(rule.pattern)
        for t in TEXTS:
            if q and t and re.search(rule.pattern, t):
                low = t.lower()
                assert any(all(g in low for g in conj) for conj in q)


def test_redaction_takes_every_span_out(spark):
    for r in S.redact(S.scan(docs(spark))).collect():
        spans = plain(TEXTS[r.doc_id if r.doc_id is not None else 3], S.RULES)
        if not spans:
            assert r.text == TEXTS[r.doc_id]
            continue
        src, at, want = TEXTS[r.doc_id if r.doc_id is not None else 3], 0, ""
        for a, _, kind, b in spans:
            if a >= at:
                want += src[at:a] + f"[{kind}]"
            at = max(at, b)
        assert r.text == want + src[at:]


def test_empty_table(spark):
    assert S.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
