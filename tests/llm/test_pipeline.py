import hashlib
import re
from collections import Counter

import corpus_pipeline as P
from tokenizers import Tokenizer

from docsift.llm import bpe, mixing, quality_model, secrets
from docsift.llm.common import stage
from test_jaccard import plain as plain_components
from test_mixing import plain_targets
from test_secrets import plain as plain_spans

SF = "/root/testdata/sf0.001"


def test_every_stage_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, step in P.STAGES:
        docs = stage(step(spark, docs, SF), f"test-{name}")
        kept[name] = docs.collect()
        if name != "tokens":
            assert docs.columns == list(P.COLUMNS)
    source = spark.read.parquet(f"{SF}/documents.parquet").collect()
    # quality: the classifier's own scores decide
    all_docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality_model.fit(all_docs, spark.read.parquet(f"{SF}/labels.parquet"))
    score = {r.doc_id: r.quality_score for r in quality_model.score(all_docs, model).collect()}
    assert sorted(kept["quality"]) == sorted(r for r in source if score[r.doc_id] >= quality_model.THRESHOLD)
    # near duplicates: the smallest id of each component
    want, n = plain_components([(r.doc_id, r.text) for r in kept["quality"]])
    assert sorted(r.doc_id for r in kept["near_duplicates"]) == sorted(d for d, _, c in want if d == c) and n == len(kept["near_duplicates"])
    # secrets: nothing dropped, spans gone, other texts as they were
    before = {r.doc_id: r for r in kept["near_duplicates"]}
    assert sorted(before) == sorted(r.doc_id for r in kept["secrets"])
    for r in kept["secrets"]:
        spans = plain_spans(before[r.doc_id].text, secrets.RULES)
        assert (r.text == before[r.doc_id].text) == (not spans)
        assert r.n_chars == len(r.text)
    # mixture: copies by rate
    words = Counter()
    for r in kept["secrets"]:
        words[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    target = plain_targets(dict(words), mixing.WEIGHTS, mixing.SHARE, mixing.CAP)
    copies = Counter(r.doc_id for r in kept["mixture"])
    for r in kept["secrets"]:
        rate = target[r.source] / words[r.source] if words[r.source] else 0
        assert int(rate) <= copies[r.doc_id] <= min(2, int(rate) + 1)
    # tokens
    tok = Tokenizer.from_file(bpe.tokenizer_path())
    text = {r.doc_id: r.text for r in kept["mixture"]}
    assert len(kept["tokens"]) == len(kept["mixture"])
    for r in kept["tokens"][:60]:
        ids = tok.encode(text[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_empty_and_odd_rows_pass_every_stage(spark):
    rows = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "a " * 300, "en", None, 600), (2, "a " * 300, "en", None, 600)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for data in ([], rows):
        docs = spark.createDataFrame(data, schema)
        for name, step in P.STAGES:
            docs = stage(step(spark, docs, SF), f"test-odd-{name}")
        docs.collect()
