"""Fingerprints of operator 7 against votes counted one by one."""
import random
import re

import xxhash

from docsift.llm import simhash as H


def hash_of(*words):
    seed = 42
    for w in words:
        seed = xxhash.xxh64_intdigest(w.encode(), seed)
    return seed


def plain_fingerprint(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    terms = [(w,) for w in ws] if len(ws) < 2 else list(zip(ws, ws[1:], strict=False))
    votes = [0] * 64
    for t in terms:
        weight = 1 + sum(len(w) >= 4 for w in t)
        h = hash_of(*t)
        for k in range(64):
            votes[k] += weight if h >> k & 1 else -weight
    return f"{sum(1 << k for k in range(64) if votes[k] > 0):016x}"


def test_fingerprints_equal_plain_votes(spark, tmp_path):
    rnd = random.Random(11)
    vocab = [*(f"w{k}" for k in range(60)), "longer", "éèà", "éèàü", "😀😀😀😀", "a b", "x\x1cy", "."]
    texts = ["".join(rnd.choice(vocab) + rnd.choice([" ", "\n", "\t ", "\x0b"]) for _ in range(rnd.randrange(0, 40))) for _ in range(200)]
    texts += [None, "", " \n", "one", "four", "same same same same", "a b a b a b", "word " * 50_000]
    rows = list(enumerate(texts))
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in H.op7_simhash(spark, str(tmp_path)).collect()}
    for i, t in rows:
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(t) // 2
        assert got[i].fingerprint == plain_fingerprint(t), i
        assert got[i].edited_fingerprint == plain_fingerprint(t[:len(t) - half] + nxt[:half]), i
