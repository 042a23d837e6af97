import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from docsift.llm import pieces

PATH = pieces.model_path()
EDGE = [None, "", " ", "  ", "a", " a", "\n", "a\nb \tc", "▁", "▁▁ a", "<s>", "</s> <unk> <0x41>", "a\x00b", " " * 100, " " * 17 + "the",
        "x" * 1000, "ab" * 500, "日本語 テキスト", "😀😀 smile", "été ́", "ͷ ꙮ", "unbelievable internationalisation"]


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return pieces.model(PATH)


def plain_merge(m, text):
    """Merging as the model file defines it, one merge at a time."""
    parts = list(text)
    while True:
        found = [(m.score[parts[k] + parts[k + 1]], -k) for k in range(len(parts) - 1) if parts[k] + parts[k + 1] in m.score]
        if not found:
            return parts
        k = -max(found)[1]
        parts[k:k + 2] = [parts[k] + parts[k + 1]]


def test_equals_the_library(lib, model):
    rnd = random.Random(3)
    chars = "abcdefghijklmnopqrstuvwxyzABCÉéßñ'’\"!?#$0123456789中文 \n\tΣςİ😀́▁▁    "
    texts = [x or "" for x in EDGE] + ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(rnd.choice("aeinrst ") for _ in range(60)) for _ in range(500)]           # much backtracking
    texts += ["".join(chr(rnd.randrange(*rnd.choice([(32, 0x2fff), (0x4e00, 0x9fff), (0x1f300, 0x1f700)]))) for _ in range(30)) for _ in range(200)]
    for t in texts:
        want = lib.encode(t, add_eos=True)
        got = model.encode(t)
        assert got.tolist() == want, t
        assert model.decode(got) == lib.decode(want), t
    assert model.encode("a b", bos=True, eos=False).tolist() == lib.encode("a b", add_bos=True)


def test_decode_of_any_ids(lib, model):
    rnd = random.Random(5)
    for _ in range(2000):
        ids = [rnd.randrange(rnd.choice([300, model.n_ids])) for _ in range(rnd.randint(0, 9))]
        assert model.decode(np.array(ids, np.int64)) == lib.decode(ids), ids


def test_neighbours_by_merging_anew(model):
    rnd = random.Random(7)
    every, marks = list(model.ids), [s for s in model.ids if not s.strip(pieces.MARK)]
    pairs = [(rnd.choice(every), rnd.choice(every)) for _ in range(4000)] + [(a, b) for a in marks for b in marks + every[:50]]
    for a, b in pairs:
        assert model.compatible(a, b) == (plain_merge(model, a + b) == [a, b]), (a, b)


def test_a_long_stretch_is_encoded_whole(lib, model):
    rnd = random.Random(9)
    t = "".join(rnd.choice("aeinrst") for _ in range(150_000))
    assert model.encode(t).tolist() == lib.encode(t, add_eos=True)


def test_digests(spark, lib):
    rows = [(i, t, "x", "y") for i, t in enumerate(EDGE)] + [(None, "null id", "x", None), (3, "a", "x", "y"), (3, "a", "x", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, _input string")
    got = pieces.round_trip(df, PATH, keep=("doc_id", "n_tokens", "_input"))
    assert got.columns == ["doc_id", "_input", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = []
    for i, t, _, y in rows:
        ids = lib.encode(t or "", add_eos=True)
        want.append((i, y, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_encode_then_decode(spark):
    df = spark.createDataFrame([(1, "Hello there,  World\n"), (2, None), (3, "")], "doc_id long, text string")
    back = {r.doc_id: r.text for r in pieces.decode(pieces.encode(df, PATH), PATH).collect()}
    assert back == {1: "Hello there,  World\n", 2: "", 3: ""}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pieces.round_trip(df, PATH).collect() == []
    assert pieces.encode(df, PATH).collect() == []
