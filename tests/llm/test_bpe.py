import hashlib
import random

import pytest
from tokenizers import Tokenizer

from docsift.llm import bpe

EDGE = [None, "", "  \t\n", "a", "THE the The", "don't they'll I'd 's 'ttt", "1234567890 12ab34", "!!!??? ... #$%&", "日本語 テキスト",
        "😀😀 smile", "ΑΣΣ Σ. σας", "İstanbul ı", "été ́", "\x1cx\x1d \x1f", "a\x00b", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 20,
        "foo<|endoftext|>bar <|startoftext|>", "<|endoftext", "unbelievable internationalisation"]


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(bpe.tokenizer_path())


def test_encoder_equals_the_library(lib):
    e = bpe.encoder(bpe.tokenizer_path())
    rnd = random.Random(3)
    chars = "abcdefghijklmnopqrstuvwxyzABCÉéßñ'’\"!?#$0123456789中文 \n\tΣςİ😀́"
    texts = [x or "" for x in EDGE] + ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 40))) for _ in range(1500)]
    texts += ["".join(rnd.choice("aeinrst") for _ in range(30)) for _ in range(300)]     # much backtracking
    texts += [e.strings[i].replace("</w>", "") for i in range(0, e.n_ids, 97)]
    for t in texts:
        assert e.encode(t).tolist() == lib.encode(t, add_special_tokens=False).ids, t


def test_a_long_text_is_encoded_whole(lib):
    e = bpe.encoder(bpe.tokenizer_path())
    t = " ".join(f"word{i}x" for i in range(60_000))
    assert len(e.encode(t)) == len(lib.encode(t, add_special_tokens=False).ids)


def test_digests(spark, lib):
    rows = [(i, t, "x") for i, t in enumerate(EDGE)] + [(None, "null id", "x"), (3, "a", "x"), (3, "a", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.round_trip(df, bpe.tokenizer_path()).collect()
    assert len(got) == len(rows)
    want = []
    for i, t, _ in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_encode_then_decode(spark, lib):
    df = spark.createDataFrame([(1, "Hello there, World"), (2, None)], "doc_id long, text string")
    ids = bpe.encode(df, bpe.tokenizer_path())
    back = {r.doc_id: r.text for r in bpe.decode(ids, bpe.tokenizer_path()).collect()}
    assert back == {1: lib.decode(lib.encode("Hello there, World", add_special_tokens=False).ids, skip_special_tokens=False), 2: ""}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.round_trip(df, bpe.tokenizer_path()).collect() == []


def test_very_long_pieces(lib):
    rnd, enc = random.Random(5), bpe.encoder(bpe.tokenizer_path())
    for piece in ("".join(rnd.choice("etaoinshr") for _ in range(300_000)), "ab" * 100_000, "x" * 200_000):
        assert enc.encode(piece).tolist() == lib.encode(piece, add_special_tokens=False).ids
