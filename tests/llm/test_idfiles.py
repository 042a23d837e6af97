import itertools
import json
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from docsift.llm import bpe, idfiles
from docsift.llm.common import shared_path


def best_cost(counts, limit):
    """Cheapest total over all length vectors that fit a prefix code."""
    n = len(counts)
    return min(sum(c * b for c, b in zip(counts, bits)) for bits in itertools.product(range(1, limit + 1), repeat=n)
               if sum(2.0 ** -b for b in bits) <= 1)


@pytest.mark.parametrize("counts,limit", [([1, 1, 2, 4, 8], 3), ([1, 1, 2, 4, 8], 5), ([5, 5, 5, 5], 4), ([1, 100], 4), ([1, 2, 3, 50, 60, 70], 3)])
def test_code_lengths_are_optimal_and_bounded(counts, limit):
    got = idfiles.code_lengths(dict(enumerate(counts)), limit)
    assert max(got.values()) <= limit and sum(2.0 ** -b for b in got.values()) <= 1
    assert sum(counts[i] * b for i, b in got.items()) == best_cost(counts, limit)


def test_pack_and_unpack():
    rng = np.random.default_rng(1)
    docs = [rng.geometric(0.01, n).astype("<u4") for n in (0, 1, 511, 512, 513, 5000)]
    c = np.bincount(np.concatenate(docs))
    codes = idfiles.Codes(idfiles.code_lengths({int(i): int(c[i]) for i in np.flatnonzero(c)}))
    made = [codes.pack(d) for d in docs]
    back = codes.unpack([p for p, _ in made], [q for _, q in made], [len(d) for d in docs])
    assert all((a == b).all() for a, b in zip(docs, back, strict=True))
    # several documents at once are the same bit strings
    for (p, q), (x, y) in zip(made, codes.pack_all(np.concatenate(docs), np.array([len(d) for d in docs])), strict=True):
        assert p == x and (q == y).all()
    # a block decodes from its checkpoint alone
    p, q = made[5]
    one = codes.unpack([p], [q[3:4]], [512])
    assert (one[0] == docs[5][3 * 512:4 * 512]).all()


def test_words_through_the_library_equal_whole_texts():
    lib = idfiles.library(bpe.tokenizer_path())
    texts = ["a.b. foo., É. x1. 1. .. Ab, don't. it's,", "ǅ. İ. ΑΣ, Σ", "\x1cq \x1f", "x<|endoftext|>y z", "", "THE The the. THE,"]
    assert lib.batch(texts) == [lib.whole(t) for t in texts]


def test_random_words_through_the_library_equal_whole_texts():
    lib = idfiles.LibraryWords(bpe.tokenizer_path())
    assert lib.ends is not None
    rnd = random.Random(8)
    parts = [*"abzAZ019.,'\"!?&%$#*-_<>|@/\\~^`{}[]()=+:;", "'s", "'LL", "'Re", "n't", "é", "É", "ß", "ſ", "Ÿ", "ÿ", "İ", "ı", "ŉ", "ǅ", "×", "÷",
             "²", "½", "٣", "é", "Ω", "ΑΣ", "中", "文", "Ж", "😀", "ﬁ", "Å", "\u0301", "\u200d", "\ufeff", "\x00", "\x7f", "the", "Tion", "Öffn"]
    space = [" ", "  ", "\n", "\t", "\u00a0", "\u3000", "\x85", "\x1c", "\u2028", "\u200b"]
    texts = ["".join("".join(rnd.choices(parts, k=rnd.randrange(1, 7))) + (" " if rnd.random() < 0.9 else rnd.choice(space))
                     for _ in range(rnd.randrange(0, 30))) for _ in range(1800)]
    texts += ["A" * 200_000, "é" * 50_000 + "." * 50_000, "a'" * 50_000, "1" * 50_000]
    for lo in range(0, len(texts), 300):
        part = texts[lo:lo + 300]
        for t, got in zip(part, lib.batch(part), strict=True):
            assert got == lib.whole(t), t[:200]


def test_other_rules_send_whole_words_through_the_library(tmp_path):
    with open(bpe.tokenizer_path(), encoding="utf-8") as f:
        spec = json.load(f)
    spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]+"
    (tmp_path / "other.json").write_text(json.dumps(spec), encoding="utf-8")
    lib = idfiles.LibraryWords(str(tmp_path / "other.json"))
    texts = ["abc123, don't a1b2", "Éa9."]
    assert lib.ends is None and lib.batch(texts) == [lib.whole(t) for t in texts]


def test_files_hold_every_document_in_order(spark):
    rows = [(7, "seven words"), (3, None), (5, ""), (None, "no id"), (3, "again three"), (100, "the " * 3000), (3, None)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, start string").repartition(3)
    path = shared_path(spark, "test-ids")
    idfiles.write_files(df, path, bpe.tokenizer_path())
    got = sorted(idfiles.file_digests(spark, path).collect(), key=lambda r: (r.start, r.n_tokens))
    assert [r.doc_id for r in got] == [None, 3, 3, 3, 5, 7, 100]
    tok = Tokenizer.from_file(bpe.tokenizer_path())
    ids = {t: np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for _, t in rows}
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(i), len(ids[t]), zlib.crc32(ids[t].tobytes())) for i, t in rows)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert {tuple(r.ids) for r in idfiles.read_files(spark, path).where("doc_id = 7").collect()} == {tuple(ids["seven words"].tolist())}


def test_empty_table(spark):
    path = shared_path(spark, "test-ids-empty")
    idfiles.write_files(spark.createDataFrame([], "doc_id long, text string"), path, bpe.tokenizer_path())
    assert idfiles.file_digests(spark, path).collect() == []
