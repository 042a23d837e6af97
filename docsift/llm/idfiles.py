"""Operator 8: token ids as canonical length-limited Huffman files.

Writing, as Spark jobs over all documents:

1. every whole text is encoded once with the tokenizers library (words are
   looked up first, only pre-tokens not met before go through the library)
   and stored as a compressed table of ids in the shared folder;
2. the ids are counted globally (one partial count per task, then summed);
   from the counts, of which there are at most as many as ids in the
   vocabulary, code lengths of at most ``MAX_BITS`` follow by package-merge,
   and from the lengths alone the canonical codes;
3. each document becomes one bit string on the task that reads it, with a
   checkpoint (bit offset) every ``BLOCK`` ids, so its blocks decode
   independently of one another;
4. the rows go to ranges of doc_id (quantiles of that column), one file per
   range, sorted; a row of a file is one document.  Next to them lie the
   code lengths.

The file format is Parquet: ``codes/`` (id, bits) and ``data/part=K/`` (row,
doc_id, n_tokens, checkpoints, payload).  Reading needs nothing else: the
codes are rebuilt from the lengths, all blocks of a batch are decoded in
step through a lookup table of 2**MAX_BITS entries, and positions are sums
of the stored token counts per part plus the offset of the part.

Cases: null text has the end id only; an empty table writes files without
rows; equal doc_ids are ordered by the digest of their ids (equal rows are
interchangeable), null doc_ids come first.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsift.llm.bpe import tokenizer_path
from docsift.llm.common import documents, shared_path, with_fields

END_ID = 2
#: entries of a worker's word cache before it starts anew (memory bound only)
CACHE_WORDS = 1_000_000
MAX_BITS = 16
BLOCK = 512
#: blocks decoded in step; bounds the memory of a decoding task
LANES = 4096
#: ids of several documents handled together while counting and packing
GROUP_IDS = 1 << 18


# ---------------------------------------------------------------- encoding with the library

#: fixed values: how the tokenizer file folds text and cuts it into pre-tokens
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: words of ASCII and of Latin letters that are their own NFC form and fold one to one,
#: and their pre-tokens once folded
PLAIN = re.compile("[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+").fullmatch
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017f]+|[0-9]|[^0-9a-z\u00df-\u00f6\u00f8-\u017f]+").findall


class LibraryWords:
    """Ids of texts by the tokenizers library, each distinct pre-token once.

    The normaliser and the pre-tokenizer of the file never look across white
    space, so a text's ids are those of its words in order.  A word of
    ``PLAIN`` characters is folded and cut where the pre-tokenizer cuts it, and
    its ids are those of its pieces; other words go through the library as
    they are, and so do all words if the file folds or cuts otherwise.  Texts
    with a special token's string or with separators that only ``str.split``
    takes for white space are encoded whole.
    """

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        self.tok.no_padding()
        self.tok.no_truncation()
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.sep = self.special[-1] if self.special else None
        self.sep_id = self.tok.token_to_id(self.sep) if self.sep else -1
        self.kind = np.dtype("<u2" if max(self.tok.get_vocab().values()) < 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.ends = self.word_ends(path)
        # the same vocabulary and merges for what is folded and cut already
        self.merges = Tokenizer.from_file(path)
        self.merges.normalizer = normalizers.Sequence([])
        self.merges.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])

    def word_ends(self, path: str) -> np.ndarray | None:
        """Which ids end a pre-token, or None if the file does not cut as ``PIECES`` does."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"].get("end_of_word_suffix")
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        pattern = (steps[0].get("pattern") or {}).get("Regex")
        if not suffix or pattern != PRE_TOKENS or (spec.get("normalizer") or {}).get("normalizers") != NORMALIZERS:
            return None
        vocab = self.tok.get_vocab()
        ends = np.zeros(max(vocab.values()) + 1, bool)
        ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        return ends

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def learn(self, words: list[str], known: dict[str, bytes]) -> None:
        """One pass over new words; a special token between them keeps them apart."""
        for i in range(0, len(words), 2000):
            part = words[i:i + 2000]
            ids = np.asarray(self.tok.encode_batch_fast([self.sep.join(part)], add_special_tokens=False)[0].ids, "<u4")
            cut = np.flatnonzero(ids == self.sep_id)
            self.keep(part, ids, [0, *(cut + 1).tolist()], [*cut.tolist(), len(ids)], known)

    def learn_pieces(self, pieces: list[str]) -> None:
        """One pass over new pre-tokens, with spaces between them: each ends with an id that ends a word."""
        for i in range(0, len(pieces), 2000):
            part = pieces[i:i + 2000]
            ids = np.asarray(self.merges.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            cut = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(cut) == len(part) and cut[-1] == len(ids):
                self.keep(part, ids, [0, *cut[:-1]], cut, self.pieces)
            else:
                self.learn(part, self.pieces)

    def keep(self, words: list[str], ids: np.ndarray, lo: list[int], hi: list[int], known: dict[str, bytes]) -> None:
        raw, k = ids.astype(self.kind).tobytes(), self.kind.itemsize
        for w, a, b in zip(words, lo, hi, strict=True):
            known[w] = raw[k * a:k * b]

    def batch(self, texts: list[str]) -> list[bytes]:
        odd = [any(s in t for s in self.special) or any(c in t for c in "\x1c\x1d\x1e\x1f") for t in texts]
        if self.sep is None:
            odd = [True] * len(texts)
        words = [[] if o else t.split() for t, o in zip(texts, odd, strict=True)]
        known, pieces = self.known, self.pieces
        new = set().union(*words).difference(known)
        if len(new) + len(known) > CACHE_WORDS:
            known.clear()
            new = set().union(*words)
        if len(pieces) > CACHE_WORDS:
            pieces.clear()
        plain = [] if self.ends is None else new if not new or PLAIN("".join(new)) else [w for w in new if PLAIN(w)]
        if len(plain) < len(new):
            self.learn(list(new.difference(plain)), known)
        cut = []
        for w in plain:
            x = w.lower()
            if x in pieces:
                known[w] = pieces[x]
            elif x.isalpha():
                cut.append((w, (x,)))
            elif x[-1] in ".," and x[:-1].isalpha():
                cut.append((w, (x[:-1], x[-1])))
            else:
                cut.append((w, PIECES(x)))
        self.learn_pieces(list({p for _, ps in cut for p in ps if p not in pieces}))
        for w, ps in cut:
            known[w] = pieces[ps[0]] if len(ps) == 1 else b"".join([pieces[p] for p in ps])
        of = known.__getitem__
        return [self.whole(t) if o else b"".join(map(of, ws))
                for t, o, ws in zip(texts, odd, words, strict=True)]


@functools.lru_cache(2)
def library(path: str) -> LibraryWords:
    return LibraryWords(path)


def token_rows(docs: DataFrame, path: str, end_id: int | None = END_ID) -> DataFrame:
    """(doc_id, n_tokens, ids binary): little-endian ids of every whole text, of
    16 bits each if all ids of the tokenizer fit, else of 32."""
    def run(batches):
        lib = library(path)
        tail = b"" if end_id is None else np.asarray([end_id], lib.kind).tobytes()
        for b in batches:
            for i in range(0, b.num_rows, 500):
                c = b.slice(i, 500)
                ids = [x + tail for x in lib.batch([t or "" for t in c.column("text").to_pylist()])]
                yield pa.RecordBatch.from_arrays(
                    [c.column("doc_id"), pa.array([len(x) // lib.kind.itemsize for x in ids], pa.int64()),
                     pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])
    src = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    return src.mapInArrow(run, with_fields(src.select("doc_id"), "n_tokens long, ids binary"))


def id_groups(batch: pa.RecordBatch, size: int = GROUP_IDS):
    """(first row, ids end to end, their number in each row) of some rows after
    another: about ``size`` ids, or one row with more."""
    n = batch.column("n_tokens").to_numpy()
    end = np.cumsum(n)
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(end, (end[lo - 1] if lo else 0) + size, "right")))
        raw = b"".join(batch.column("ids").slice(lo, hi - lo).to_pylist())
        total = int(n[lo:hi].sum())
        yield lo, np.frombuffer(raw, f"<u{len(raw) // total if total else 4}"), n[lo:hi]
        lo = hi


def id_counts(rows: DataFrame) -> DataFrame:
    """(id, n): global counts; a task sends one row per id it met."""
    def run(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            for _, ids, _ in id_groups(b):
                c = np.bincount(ids)
                if len(c) > len(total):
                    total, c = c, total
                total[:len(c)] += c
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(total[k], pa.int64())], ["id", "n"])
    return rows.select("n_tokens", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- codes

def code_lengths(counts: dict[int, int], limit: int = MAX_BITS) -> dict[int, int]:
    """Optimal code lengths of at most ``limit`` bits (package-merge)."""
    ids = sorted(counts, key=lambda i: (counts[i], i))
    if len(ids) < 2:
        return {i: 1 for i in ids}
    if len(ids) > 1 << limit:
        raise ValueError("more ids than codes of that length")
    # a package is (weight, leaves below it as counts of the cheapest ids, which are always a prefix)
    leaves = [counts[i] for i in ids]
    taken, packages = [], []
    for _ in range(limit):
        level = list(heapq.merge(((w, 1) for w in leaves), ((w, 0) for w in packages), key=lambda x: x[0]))
        taken.append(np.concatenate([[0], np.cumsum([leaf for _, leaf in level])]))
        packages = [level[k][0] + level[k + 1][0] for k in range(0, len(level) - 1, 2)]
    bits = np.zeros(len(ids) + 1, np.int64)
    need = 2 * len(ids) - 2
    for level in reversed(taken):
        n_leaves = int(level[need])
        bits[0] += 1
        bits[n_leaves] -= 1
        need = 2 * (need - n_leaves)
    return dict(zip(ids, np.cumsum(bits)[:-1].tolist(), strict=True))


class Codes:
    """Canonical codes from lengths: shorter first, equal lengths by id."""

    def __init__(self, lengths: dict[int, int], limit: int = MAX_BITS):
        order = sorted(lengths, key=lambda i: (lengths[i], i))
        size = max(order, default=0) + 1
        self.limit = limit
        self.code, self.bits = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.table_id, self.table_bits = np.zeros(1 << limit, np.uint32), np.ones(1 << limit, np.int64)
        code = 0
        for k, i in enumerate(order):
            n = lengths[i]
            if k:
                code = (code + 1) << (n - lengths[order[k - 1]])
            self.code[i], self.bits[i] = code, n
            lo = code << (limit - n)
            self.table_id[lo:lo + (1 << (limit - n))] = i
            self.table_bits[lo:lo + (1 << (limit - n))] = n

    def pack(self, ids: np.ndarray, block: int = BLOCK) -> tuple[bytes, np.ndarray]:
        """(bit string, bit offset of every block)."""
        return self.pack_all(ids, np.array([len(ids)]), block)[0]

    def pack_all(self, ids: np.ndarray, counts: np.ndarray, block: int = BLOCK) -> list[tuple[bytes, np.ndarray]]:
        """``pack`` of several documents, whose ids lie end to end; each starts a 32-bit cell."""
        bits = self.bits[ids]
        end = np.concatenate([[0], np.cumsum(bits)])
        last = np.cumsum(counts)
        first = last - counts
        total = end[last] - end[first]
        base = np.concatenate([[0], np.cumsum((total + 31) // 32)])
        start = end[:-1] - np.repeat(end[first], counts)
        at = start + np.repeat(32 * base[:-1], counts)
        words = np.zeros(base[-1] + 2, np.uint64)
        # a code lies in at most two 32-bit cells; codes do not overlap, so sums are bit unions
        shifted = self.code[ids] << (np.uint64(64) - (at % 32 + bits).astype(np.uint64))
        cell = at // 32
        lead = np.flatnonzero(np.diff(cell, prepend=-1))
        if len(ids):
            words[cell[lead]] += np.add.reduceat(shifted >> np.uint64(32), lead)
            words[cell[lead] + 1] += np.add.reduceat(shifted & np.uint64(0xFFFFFFFF), lead)
        raw = words.astype(">u4").tobytes()
        return [(raw[4 * b:4 * b + (t + 7) // 8], start[p:q:block])
                for b, t, p, q in zip(base[:-1].tolist(), total.tolist(), first.tolist(), last.tolist(), strict=True)]

    def unpack(self, payloads: list[bytes], checkpoints: list[np.ndarray], counts: list[int], block: int = BLOCK) -> list[np.ndarray]:
        """Ids of several documents; all their blocks advance together."""
        base = np.concatenate([[0], np.cumsum([len(p) for p in payloads])])
        data = np.frombuffer(b"".join(payloads) + bytes(8), np.uint8)
        lanes = np.lib.stride_tricks.as_strided(data[:4].view(">u4"), (len(data) - 3,), (1,))
        at = np.concatenate([np.asarray(c, np.int64) + 8 * b for c, b in zip(checkpoints, base[:-1], strict=True)] or [np.zeros(0, np.int64)])
        size = np.concatenate([np.minimum(block, n - block * np.arange(len(c))) for c, n in zip(checkpoints, counts, strict=True)] or [np.zeros(0, np.int64)])
        out = np.zeros(int(size.sum()), np.uint32)
        place = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
        for lo in range(0, len(at), LANES):
            pos, left, to = at[lo:lo + LANES].copy(), size[lo:lo + LANES], place[lo:lo + LANES]
            order = np.argsort(-left, kind="stable")          # longest first: the live ones stay in front
            pos, left, to = pos[order], left[order], to[order]
            live = np.searchsorted(-left, -np.arange(1, (left[0] if len(left) else 0) + 1), "right")
            down, mask = np.uint32(32 - self.limit), (1 << self.limit) - 1
            for k, n in enumerate(live):
                p = pos[:n]
                peek = ((lanes[p >> 3] >> (down - (p & 7).astype(np.uint32))) & np.uint32(mask))
                out[to[:n] + k] = self.table_id[peek]
                p += self.table_bits[peek]
        return np.split(out, np.cumsum(counts)[:-1]) if counts else []


# ---------------------------------------------------------------- files

def write_files(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = END_ID) -> None:
    """Encode every whole text of ``docs`` and write the id files under ``path``."""
    spark = docs.sparkSession
    store = shared_path(spark, "ids")
    token_rows(docs, tokenizer, end_id).write.option("compression", "zstd").parquet(store)
    rows = spark.read.parquet(store)
    id_counts(rows).write.parquet(f"{store}-counts")
    counts = {r.id: r.n for r in spark.read.parquet(f"{store}-counts").toLocalIterator()}   # at most the vocabulary
    lengths = code_lengths(counts)
    spark.createDataFrame(list(lengths.items()), "id long, bits int").coalesce(1).write.parquet(f"{path}/codes")
    shipped = spark.sparkContext.broadcast(lengths)                                          # same bound

    bounds = id_ranges(rows)

    def run(batches):
        codes = Codes(shipped.value)
        for b in batches:
            for lo, ids, n in id_groups(b):
                made = codes.pack_all(ids, n)
                doc = b.column("doc_id").slice(lo, len(n))
                key = doc.is_valid().to_numpy(zero_copy_only=False)
                part = np.where(key, np.searchsorted(bounds, doc.fill_null(0).to_numpy(zero_copy_only=False), "right"), 0)
                yield pa.RecordBatch.from_arrays(
                    [doc, pa.array(n), pa.array(part, pa.int32()), pa.array([zlib.crc32(p) for p, _ in made], pa.int64()),
                     pa.array([c for _, c in made], pa.list_(pa.int64())), pa.array([p for p, _ in made], pa.binary())],
                    ["doc_id", "n_tokens", "part", "tie", "checkpoints", "payload"])
    schema = with_fields(rows.select("doc_id"), "n_tokens long, part int, tie long, checkpoints array<long>, payload binary")
    (rows.mapInArrow(run, schema).repartition(len(bounds) + 1, "part")
     .sortWithinPartitions("part", "doc_id", "tie").withColumn("row", F.monotonically_increasing_id())
     .write.partitionBy("part").parquet(f"{path}/data"))


def id_ranges(rows: DataFrame) -> np.ndarray:
    """Inner boundaries of as many ranges of doc_id as there are shuffle
    partitions, from a scan of that column alone."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = rows.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)] or [0.5], 100 * n).alias("q")).first().q
    return np.unique(np.asarray(at or [], np.int64))


DATA = "doc_id {id}, n_tokens long, tie long, checkpoints array<long>, payload binary, row long, part int"


def decoded(spark: SparkSession, path: str, column: str, kind: str, of, id_type: str = "long") -> DataFrame:
    """(doc_id, start, n_tokens, column): ``of(ids)`` for every document in the files.

    ``start`` is the number of ids of all documents before: the running sum
    within the part over (row, n_tokens) only, plus the parts before it.
    """
    lengths = {r.id: r.bits for r in spark.read.parquet(f"{path}/codes").toLocalIterator()}   # at most the vocabulary
    shipped = spark.sparkContext.broadcast(lengths)
    data = spark.read.schema(DATA.format(id=id_type)).parquet(f"{path}/data")

    def run(batches):
        made = Codes(shipped.value)
        for b in batches:
            for i in range(0, b.num_rows, 2000):
                s = b.slice(i, 2000)
                ids = made.unpack(s.column("payload").to_pylist(), s.column("checkpoints").to_pylist(),
                                  s.column("n_tokens").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(s.column(c) for c in ("doc_id", "part", "row", "n_tokens")), pa.array([of(x) for x in ids])],
                    ["doc_id", "part", "row", "n_tokens", column])
    src = data.select("doc_id", "part", "row", "n_tokens", "checkpoints", "payload")
    got = src.mapInArrow(run, with_fields(src.select("doc_id", "part", "row", "n_tokens"), f"{column} {kind}"))
    return got.join(starts(data), ["part", "row"]).select("doc_id", "start", "n_tokens", column)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): what the files hold, in any row order."""
    return decoded(spark, path, "ids", "array<long>", lambda x: x.astype(np.int64))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): unsigned crc32 of the 32-bit little-endian ids."""
    return decoded(spark, path, "ids_crc32", "long", lambda x: zlib.crc32(x.astype("<u4").tobytes()))


def starts(data: DataFrame) -> DataFrame:
    """(part, row, start) from the token counts alone."""
    inside = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)    # one row per part
    parts = (data.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
             .select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    rows = data.select("part", "row", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("_in"))
    return rows.join(F.broadcast(parts), "part").select("part", "row", (F.col("_in") + F.col("_before")).alias("start"))


def op8_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "idfiles")
    write_files(documents(spark, sf_dir, "doc_id", "text"), path, tokenizer_path())
    return file_digests(spark, path)
