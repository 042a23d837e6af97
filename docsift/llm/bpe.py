"""Operator 2: BPE encoding by backtracking over longest token matches, and
decoding by an offset table.

Encoding a piece (one pre-token) exactly as greedy merging would, without
merging: an Aho-Corasick automaton over the vocabulary gives the longest token
at a position, a prefix table the next shorter ones.  Tokens are laid left to right; a
token may follow another only if the two are *compatible*, that is, merging
would not have joined symbols across their border.  Where no token fits, the
last one is taken back and its end is marked dead, so each position is left
at most once and the work is linear in the piece.  Compatibility depends on
the two tokens alone and is kept in a table.

Decoding: the strings of all tokens lie end to end in one byte table with
offsets; a document is decoded by one gather over that table.

Cases: null text is the empty text (no ids); unknown columns are ignored by
the operator and kept when asked for; a text of any length is handled whole.
"""

from __future__ import annotations

import functools
import hashlib
import json
import struct
import unicodedata

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from docsift.llm.common import documents, with_fields

#: entries of a worker's word cache before it starts anew (memory bound only)
CACHE_WORDS = 250_000
#: and of its table of pairs and of pre-tokens
PAIRS = 1_000_000
PIECES = 50_000


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(rest)) for b in range(256)]


class Encoder:
    """BPE with word ends, read from a tokenizer file (vocabulary and merges)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = model["vocab"]
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: t for t, i in vocab.items()} | {i: t for t, i in specials.items()}
        self.n_ids = max(self.strings) + 1
        self.special = specials
        self.split_special = regex.compile("(" + "|".join(regex.escape(x) for x in sorted(specials, key=len, reverse=True)) + ")") if specials else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # white space by its Unicode property, as the file's pattern means it
        self.pieces = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}")).findall
        self.byte = byte_chars()
        rank: dict[tuple[int, int], tuple[int, int]] = {}
        made: dict[int, tuple[int, int]] = {}
        for r, (a, b) in enumerate(model["merges"]):
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            rank[x, y] = (r, z)
            made.setdefault(z, (x, y))
        self.rank, self.made = rank, made
        self.order = {z: rank[p][0] for z, p in made.items()}
        self.symbols = {t: i for t, i in vocab.items() if i not in made}
        self.pairs: dict[tuple[int, int], bool] = {}     # compatibility of token pairs met so far
        keys = {self._key(t): i for t, i in vocab.items() if self._reachable(i)}
        self.longest = max(map(len, keys))
        self.auto = ahocorasick.Automaton()
        #: the longest other token that a token begins with, (0, -1) if none
        self.shorter: dict[int, tuple[int, int]] = {}
        for key, i in keys.items():
            self.auto.add_word(key, (len(key), i))
            self.shorter[i] = next(((k, keys[key[:k]]) for k in range(len(key) - 1, 0, -1) if key[:k] in keys), (0, -1))
        self.auto.make_automaton()
        self.sym = [self._key(c + self.suffix) for c in self.byte]
        self.known: dict[str, list[int]] = {}
        self.words: dict[str, bytes] = {}

    def _key(self, token: str) -> str:
        """A token as a string with one character per symbol: a last symbol with a
        word end moves to a private range."""
        if self.suffix and token.endswith(self.suffix):
            body = token[: -len(self.suffix)]
            return body[:-1] + chr(0xE000 + ord(body[-1])) if body else token
        return token

    # -- compatibility ---------------------------------------------------
    def compatible(self, left: int, right: int) -> bool:
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        ok = self.pairs[left, right] = self._compatible(left, right)
        return ok

    def _compatible(self, left: int, right: int) -> bool:
        """Would merging keep ``left`` and ``right`` apart?

        Undo the two tokens from their latest merge back: between the
        rightmost part of ``left`` and the leftmost part of ``right`` a merge
        may exist; it would win if it ranks before the merge undone last (on
        equal rank the one further left goes first).
        """
        edge_l, edge_r = left, right
        bar = float("inf")            # a merge across the border ranked below this would happen first
        while True:
            hit = self.rank.get((edge_l, edge_r))
            if hit is not None and hit[0] < bar:
                return False
            ol, orr = self.order.get(edge_l, -1), self.order.get(edge_r, -1)
            if ol < 0 and orr < 0:
                return True
            if ol > orr:              # the left part was made later: undo it
                bar, edge_l = ol, self.made[edge_l][1]
            else:                     # a tie means equal tokens; the left one is merged first
                bar, edge_r = orr + 0.5, self.made[edge_r][0]

    @functools.cache
    def _reachable(self, token: int) -> bool:
        """Merging this token's own symbols yields the token."""
        parts = self.made.get(token)
        if parts is None:
            return True
        a, b = parts
        if not (self._reachable(a) and self._reachable(b)):
            return False
        rank = self.rank[a, b][0]
        # a and b stand side by side until their merge: nothing across the border ranks before it
        edge_l, edge_r, bar = a, b, float("inf")
        while True:
            hit = self.rank.get((edge_l, edge_r))
            if hit is not None and hit[0] < bar and hit[0] != rank:
                return False
            ol, orr = self.order.get(edge_l, -1), self.order.get(edge_r, -1)
            if ol < 0 and orr < 0:
                return True
            if ol > orr:
                bar, edge_l = ol, self.made[edge_l][1]
            else:
                bar, edge_r = orr + 0.5, self.made[edge_r][0]

    # -- encoding --------------------------------------------------------
    def piece(self, piece: str) -> list[int]:
        """Ids of one pre-token."""
        raw, byte, pairs = piece.encode("utf-8"), self.byte, self.pairs
        key = (piece[:-1] if piece.isascii() and piece.isalnum() else "".join([byte[b] for b in raw[:-1]])) + self.sym[raw[-1]]
        n, out, sizes, at, last = len(key), [], [], 0, -1
        dead = bytearray(n + 1)                         # 1: no tokens end here; marked and tested in constant time
        matches, safe = None, 0                         # longest matches, one after the other, over a stretch of the
        while at < n:                                   # piece: the automaton copies what it is given
            if matches is None or at > safe:
                matches = self.auto.iter_long(key[at:at + 4 * self.longest] if at or n > 4 * self.longest else key)
                safe = at + 3 * self.longest if at + 4 * self.longest < n else n
            size, token = next(matches)[1]
            while True:
                if not dead[at + size]:
                    if last < 0:
                        break
                    ok = pairs.get((last, token))
                    if ok is None:
                        ok = self.compatible(last, token)
                    if ok:
                        break
                matches = None                          # from here on they start elsewhere
                size, token = self.shorter[token]
                while not size:                         # nothing fits here: take the last token back
                    if not out:
                        return [i for c in key for i in self._symbol(c)]
                    dead[at] = 1
                    token, size = out.pop(), sizes.pop()
                    at -= size
                    last = out[-1] if out else -1
                    size, token = self.shorter[token]
            out.append(token)
            sizes.append(size)
            at += size
            last = token
        return out

    def _symbol(self, c: str) -> list[int]:
        t = chr(ord(c) - 0xE000) + self.suffix if ord(c) >= 0xE000 else c
        return [self.symbols[t]] if t in self.symbols else []

    def normal(self, text: str) -> str:
        """NFC and lower case, character by character (no final-sigma rule)."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def word(self, word: str) -> bytes:
        """Ids of a stretch without white space, as little-endian unsigned 32-bit integers."""
        got, known = [], self.known
        for p in self.pieces(self.normal(word)):
            ids = known.get(p)
            if ids is None:
                ids = self.piece(p)
                if len(p) < 5 and len(known) < PIECES:
                    known[p] = ids
            got += ids
        return struct.pack(f"<{len(got)}I", *got)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; a special token's string counts as that token."""
        parts = self.split_special.split(text) if self.split_special and "<" in text else [text]
        out = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(np.uint32(self.special[part]).tobytes())
                continue
            if any(c in part for c in "\x1c\x1d\x1e\x1f"):   # str.split would drop these
                out.append(self.word(part))
                continue
            words = part.split()
            cache = self.words
            try:
                out.append(b"".join([cache[w] for w in words]))
            except KeyError:
                if len(cache) > CACHE_WORDS:
                    cache.clear()
                for w in words:
                    if w not in cache:
                        cache[w] = self.word(w)
                out.append(b"".join([cache[w] for w in words]))
        return np.frombuffer(b"".join(out), "<u4")


class Table:
    """Strings of ids end to end with offsets; ``text`` is one gather."""

    def __init__(self, strings: dict[int, str], n: int, sep: str = " "):
        parts = [(strings.get(i, "") + sep).encode("utf-8") for i in range(n)]
        self.sep = len(sep.encode())
        self.off = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        self.data = np.frombuffer(b"".join(parts), np.uint8)

    def text(self, ids: np.ndarray) -> bytes:
        """The strings of ``ids`` joined by the separator."""
        if not len(ids):
            return b""
        start, size = self.off[ids], self.off[ids.astype(np.int64) + 1] - self.off[ids]
        done = np.cumsum(size)
        place = np.repeat(start - (done - size), size) + np.arange(done[-1])
        return self.data[place[: -self.sep]].tobytes()


@functools.lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@functools.lru_cache(2)
def tables(path: str) -> tuple[Table, Table]:
    e = encoder(path)
    return Table(e.strings, e.n_ids), Table({i: str(i) for i in range(e.n_ids)}, e.n_ids)


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``ids`` (array of int) of every whole text."""
    def run(batches):
        e = encoder(path)
        for b in batches:
            got = [e.encode(t or "") for t in b.column("_text").to_pylist()]
            off = np.concatenate([[0], np.cumsum([len(g) for g in got])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(off, pa.array(np.concatenate(got).astype(np.int32) if got else [], pa.int32()))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), ids], [*keep, "ids"])
    src = docs.select(*keep, docs[text].cast("string").alias("_text"))
    return src.mapInArrow(run, with_fields(src.select(*keep), "ids array<int>"))


def decode(rows: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``text``: the token strings joined by a space."""
    def run(batches):
        table = tables(path)[0]
        for b in batches:
            got = [table.text(np.asarray(x, np.int64)).decode("utf-8") if x else "" for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(got, pa.string())], [*keep, "text"])
    src = rows.select(*keep, "ids")
    return src.mapInArrow(run, with_fields(src.select(*keep), "text string"))


def round_trip(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Encode and decode every whole text in one pass and keep digests only.

    Adds ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``; the ids of one
    document are in memory at a time, nothing is shuffled.
    """
    def run(batches):
        e = encoder(path)
        words, numbers = tables(path)
        for b in batches:
            n, a, d = [], [], []
            for t in b.column("_text"):
                ids = e.encode(t.as_py() or "")
                n.append(len(ids))
                a.append(hashlib.sha256(numbers.text(ids)).hexdigest())
                d.append(hashlib.sha256(words.text(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in keep), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())],
                [*keep, "n_tokens", "ids_sha256", "decoded_sha256"])
    src = docs.select(*keep, docs[text].cast("string").alias("_text"))
    schema = with_fields(src.select(*keep), "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return src.mapInArrow(run, schema)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir, "doc_id", "text"), tokenizer_path())
