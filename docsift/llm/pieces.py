"""Operator 13: SentencePiece (merge type) encoding by backtracking, and decoding.

The model file holds pieces with scores and no merge list: two neighbours may
merge whenever their joined string is a piece, the highest score goes first,
the leftmost of equal ones before the others.  Encoding here merges nothing:

* an Aho-Corasick automaton over the pieces gives the longest piece at a
  position, a chain of prefixes the next shorter ones;
* pieces are laid left to right.  Two pieces may stand side by side if
  merging their joined characters anew gives just these two; that depends on
  the two alone and is kept in a table.  A sequence whose neighbours all pass
  is the one that merging the whole text gives: the first merge across one of
  its borders would also be made in the joined characters of that pair;
* where nothing fits, the last piece is taken back and its end is marked in a
  bit field of failed positions, so no position is tried twice and the work
  is linear in the text.

A text is cut first where no piece can lie across: before a space mark that
follows another character (if no piece has a mark after another character,
which is checked when the file is read) and around characters that no longer
piece holds.  Stretches between cuts are independent, and short ones are
encoded once per worker.  A character without a piece becomes its UTF-8 bytes.

Decoding gathers the bytes of all pieces from an offset table, drops the mark
that encoding put in front, and replaces each byte that is not part of a valid
character by U+FFFD.

Cases: null text is the empty text (the end id only); texts of any length are
encoded whole; repeated rows and ties give equal rows; an empty table gives no
rows; columns are kept only when asked for, and a kept column whose name is
one of the operator's results is left out in favour of the result.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import re
import struct

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from docsift.llm.common import documents, with_fields

MARK = "▁"
# Fixed values of the model file: kinds of a piece.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

#: memory bounds of a worker: stretches kept, their length, pairs kept
STRETCHES, STRETCH_CHARS, PAIRS = 1_000_000, 64, 1_000_000
#: characters that the automaton reads ahead in a stretch (longer than any piece)
WINDOW = 256


def _varint(b: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (b[i] & 127) << shift
        if b[i] < 128:
            return value, i + 1
        i, shift = i + 1, shift + 7


def _fields(b: bytes):
    """(number, value) of the fields of one protocol-buffer message."""
    i = 0
    while i < len(b):
        tag, i = _varint(b, i)
        if tag & 7 == 0:
            value, i = _varint(b, i)
        else:
            size, i = _varint(b, i) if tag & 7 == 2 else (8 if tag & 7 == 1 else 4, i)
            value, i = b[i:i + size], i + size
        yield tag >> 3, value


class Model:
    """A merge-type model file: pieces, scores, kinds, and the encoder over them."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            blocks = list(_fields(f.read()))
        rows = [dict(_fields(v)) for n, v in blocks if n == 1]
        trainer = next((dict(_fields(v)) for n, v in blocks if n == 2), {})
        norm = next((dict(_fields(v)) for n, v in blocks if n == 3), {})
        if trainer.get(3, 1) != 2 or norm.get(2) or norm.get(4, 1) or not norm.get(5, 1) or trainer.get(24, 0):
            raise ValueError(f"{path}: merge-type models that leave texts as they are, marks in front, are read; this is another kind")
        self.prefix = MARK if norm.get(3, 1) else ""
        self.kind = [r.get(3, NORMAL) for r in rows]
        if USER_DEFINED in self.kind or UNUSED in self.kind:
            raise ValueError(f"{path}: user-defined and unused pieces are not supported")
        self.strings = [r.get(1, b"").decode("utf-8") for r in rows]
        self.ids = {s: i for i, s in enumerate(self.strings) if self.kind[i] == NORMAL}
        self.score = {s: struct.unpack("<f", rows[i].get(2, bytes(4)))[0] for s, i in self.ids.items()}
        self.n_ids, self.unk = len(rows), self.kind.index(UNKNOWN)
        self.bos, self.eos = trainer.get(41, 1), trainer.get(42, 2)
        byte = {int(s[3:5], 16): i for i, s in enumerate(self.strings) if self.kind[i] == BYTE}
        self.byte = [byte[b] for b in range(256)] if trainer.get(35) else None

        inside = {c for s in self.ids if len(s) > 1 for c in s}
        joined = "".join(map(re.escape, sorted(inside - {MARK})))
        apart = not any(MARK in s.lstrip(MARK) for s in self.ids)      # marks stand in front only
        if apart and joined:
            self.cut = re.compile(f"{MARK}*[{joined}]+|{MARK}+|[^{MARK}{joined}]+").findall
        else:
            self.cut = re.compile(f"[{MARK}{joined}]+|[^{MARK}{joined}]+").findall
        self.inside = inside | {MARK}
        self.auto = ahocorasick.Automaton()
        for s in self.ids.keys() | self.inside:                          # a character without a piece stands for itself
            self.auto.add_word(s, s)
        self.auto.make_automaton()
        self.longest = max(map(len, self.ids))
        self.pairs: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}
        self._tables()

    # -- merging anew, of one piece or two --------------------------------
    @functools.cache
    def trace(self, piece: str) -> tuple[list[float], list[str], list[str]] | None:
        """How merging the characters of ``piece`` goes: the score of each merge
        (and -inf after the last), the first and the last part before each.  None
        if the merges do not end in the whole piece."""
        parts, score, scores, first, last = list(piece), self.score, [], [], []
        while True:
            first.append(parts[0])
            last.append(parts[-1])
            joins = [(s, -k) for k in range(len(parts) - 1) if (s := score.get(parts[k] + parts[k + 1])) is not None]
            if not joins:
                scores.append(float("-inf"))
                return (scores, first, last) if len(parts) == 1 else None
            s, k = max(joins)
            scores.append(s)
            parts[-k:2 - k] = [parts[-k] + parts[1 - k]]

    def compatible(self, left: str, right: str) -> bool:
        """Does merging ``left + right`` anew give just the two?  (left empty: right alone)

        Both sides' merges are made again in their common order, the higher
        score first and the left side first on equal ones; the two stay apart
        if the parts at the border never have a merge that is due before.
        """
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        a, b = self.trace(left) if left else None, self.trace(right)
        ok = b is not None and (not left or a is not None and self._apart(a[0], a[2], b[0], b[1]))
        self.pairs[left, right] = ok
        return ok

    def _apart(self, left_scores, left_last, right_scores, right_first) -> bool:
        score, none, i, j = self.score.get, float("-inf"), 0, 0
        while True:
            across = score(left_last[i] + right_first[j], none)
            x, y = left_scores[i], right_scores[j]
            if across > none and (across > x if x >= y else across >= y):
                return False
            if x == y == none:
                return True
            if x >= y:
                i += 1
            else:
                j += 1

    @functools.cache
    def shorter(self, piece: str) -> str:
        """The longest other piece that ``piece`` begins with; empty if none."""
        return next((piece[:k] for k in range(len(piece) - 1, 0, -1) if piece[:k] in self.auto), "")

    # -- encoding ---------------------------------------------------------
    def stretch(self, text: str) -> list[str]:
        """Pieces of a stretch whose characters all occur in longer pieces."""
        n, out, at, last, pairs, stop = len(text), [], 0, "", self.pairs, 0
        failed = bytearray((n >> 3) + 1)                    # a bit for each position
        matches = None                                      # longest pieces, one after the other
        while at < n:
            if matches is None or at + self.longest > stop < n:
                stop = min(n, at + max(WINDOW, 2 * self.longest))                  # starting anew costs the window, not the text
                matches = self.auto.iter_long(text[at:stop])
            piece = next(matches)[1]
            while True:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1:
                    ok = pairs.get((last, piece))
                    if ok is None:
                        ok = self.compatible(last, piece)
                    if ok:
                        break
                matches = None                              # from here on they start elsewhere
                piece = self.shorter(piece)
                while not piece:                            # nothing fits here: take the last piece back
                    failed[at >> 3] |= 1 << (at & 7)
                    piece = out.pop()
                    at -= len(piece)
                    last = out[-1] if out else ""
                    piece = self.shorter(piece)
            out.append(piece)
            at += len(piece)
            last = piece
        return out

    def _ids(self, part: str) -> bytes:
        """Ids of the text between two cuts, as little-endian unsigned 32-bit integers."""
        pieces = self.stretch(part) if part[-1] in self.inside else part
        ids = []
        for p in pieces:
            i = self.ids.get(p)
            if i is not None:
                ids.append(i)
            elif self.byte:
                ids += [self.byte[b] for b in p.encode("utf-8")]
            elif not (ids and ids[-1] == self.unk):
                ids.append(self.unk)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str, bos: bool = False, eos: bool = True) -> np.ndarray:
        """Ids of a whole text."""
        known, out = self.known, []
        for part in self.cut(self.prefix + text.replace(" ", MARK)) if text else ():
            ids = known.get(part)
            if ids is None:
                ids = self._ids(part)
                if len(part) <= STRETCH_CHARS:
                    if len(known) >= STRETCHES:
                        known.clear()
                    known[part] = ids
            out.append(ids)
        if bos:
            out.insert(0, struct.pack("<I", self.bos))
        if eos:
            out.append(struct.pack("<I", self.eos))
        ids = np.frombuffer(b"".join(out), "<u4")
        if not self.byte and len(ids):                      # unknowns side by side are one
            ids = ids[np.concatenate([[True], (ids[1:] != self.unk) | (ids[:-1] != self.unk)])]
        return ids

    # -- decoding ---------------------------------------------------------
    def _tables(self) -> None:
        def surface(i: int) -> bytes:
            s, kind = self.strings[i], self.kind[i]
            if kind == CONTROL:
                return b""
            if kind == UNKNOWN:
                return " ⁇ ".encode()
            return bytes([int(s[3:5], 16)]) if kind == BYTE else s.replace(MARK, " ").encode()
        self.text_table = offsets([surface(i) for i in range(self.n_ids)])
        self.number_table = offsets([b"%d " % i for i in range(self.n_ids)])
        self.silent = np.array([k == CONTROL for k in self.kind])
        self.marked = np.array([k == NORMAL and s.startswith(MARK) for k, s in zip(self.kind, self.strings)])

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; ids outside the model are an error."""
        raw = gather(self.text_table, ids)
        if self.prefix:
            k = 0
            while k < len(ids) and self.silent[ids[k]]:
                k += 1
            if k < len(ids) and self.marked[ids[k]]:
                raw = raw[1:]
        return raw.decode("utf-8", "docsift-each-byte")

    def numbers(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by one space."""
        return gather(self.number_table, ids)[:-1]


codecs.register_error("docsift-each-byte", lambda e: ("�" * (e.end - e.start), e.end))


def offsets(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings end to end, and where each starts (one entry more)."""
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def gather(table: tuple[np.ndarray, np.ndarray], ids: np.ndarray) -> bytes:
    """The strings of ``ids``, end to end, by one read of the table."""
    if not len(ids):
        return b""
    data, off = table
    at = ids.astype(np.int64)
    size = off[at + 1] - off[at]
    done = np.cumsum(size)
    return data[np.repeat(off[at] - (done - size), size) + np.arange(done[-1])].tobytes()


@functools.lru_cache(2)
def model(path: str) -> Model:
    return Model(path)


def _source(df: DataFrame, column: str, kind: str, keep: tuple[str, ...], made: tuple[str, ...]):
    """(frame of kept columns and the input, kept names, name of the input)"""
    keep, own = tuple(c for c in keep if c not in made), "_input"
    while own in keep:
        own += "_"
    return df.select(*keep, df[column].cast(kind).alias(own)), keep, own


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
           bos: bool = False, eos: bool = True) -> DataFrame:
    """``keep`` columns and ``ids`` (array of int) of every whole text."""
    src, keep, own = _source(docs, text, "string", keep, ("ids",))

    def run(batches):
        m = model(path)
        for b in batches:
            got = [m.encode(t.as_py() or "", bos, eos) for t in b.column(own)]
            off = np.concatenate([[0], np.cumsum([len(g) for g in got])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(off, pa.array(np.concatenate([np.zeros(0, "<u4"), *got]).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), ids], [*keep, "ids"])
    return src.mapInArrow(run, with_fields(src.select(*keep), "ids array<int>"))


def decode(rows: DataFrame, path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``text`` of every list of ids (null: the empty text)."""
    src, keep, own = _source(rows, ids, "array<int>", keep, ("text",))

    def run(batches):
        m = model(path)
        for b in batches:
            got = [m.decode(np.asarray(x.as_py() or [], np.int64)) for x in b.column(own)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(got, pa.string())], [*keep, "text"])
    return src.mapInArrow(run, with_fields(src.select(*keep), "text string"))


def round_trip(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Encode and decode every whole text in one pass and keep digests only:
    ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.  Nothing is shuffled, the
    ids of one document are in memory at a time."""
    made = ("n_tokens", "ids_sha256", "decoded_sha256")
    src, keep, own = _source(docs, text, "string", keep, made)

    def run(batches):
        m = model(path)
        for b in batches:
            n, a, d = [], [], []
            for t in b.column(own):
                ids = m.encode(t.as_py() or "")
                n.append(len(ids))
                a.append(hashlib.sha256(m.numbers(ids)).hexdigest())
                d.append(hashlib.sha256(m.decode(ids).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in keep), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())],
                [*keep, *made])
    return src.mapInArrow(run, with_fields(src.select(*keep), "n_tokens long, ids_sha256 string, decoded_sha256 string"))


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir, "doc_id", "text"), model_path())
