"""Shared helpers of the training-data operators.

* shared-folder tables: every intermediate that is read more than once is
  written under ``spark.checkpoint.dir`` and read back (a lost executor then
  re-reads files instead of recomputing a long lineage);
* numpy views over an Arrow text column: whole batches are tokenised and
  hashed without a Python object per word.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docsift.session import checkpoint_root

WORD_RE = r"[^\x20\x09-\x0D]+"
#: text bytes handled by one numpy pass; a longer document is a pass of its own
CHUNK_BYTES = 4 << 20

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xBF58476D1CE4E5B9)
_M3 = np.uint64(0x94D049BB133111EB)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{checkpoint_root(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the stored table."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return d.select(*cols) if cols else d


def with_fields(df: DataFrame, ddl: str) -> StructType:
    """The schema of ``df`` followed by the fields of a DDL string."""
    return StructType(df.schema.fields + StructType.fromDDL(ddl).fields)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5, is 0 (null ids: the empty string)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(text, y) of at most ``bound`` labelled documents outside the held-out fold.

    The bound is the one documented limit of the trained models: the rows
    with the smallest id hashes among the labelled ones (the same choice on
    every run); an id labelled more than once counts with its largest label;
    null ids and labels are no training rows.  Only the chosen ids are
    broadcast (``bound`` longs), the documents are read once, filtered.
    """
    ids = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
           .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound))
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(ids), "doc_id"))


# ---------------------------------------------------------------- text as numpy

def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (wraps around)."""
    h = (h ^ (h >> np.uint64(30))) * _M2
    h = (h ^ (h >> np.uint64(27))) * _M3
    return h ^ (h >> np.uint64(31))


_WS = np.zeros(256, bool)
_WS[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Texts:
    """One chunk of documents: UTF-8 bytes end to end and where each starts.

    ``off`` has n+1 entries.  ``words()`` gives the start and end of every
    maximal run of bytes that are not ASCII white space and, per document,
    the index of its first word (n+1 entries).
    """

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        self.buf, self.off = buf, off
        self.n = len(off) - 1

    def words(self):
        solid = ~_WS[self.buf]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        last = solid.copy()
        last[:-1] &= ~solid[1:]
        inner = self.off[1:-1]
        inner = inner[(inner > 0) & (inner < len(solid))]
        first[inner] = solid[inner]          # a document boundary separates words
        last[inner - 1] = solid[inner - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        return s, e, np.searchsorted(s, self.off)

    def hashes(self, s: np.ndarray, e: np.ndarray, lower: bool = True) -> np.ndarray:
        """A 64-bit hash of the bytes [s, e) of every span, ASCII case folded."""
        src = _LOWER[self.buf] if lower else self.buf
        pad = np.concatenate([src, np.zeros(8, np.uint8)])
        lanes = np.lib.stride_tricks.as_strided(pad[:8].view("<u8"), (len(src) + 1,), (1,))
        size = (e - s).astype(np.int64)
        h = mix(size.astype(np.uint64) * _M1)
        live, k = np.arange(len(s)), 0
        while len(live):
            left = size[live] - 8 * k
            v = lanes[s[live] + 8 * k].copy()
            cut = left < 8
            v[cut] &= (np.uint64(1) << (left[cut].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
            h[live] = mix((h[live] ^ v) * _M1 + _M3)
            live = live[left > 8]
            k += 1
        return h


def chunks(col: pa.ChunkedArray | pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, Texts]]:
    """(first row, Texts) for consecutive rows of a text column; null is empty."""
    parts = col.chunks if isinstance(col, pa.ChunkedArray) else [col]
    row = 0
    for a in parts:
        a = a.cast(pa.large_binary())
        if a.null_count:
            a = a.fill_null(b"")
        _, offs, data = a.buffers()
        off = np.frombuffer(offs, np.int64)[a.offset:a.offset + len(a) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        i = 0
        while i < len(a):
            j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
            yield row + i, Texts(raw[off[i]:off[j]], off[i:j + 1] - off[i])
            i = j
        row += len(a)


def shingle_hashes(h: np.ndarray, first: np.ndarray, size: int = 5):
    """Hashes of all ``size``-word windows and the window range of each document.

    A document with 1..size-1 words has one window, all its words; one
    without words has none.  Returns (hashes, bounds) with bounds[i] the
    (start, end) of document i's windows, not yet made distinct.
    """
    n = len(first) - 1
    count = np.diff(first)
    long = count >= size
    w = h[: max(0, len(h) - size + 1)].copy()
    for k in range(1, size):
        w = mix(w * _M1 + h[k:k + len(w)])
    short = np.flatnonzero((count > 0) & ~long)
    extra = np.empty(len(short), np.uint64)
    for j, d in enumerate(short):
        x = np.uint64(count[d])
        for v in h[first[d]:first[d + 1]]:
            x = mix(np.array([(int(x) * int(_M1) + int(v) + 1) & 0xFFFFFFFFFFFFFFFF], np.uint64))[0]
        extra[j] = x
    bounds = np.zeros((n, 2), np.int64)
    bounds[long, 0] = first[:-1][long]
    bounds[long, 1] = first[1:][long] - size + 1
    bounds[short, 0] = len(w) + np.arange(len(short))
    bounds[short, 1] = bounds[short, 0] + 1
    return np.concatenate([w, extra]), bounds
