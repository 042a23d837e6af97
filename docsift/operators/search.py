"""Vector search (SCH-1..SCH-6, FLT-3): exact and approximate top-k by a join of cells.

Questions and candidates both carry a cell; a question meets the candidates of
the cells it is routed to.  One search is one shuffle:

* candidates of a cell are dealt over salts, a group holding at least about
  ``GROUP_ROWS`` of them; the questions of a cell go to each of its salts, in
  blocks of at most ``max_block_bytes``, and its candidates to each block.  There
  are as many groups as keep the cores busy and a group's rows in memory, no
  more, and of the salts and blocks that give so many the ones that move the
  fewest bytes.  Sparse vectors travel packed, as bytes;
* a group (cell, salt, question block) arrives sorted, questions first; a
  task holds the questions of one block and streams the candidates past them,
  one matrix product per slice, keeping a running top-k per question.  It
  emits at most ``questions x k`` rows a group -- never one row per pair;
* ``row_number() <= k`` (planned as WindowGroupLimit) merges the groups in
  two steps.  Only ids and scores are merged; what a hit carries joins the
  winners by the number of its stored row.

Only counts per cell reach the driver, never a question.  Exact search
(``knn``) is the same join with one cell for all.  ``knn_ivf`` routes each
question to its nearest k-means cells, so the scan of a stored index reads
just the partitions of cells that some question probes; its exact mode adds a
second join with the cells that a radius bound cannot exclude given the k-th
score of the first.  ``operators.lsh`` routes by hash buckets.

Ranking is by score rounded to 6 places, then the candidate id (one column or
several), then the stored row, so a question has at most k hits whether ids
repeat or not, and results do not depend on summation order.
"""

from __future__ import annotations

import math
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.session import ship_package, stored

METRICS = ("cosine", "dot", "l2")
MAX_BLOCK_BYTES = 32 * 1024 * 1024        # questions that one task holds (float64)
MAX_SCORES = 16 * 1024 * 1024             # scores held at once inside a task
DENSE_QUESTIONS = 8 * 1024 * 1024         # sparse questions densified per task up to this many numbers
GROUP_ROWS = 2048                         # candidates of a group, at least about
GROUPS_PER_TASK = 2                       # groups for each of a shuffle's tasks, at most about
GROUPS_PER_CORE = 4                       # groups for each core, at least about
GROUP_BYTES = 128 * 1024 * 1024           # bytes of a group's candidates, at most about, where the shuffle has tasks for that
ROW_BYTES = 40                            # of a row besides its vector, and of a hit, about
WINNERS = 200_000                         # hits broadcast to the stored rows up to this many (24 bytes and the ids each)
BITMAPS = 4096                            # bitmaps of the stored rows that won, broadcast up to this many (4 KB for 32,768 rows)
ROW = "_row"                              # number of a stored candidate row
NO_ID = -(1 << 63)                        # stands for a null id while ranking


def _matrix(col: pa.Array, dim: int | None = None) -> np.ndarray:
    """list<float> Arrow column -> (n, dim) float64 matrix; checks the length."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    lens = np.diff(col.offsets.to_numpy())
    n = len(col)
    if n == 0:
        return np.zeros((0, dim or 0))
    d = int(lens[0]) if dim is None else dim
    if (lens != d).any():
        bad = int(lens[lens != d][0])
        raise ValueError(f"vector dimension mismatch: expected {d}, got {bad}")
    start = col.offsets[0].as_py()
    flat = col.values.slice(start, n * d).to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(n, d)


def _dots(cm: np.ndarray, qm: np.ndarray, q32: np.ndarray | None, q_abs: float) -> np.ndarray:
    """Dot products; in float32 when it is exact.

    Integer-valued vectors (hash counts) whose every partial sum stays below
    2^24 in magnitude give exactly the same dot products in float32 (about
    twice as fast); otherwise float64.
    """
    if q32 is not None and cm.size and np.abs(cm).max() * q_abs < 2 ** 24 and np.array_equal(cm, np.rint(cm)):
        return (cm.astype(np.float32) @ q32.T).astype(np.float64)
    return cm @ qm.T


def _scores(cm: np.ndarray, qm: np.ndarray, qn: np.ndarray, metric: str,
            dots: np.ndarray | None = None) -> np.ndarray:
    """(n_cand, n_query) scores, higher is better; rounded to 6 places."""
    if dots is None:
        dots = cm @ qm.T
    if metric == "dot":
        s = dots
    elif metric == "cosine":
        cn = np.sqrt((cm * cm).sum(axis=1))
        den = np.outer(cn, qn)
        with np.errstate(invalid="ignore", divide="ignore"):
            s = np.where(den > 0, dots / np.where(den > 0, den, 1.0), 0.0)
    else:  # l2 -> negative euclidean distance
        cn2 = (cm * cm).sum(axis=1)
        d2 = np.maximum(cn2[:, None] + (qn * qn)[None, :] - 2.0 * dots, 0.0)
        s = -np.sqrt(d2)
    return round6(s)


def round6(v: np.ndarray) -> np.ndarray:
    """Round to 6 places, halves away from zero (as SQL ``round`` does)."""
    x = np.asarray(v, dtype=np.float64) * 1e6
    r = np.round(x)
    frac = np.abs(x - np.trunc(x))
    ties = frac == 0.5
    if ties.any():
        r[ties] = np.trunc(x[ties]) + np.sign(x[ties])
    return r / 1e6


def _topk_rows(scores: np.ndarray, cids: np.ndarray, k: int):
    """For each query column: row indices of its top-k by (score desc, id asc).

    Vectorised over all questions: a per-column threshold (the k-th best
    score) keeps every row that can be in the top-k including ties at the
    border; only those few rows are sorted.
    """
    n, q = scores.shape
    kk = min(k, n)
    if kk == 0 or q == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    thr = np.partition(scores, n - kk, axis=0)[n - kk]
    ri, qi = np.nonzero(scores >= thr[None, :])
    sc = scores[ri, qi]
    order = np.lexsort((cids[ri], -sc, qi))
    qi, ri = qi[order], ri[order]
    first = np.searchsorted(qi, qi, side="left")
    keep = (np.arange(len(qi)) - first) < kk
    return qi[keep].astype(np.int64), ri[keep].astype(np.int64)


def _l2_topk(cm: np.ndarray, qm: np.ndarray, out: np.ndarray, ids: np.ndarray, k: int):
    """Top-k by euclidean distance: (question, row, score).

    |a|^2 + |b|^2 - 2ab selects, with a margin for its rounding error, the rows
    that can be among the k nearest; their distances are then taken from the
    differences, so long vectors lose no digits.  ``out`` marks excluded pairs.
    """
    cn2, qn2 = (cm * cm).sum(axis=1), (qm * qm).sum(axis=1)
    d2 = cn2[:, None] + qn2[None, :] - 2.0 * (cm @ qm.T)
    d2[out] = np.inf
    kk = min(k, len(cm))
    if kk == 0 or not len(qm):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    err = 1e-12 * (cn2[:, None] + qn2[None, :]) + 1e-12
    limit = np.partition(d2 + err, kk - 1, axis=0)[kk - 1]
    # a hair more, so that distances equal after rounding to 6 places all come in
    ri, qi = np.nonzero(d2 - err <= (np.sqrt(np.maximum(limit, 0)) + 1e-6)[None, :] ** 2)
    keep = np.isfinite(d2[ri, qi])
    ri, qi = ri[keep], qi[keep]
    sc = np.empty(len(ri))
    for i in range(0, len(ri), 65536):
        sc[i:i + 65536] = -np.linalg.norm(cm[ri[i:i + 65536]] - qm[qi[i:i + 65536]], axis=1)
    sc = round6(sc)
    order = np.lexsort((ids[ri], -sc, qi))
    ri, qi, sc = ri[order], qi[order], sc[order]
    top = (np.arange(len(qi)) - np.searchsorted(qi, qi, side="left")) < kk
    return qi[top].astype(np.int64), ri[top].astype(np.int64), sc[top]


MERGE_BUCKETS = 8    # buckets of tasks in the first step of a merge; the second moves k rows for each


def _rank(partials: DataFrame, k: int, ids: Sequence[str]) -> DataFrame:
    """Merge per-task top-k lists into the global top-k per question, in two
    steps (question x bucket of tasks, then question), so no merge task gets
    the lists of all tasks.  Rows are (query_id, score, ids, row) only."""
    order = [F.col("score").desc(), *[F.col(c).asc() for c in ids]]
    w1 = Window.partitionBy("query_id", "_b").orderBy(*order)
    partials = (partials.withColumn("_b", F.pmod(F.spark_partition_id(), F.lit(MERGE_BUCKETS)))
                        .withColumn("_r", F.row_number().over(w1))
                        .filter(F.col("_r") <= k).drop("_b", "_r"))
    w = Window.partitionBy("query_id").orderBy(*order)
    return (partials.withColumn("rank", F.row_number().over(w))
                    .filter(F.col("rank") <= k))


class QuestionMatrix:
    """The broadcast question side: dense rows, or CSR rows for sparse
    (hashed) questions, which then never become dense anywhere."""

    def __init__(self, ids: np.ndarray, dim: int, dense: np.ndarray | None = None,
                 indptr: np.ndarray | None = None, indices: np.ndarray | None = None,
                 values: np.ndarray | None = None):
        self.ids, self.dim = ids, dim
        self.dense, self.indptr, self.indices, self.values = dense, indptr, indices, values
        if dense is not None:
            self.norms = np.sqrt((dense * dense).sum(axis=1))
        else:
            self.norms = np.zeros(len(ids))
            for q in range(0, len(ids), 16384):           # rows and float64 squares of some questions at a time
                at = indptr[q:q + 16385]
                v = values[at[0]:at[-1]].astype(np.float64)
                rows = np.repeat(np.arange(len(at) - 1), np.diff(at))
                self.norms[q:q + 16384] = np.sqrt(np.bincount(rows, weights=v * v, minlength=len(at) - 1))

    @property
    def n(self) -> int:
        return len(self.ids)

    def to_dense(self) -> np.ndarray:
        if self.dense is not None:
            return self.dense
        out = np.zeros((self.n, self.dim))
        rows = np.repeat(np.arange(self.n), np.diff(self.indptr))
        out[rows, self.indices] = self.values
        return out

    def dense_rows(self, q0: int, q1: int) -> np.ndarray:
        a, b = int(self.indptr[q0]), int(self.indptr[q1])
        out = np.zeros((q1 - q0, self.dim))
        out[np.repeat(np.arange(q1 - q0), np.diff(self.indptr[q0:q1 + 1])), self.indices[a:b]] = self.values[a:b]
        return out

    @property
    def nbytes(self) -> int:
        if self.dense is not None:
            return self.dense.nbytes
        return self.indptr.nbytes + self.indices.nbytes + self.values.nbytes

    def sparse_dots(self, cm: np.ndarray, q0: int, q1: int) -> np.ndarray:
        """Exact (rows x questions q0..q1) dot products of dense rows with CSR questions."""
        a, b = int(self.indptr[q0]), int(self.indptr[q1])
        out = np.zeros((cm.shape[0], q1 - q0))
        if b > a:
            g = cm[:, self.indices[a:b]] * self.values[a:b]
            starts = self.indptr[q0:q1] - a
            nonempty = np.diff(self.indptr[q0:q1 + 1]) > 0
            out[:, nonempty] = np.add.reduceat(g, starts[nonempty], axis=1)
        return out


# ---------------------------------------------------------------- the join

def _is_sparse(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType.elementType, T.StructType)


def _bucket_type(dim: int) -> np.dtype:
    return np.dtype("<u2" if dim <= 1 << 16 else "<u4")


def _narrow(v: np.ndarray) -> np.ndarray:
    """Whole numbers in the fewest bytes that hold them all."""
    lo, hi = (int(v.min()), int(v.max())) if len(v) else (0, 0)
    return v.astype(next(t for t in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(t).min <= lo and hi <= np.iinfo(t).max))


def pack(col: pa.Array, dim: int, bits: bool, whole: bool = True) -> pa.StructArray:
    """Sparse vectors as bytes: ``at``, the buckets as numbers or (``bits``) as
    a bit for each of the ``dim``, and ``weight``, whole numbers of 1, 2, 4 or
    8 bytes or float64.  A row is a tenth or so of the array of structs.  Bits
    name the weights that are not 0, the last one of a bucket named twice."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat, lens = col.flatten(), np.diff(col.offsets.to_numpy()).astype(np.int64)
    at, v = (flat.field(x).to_numpy(zero_copy_only=False) for x in ("bucket", "weight"))
    v = _narrow(v) if whole else v.astype("<f8")
    if len(at) and (at.min() < 0 or at.max() >= dim):
        raise ValueError(f"bucket outside 0..{dim - 1}")
    if not bits:
        at = at.astype(_bucket_type(dim))
        sizes = lens * at.itemsize
    else:
        ends, rows, marks, kept = np.concatenate([[0], np.cumsum(lens)]), max(64, (1 << 22) // dim), [], []
        for r in range(0, len(lens), rows):               # a dense copy of some rows at a time
            part = lens[r:r + rows]
            e = slice(ends[r], ends[r + len(part)])
            dense = np.zeros((len(part), dim), v.dtype)
            dense[np.repeat(np.arange(len(part)), part), at[e]] = v[e]
            there = dense != 0
            marks.append(np.packbits(there, axis=1).ravel())
            kept.append(dense[there])
            lens[r:r + rows] = there.sum(axis=1)
        at = np.concatenate(marks) if marks else np.zeros(0, np.uint8)
        v = np.concatenate(kept) if kept else v
        sizes = np.full(len(lens), -(-dim // 8))

    def binary(data, sizes):
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())])
    return pa.StructArray.from_arrays([binary(at, sizes), binary(v, lens * v.itemsize)], ["at", "weight"])


def _bytes_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column, and of each of its rows how many."""
    col = col.cast(pa.binary())
    ends = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8), np.diff(ends)


def unpack(col: pa.StructArray, dim: int, bits: bool, whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of packed vectors: how many weights each has, their buckets, the weights."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    (at, sizes), (raw, lens) = map(_bytes_of, col.flatten())
    if bits:
        there = np.unpackbits(at.reshape(len(sizes), -(-dim // 8)), axis=1, count=dim).view(bool)
        n, at = there.sum(axis=1), np.nonzero(there)[1].astype(_bucket_type(dim))
    else:
        at = at.view(_bucket_type(dim))
        n = sizes // at.itemsize
    kind = "<i" if whole else "<f"
    width = lens // np.maximum(n, 1)
    found = np.unique(width[n > 0])
    if len(found) <= 1:
        return n, at, raw.view(f"{kind}{found[0]}" if len(found) else "<i1")
    v = np.zeros(len(at), f"{kind}{found[-1]}")           # batches packed in different widths met
    for w in found:
        mine = width == w
        v[np.repeat(mine, n)] = raw[np.repeat(mine, lens)].view(f"{kind}{w}")
    return n, at, v


def _dense(col: pa.Array, dim: int | None, bits: bool = False, whole: bool = True) -> np.ndarray:
    """Vectors of a batch as float64 rows; sparse ones are scattered."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_struct(col.type):
        n, at, v = unpack(col, dim, bits, whole)
        out = np.zeros((len(col), dim))
        out[np.repeat(np.arange(len(col)), n), at] = v
        return out
    if not pa.types.is_struct(col.type.value_type):
        return _matrix(col, dim)
    flat, out = col.flatten(), np.zeros((len(col), dim))
    rows = np.repeat(np.arange(len(col)), np.diff(col.offsets.to_numpy()))
    out[rows, flat.field("bucket").to_numpy()] = flat.field("weight").to_numpy()
    return out


def _question_matrix(parts: list[pa.RecordBatch], dim: int | None, whole: bool = True) -> QuestionMatrix:
    t = pa.Table.from_batches(parts)
    if pa.types.is_struct(t.schema.field("_v").type):
        n, at, v = map(np.concatenate, zip(*(unpack(b.column("_v"), dim, False, whole) for b in parts)))
        return QuestionMatrix(t.column("_id").to_numpy(), dim, indptr=np.concatenate([[0], np.cumsum(n, dtype=np.int64)]), indices=at, values=v)
    ids, col = t.column("_id").to_numpy(), t.column("_v").combine_chunks()
    if not pa.types.is_struct(col.type.value_type):
        m = _matrix(col)
        return QuestionMatrix(ids, m.shape[1], dense=m)
    flat = col.flatten()
    off = col.offsets.to_numpy().astype(np.int64)
    return QuestionMatrix(ids, dim, indptr=off - off[0], indices=flat.field("bucket").to_numpy().astype(np.int64),
                          values=flat.field("weight").to_numpy().astype(np.float64))


class _Cut:
    """Some questions of a block: their best hits so far and what a row must reach to join them."""

    def __init__(self, q0: int, q1: int):
        self.q0, self.q1 = q0, q1
        self.kth = np.full(q1 - q0, -np.inf)      # k-th best score so far
        self.pool, self.new = [], 0


class _Group:
    """Questions of one block and their running top-k.

    Products in float32 of scaled vectors, with a bound on their error, tell
    which rows of a tile can still be among a question's best k; only those
    are scored in float64.  A question for which many rows of a tile pass (ties
    above all) has the whole tile scored in float64.
    """

    def __init__(self, Q: QuestionMatrix, k: int, metric: str, exclude_self: bool, limits: tuple[int, int], packed: tuple[bool, bool] = (False, True)):
        self.Q, self.k, self.metric, self.exclude_self, self.packed = Q, k, metric, exclude_self, packed
        self.max_scores, dense_limit = limits
        self.held = Q.n * Q.dim <= dense_limit
        self.q_step = max(1, min(Q.n, 1024, max(1, self.max_scores // max(Q.dim, 1))))
        self.r_step = max(1, min(4096, self.max_scores // self.q_step, self.max_scores // max(Q.dim, 1)))
        self.tile = min(self.r_step, 1024)
        self.cuts = [_Cut(q, min(Q.n, q + self.q_step)) for q in range(0, Q.n, self.q_step)]
        self.scale = np.where(Q.norms > 0, Q.norms, 1.0)
        if metric == "l2":
            self.scale = np.full(Q.n, self.scale.max() if Q.n else 1.0)
        self.made: dict[int, tuple] = {}
        # |float32 product - product| of vectors not longer than 1, whatever the order of its sums
        self.err = (Q.dim + 8) * 2.0 ** -24 * 1.1

    def _asked(self, cut: _Cut) -> tuple:
        """A cut's questions: float64, scaled float32, and what ``_dots`` needs for whole numbers."""
        if cut.q0 in self.made:
            return self.made[cut.q0]
        qm = self.Q.dense[cut.q0:cut.q1] if self.Q.dense is not None else self.Q.dense_rows(cut.q0, cut.q1)
        whole = qm.size and np.array_equal(qm, np.rint(qm))
        got = (qm, (qm / self.scale[cut.q0:cut.q1, None]).astype(np.float32),
               qm.astype(np.float32) if whole else None, float(np.abs(qm).sum(axis=1).max()) if whole else 0.0)
        if self.held:
            self.made[cut.q0] = got
        return got

    def add(self, b: pa.RecordBatch, keys: Sequence[str]) -> None:
        for r0 in range(0, b.num_rows, self.r_step):
            part = b.slice(r0, self.r_step)
            ids = [part.column(c).to_numpy() for c in keys]
            order = np.lexsort(ids[::-1])                 # equal scores: row order is id order
            ids = [x[order] for x in ids]
            cm = _dense(part.column("_v"), self.Q.dim, *self.packed)[order]
            finite = np.isfinite(cm).all(axis=1)          # a vector with NaN or inf is never a hit
            if not finite.all():
                cm = np.where(finite[:, None], cm, 0.0)
            cn = np.sqrt((cm * cm).sum(axis=1))
            far = float(cn.max()) or 1.0
            unit = np.where(cn > 0, cn, 1.0)[:, None] if self.metric == "cosine" else far
            c32 = (cm / unit).astype(np.float32)
            for cut in self.cuts:
                asked = self._asked(cut)
                for t in range(0, len(cm), self.tile):
                    at = slice(t, t + self.tile)
                    self._score(cut, asked, cm[at], cn[at], far, c32[at], [x[at] for x in ids], finite[at])

    def _passing(self, cut: _Cut, b32, cn, far, c32, out) -> np.ndarray:
        """(questions, rows): can the row be among the question's best k?  ``out`` lists excluded pairs."""
        k, n, scale = self.k, len(cn), self.scale[cut.q0:cut.q1]
        if not (np.isfinite(far) and np.isfinite(scale).all()):
            passing = np.ones((cut.q1 - cut.q0, n), bool)
            passing[out] = False
            return passing
        s = b32 @ c32.T
        err = self.err
        # what a k-th score asks of the product; ``slack``: scores that round to the same 6 places
        if self.metric == "cosine":
            need, slack = cut.kth, 1e-6
        elif self.metric == "dot":
            need, slack = cut.kth / (scale * far), 1e-6 / (scale * far)
        else:
            near = cn * cn / (2.0 * far * scale[0])
            s -= near.astype(np.float32)[None, :]
            qn = self.Q.norms[cut.q0:cut.q1]
            need = (qn * qn - cut.kth * cut.kth) / (2.0 * far * scale[0])
            err = err + 2.0 ** -22 * (1.0 + near.max() + (qn * qn + (far + qn) ** 2) / (2.0 * far * scale[0]))
            slack = (1e-6 * (far + qn) + 1e-12) / (far * scale[0])
        s[out] = -np.inf
        need = np.where(np.isfinite(cut.kth), need - err - slack, -np.inf)
        fresh = np.flatnonzero(~np.isfinite(cut.kth)) if n > k else ()
        if len(fresh):                                    # no k hits yet: the k-th best of this tile
            best = np.partition(s[fresh], n - k, axis=1)[:, n - k]
            need[fresh] = best - (np.broadcast_to(2.0 * err + slack, need.shape)[fresh])
        low = np.nextafter(need.astype(np.float32), np.float32(-np.inf))
        return (s >= low[:, None]) & np.isfinite(s) if len(out[0]) else s >= low[:, None]

    def _score(self, cut: _Cut, asked, cm, cn, far, c32, ids, finite) -> None:
        Q, k, (qm, b32, q32, q_abs) = self.Q, self.k, asked
        nq, n, q_ids = cut.q1 - cut.q0, len(cm), Q.ids[cut.q0:cut.q1]
        out_q, out_r = [], []
        if not finite.all():
            bad = np.flatnonzero(~finite)
            out_q.append(np.repeat(np.arange(nq), len(bad)))
            out_r.append(np.tile(bad, nq))
        if self.exclude_self:                             # rows are in the order of their ids
            lo, hi = np.searchsorted(ids[0], q_ids, "left"), np.searchsorted(ids[0], q_ids, "right")
            m = hi - lo
            out_q.append(np.repeat(np.arange(nq), m))
            out_r.append(np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(lo, m))
        out = (np.concatenate(out_q), np.concatenate(out_r)) if out_q else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        passing = self._passing(cut, b32, cn, far, c32, out)
        at = np.flatnonzero(passing)
        if not len(at):
            return
        qi, ri = at // n, at % n
        many = np.flatnonzero(np.bincount(qi, minlength=nq) > max(64, 8 * k))
        if len(many):
            light = ~np.isin(qi, many)
            qi, ri = qi[light], ri[light]
            excluded = np.zeros((n, len(many)), bool)
            place = np.full(nq, -1)
            place[many] = np.arange(len(many))
            mine = place[out[0]] >= 0
            excluded[out[1][mine], place[out[0][mine]]] = True
            self._take(cut, *self._whole(cm, cn, qm[many], Q.norms[cut.q0:cut.q1][many], None if q32 is None else q32[many], q_abs, excluded, many), ids)
        if len(qi):
            self._take(cut, qi, ri, self._exact(cm, cn, qm, Q.norms[cut.q0:cut.q1], qi, ri), ids)
        if cut.new > k * nq // 2 or not np.isfinite(cut.kth).all():
            self._trim(cut)

    def _whole(self, cm, cn, qm, qn, q32, q_abs, excluded, names):
        """Top-k of a whole tile in float64: (question, row, score)."""
        place = np.arange(len(cm))
        if self.metric == "l2":
            qi, ri, sc = _l2_topk(cm, qm, excluded, place, self.k)
            return names[qi], ri, sc
        # as ``_exact`` sums them, so that copies of a vector tie wherever they are scored; whole numbers are exact anyway
        whole = q32 is not None and np.array_equal(cm, np.rint(cm))
        s = _scores(cm, None, qn, self.metric, _dots(cm, qm, q32, q_abs) if whole else np.einsum("ij,kj->ik", cm, qm))
        s[excluded] = -np.inf
        qi, ri = _topk_rows(s, place, self.k)
        keep = np.isfinite(s[ri, qi])
        qi, ri = qi[keep], ri[keep]
        return names[qi], ri, s[ri, qi]

    def _exact(self, cm, cn, qm, qn, qi, ri) -> np.ndarray:
        """Scores of single pairs in float64."""
        sc, step = np.empty(len(qi)), max(1, (1 << 20) // max(self.Q.dim, 1))
        for i in range(0, len(qi), step):
            q, r = qi[i:i + step], ri[i:i + step]
            if self.metric == "l2":
                sc[i:i + step] = -np.linalg.norm(cm[r] - qm[q], axis=1)
                continue
            d = np.einsum("ij,ij->i", cm[r], qm[q])
            if self.metric == "cosine":
                den = cn[r] * qn[q]
                d = np.where(den > 0, d / np.where(den > 0, den, 1.0), 0.0)
            sc[i:i + step] = d
        return round6(sc)

    def _take(self, cut: _Cut, qi, ri, sc, ids) -> None:
        keep = sc >= cut.kth[qi]
        keep &= np.isfinite(sc)
        qi, ri, sc = qi[keep], ri[keep], sc[keep]
        if len(qi):
            cut.pool.append([qi, sc, *[x[ri] for x in ids]])
            cut.new += len(qi)

    def _trim(self, cut: _Cut) -> None:
        """The best k of every question stay; its k-th score is what further rows must reach."""
        if not cut.new:
            return
        cols = [np.concatenate(x) for x in zip(*cut.pool)]
        order = np.lexsort((*cols[:1:-1], -cols[1], cols[0]))
        cols = [x[order] for x in cols]
        place = np.arange(len(order)) - np.searchsorted(cols[0], cols[0], side="left")
        last = place == self.k - 1
        cut.kth[cols[0][last]] = cols[1][last]
        top = place < self.k
        cut.pool, cut.new = [[x[top] for x in cols]], 0

    def best(self) -> list[np.ndarray]:
        """(question, score, ids ...) of the top-k so far."""
        for cut in self.cuts:
            self._trim(cut)
        parts = [(cut.pool[0][0] + cut.q0, *cut.pool[0][1:]) for cut in self.cuts if cut.pool]
        return [np.concatenate(x) for x in zip(*parts)] if parts else []


def _stream_fn(k: int, metric: str, keys: Sequence[str], dim: int | None, exclude_self: bool, packed: tuple[bool, bool]):
    """Task function over sorted groups: a block of questions, then candidates.
    ``packed``: are candidates' buckets bits, and weights whole numbers?"""
    limits = (MAX_SCORES, DENSE_QUESTIONS)   # captured at plan time
    names = ["query_id", "score", *keys]

    def done(group) -> Iterator[pa.RecordBatch]:
        cols = group.best() if group else []
        if cols:
            yield pa.RecordBatch.from_arrays([pa.array(group.Q.ids[cols[0]]), *map(pa.array, cols[1:])], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, asked, group = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            g = np.stack([b.column(c).to_numpy().astype(np.int64) for c in ("_cell", "_salt", "_qb", "_kind")], 1)
            edges = [0, *(np.flatnonzero((g[1:] != g[:-1]).any(axis=1)) + 1), b.num_rows]
            for s, e in zip(edges, edges[1:]):
                key, kind = tuple(g[s, :3]), g[s, 3]
                if key != at:
                    yield from done(group)
                    at, asked, group = key, [], None
                if kind == 0:
                    asked.append(b.slice(s, e - s))
                elif asked or group:
                    if group is None:
                        group = _Group(_question_matrix(asked, dim, packed[1]), k, metric, exclude_self, limits, packed)
                        asked = []
                    group.add(b.slice(s, e - s), keys)
        yield from done(group)

    return run


def _cell_counts(questions: DataFrame) -> dict[int, tuple[int, int]]:
    """cell -> (questions, numbers in their vectors); fails on a question that cannot be compared."""
    sparse = _is_sparse(questions, "_v")
    bad = F.lit(False) if sparse else F.exists("_v", lambda x: F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")) | x.isNull())
    rows = questions.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("_v")).alias("t"), F.min(F.size("_v")).alias("lo"),
                                          F.max(F.size("_v")).alias("hi"), F.max(F.when(bad, F.col("query_id"))).alias("bad")).collect()
    for r in rows:                                            # one row a cell
        if r.bad is not None:
            raise ValueError(f"question {r.bad} has a vector with NaN or infinity")
        if not sparse and r.lo != r.hi:
            raise ValueError(f"vector dimension mismatch: questions of {r.lo} and {r.hi}")
    return {r["_cell"]: (r.n, r.t) for r in rows}


def _packed(df: DataFrame, dim: int, bits: bool, whole: bool) -> DataFrame:
    """``df`` with its sparse vectors packed."""
    @F.arrow_udf("struct<at:binary,weight:binary>")
    def packed(col: pa.Array) -> pa.Array:
        return pack(col, dim, bits, whole)
    return df.withColumn("_v", packed("_v"))


def _deal(asked: dict[int, tuple[int, int]], sizes: dict[int, int], block_bytes, q_row: float, c_row: float, most: int, cores: int) -> list[tuple[int, int, int]]:
    """(cell, salts, blocks) of every cell where questions meet candidates.

    Every salt gets all questions of its cell and gives k hits for each
    (``q_row`` bytes in all, a question), every block all candidates (``c_row``
    each).  A cell has as many groups as its share of the pairs is worth, and of
    salts x blocks = groups those that move least: q_row x questions x salts =
    c_row x candidates x blocks.  More salts only where a group's candidates
    are too many to sort in memory.
    """
    met = {c: n for c, (n, _) in sorted(asked.items()) if sizes.get(c)}
    pairs = sum(n * sizes[c] for c, n in met.items())
    want = min(GROUPS_PER_TASK * most, GROUPS_PER_CORE * cores)
    facts = []
    for c, n in met.items():
        groups = -(-want * n * sizes[c] // pairs)
        least = block_bytes(*asked[c])
        blocks = max(least, min(round(math.sqrt(groups * n * q_row / (sizes[c] * c_row))), groups, -(-n // GROUP_ROWS)))
        salts = max(-(-groups // blocks), math.ceil(sizes[c] * c_row / GROUP_BYTES))
        facts.append((c, max(1, min(-(-sizes[c] // GROUP_ROWS), most, salts)), blocks))
    return facts


def _groups(questions: DataFrame, candidates: DataFrame, keys: Sequence[str], k: int, metric: str, exclude_self: bool,
            dim: int | None, sizes: dict[int, int], max_block_bytes: int, entries: float = 0) -> tuple[DataFrame | None, int]:
    """(query_id, score, ids ...): the top-k of every group, None if nothing
    meets; and the number of questions routed.

    ``questions``: query_id, _cell, _v.  ``candidates``: ids, _cell, _v.
    ``sizes``: candidates of every cell; ``entries``: numbers in a candidate's
    vector, on average, if known.
    """
    spark = candidates.sparkSession
    ship_package(spark)
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = _cell_counts(questions)
    routed = sum(n for n, _ in asked.values())
    sparse, packed = _is_sparse(questions, "_v"), (False, True)
    mean = sum(t for _, t in asked.values()) / max(1, routed)
    if sparse:
        whole = all(isinstance(x.schema["_v"].dataType.elementType["weight"].dataType, T.IntegralType) for x in (questions, candidates))
        packed = bits, whole = dim <= 16 * entries, whole
        one = _bucket_type(dim).itemsize + (1 if whole else 8)
        q_vec, c_vec = one * mean, dim / 8 + entries * (1 if whole else 8) if bits else one * (entries or mean)
    else:
        one = 8
        q_vec = c_vec = 8 * mean
    facts = _deal(asked, sizes, lambda n, t: -(-(t * one + 16 * n) // max_block_bytes), q_vec + ROW_BYTES * (1 + k), c_vec + ROW_BYTES,
                  most, spark.sparkContext.defaultParallelism)
    if not facts:
        return None, routed
    firsts = [0]                                              # groups are numbered, so every task gets as many
    for _, salts, blocks in facts:
        firsts.append(firsts[-1] + salts * blocks)
    if len(facts) == 1:
        cell, salts, blocks = facts[0]

        def told(df):
            return df.where(F.col("_cell") == cell).withColumns({"_salts": F.lit(salts), "_blocks": F.lit(blocks), "_first": F.lit(0)})
    else:
        small = spark.createDataFrame([(*f, g) for f, g in zip(facts, firsts)], "_cell int, _salts int, _blocks int, _first int")    # a row a cell

        def told(df):
            return df.where(F.col("_cell").isin([f[0] for f in facts])).join(F.broadcast(small), "_cell")
    long_null = F.lit(None).cast("long")
    upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    parts = min(most, max(2, firsts[-1]))
    task = F.pmod(F.col("_first") + F.col("_salt") * F.col("_blocks") + F.col("_qb"), F.lit(parts)).cast("int").alias("_task")
    q, c = told(questions), told(candidates)
    if sparse:
        q, c = _packed(q, dim, False, whole), _packed(c, dim, bits, whole)
    fields_of = ["_cell", "_salt", "_qb", "_kind", "_id", *keys, "_v"]
    q = q.select("_cell", "_first", "_blocks", F.explode(upto("_salts")).alias("_salt"),
                 F.pmod(F.xxhash64("query_id", "_v"), F.col("_blocks")).cast("int").alias("_qb"),
                 F.lit(0).alias("_kind"), F.col("query_id").alias("_id"), *[long_null.alias(x) for x in keys], "_v").select(task, *fields_of)
    c = c.select("_cell", "_first", "_blocks", F.pmod(F.xxhash64(*keys, "_v"), F.col("_salts")).cast("int").alias("_salt"),
                 F.explode(upto("_blocks")).alias("_qb"), F.lit(1).alias("_kind"), long_null.alias("_id"), *keys, "_v").select(task, *fields_of)
    both = q.unionByName(c).repartitionById(parts, "_task").drop("_task").sortWithinPartitions("_cell", "_salt", "_qb", "_kind")
    fields = ", ".join(["query_id long", "score double", *[f"`{x}` long" for x in keys]])
    return both.mapInArrow(_stream_fn(k, metric, keys, dim, exclude_self, packed), fields), routed


def _questions(queries: DataFrame, query_id: str, query_vec: str) -> DataFrame:
    """(query_id, _v), stored: read by the counts and by the join."""
    return stored(queries.select(F.col(query_id).cast("long").alias("query_id"), F.col(query_vec).alias("_v")).where(F.col("_v").isNotNull()), "questions")


class _Candidates:
    """The candidate side: ids as longs, the row number, the vector."""

    def __init__(self, df: DataFrame, cand_id: str | Sequence[str], vec: str, carry: Sequence[str], cell: str | None = None):
        self.names = [cand_id] if isinstance(cand_id, str) else list(cand_id)
        self.extra = [c for c in carry if c not in self.names]
        if self.extra and ROW not in df.columns:
            # a plan evaluated twice need not give its rows the same numbers: store it
            df = number_rows(df.select(*dict.fromkeys([*self.names, vec, *self.extra, *([cell] if cell else [])])), [cell] if cell else None)
        self.df, self.vec, self.cell = df, vec, cell
        self.keys = [*[f"_k{i}" for i in range(len(self.names))], ROW]

    def side(self, rows: DataFrame, cell: Column) -> DataFrame:
        row = F.col(ROW) if ROW in rows.columns else F.lit(0).cast("long")
        return rows.where(F.col(self.vec).isNotNull()).select(
            *[F.coalesce(F.col(n).cast("long"), F.lit(NO_ID)).alias(k) for n, k in zip(self.names, self.keys)],
            row.alias(ROW), cell.alias("_cell"), F.col(self.vec).alias("_v"))

    def hits(self, ranked: DataFrame | None, rows: DataFrame, n: int, carry: Sequence[str]) -> DataFrame:
        """query_id, rank, score, ids, carried columns of the winners."""
        spark = rows.sparkSession
        if ranked is None:
            schema = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("rank", T.IntegerType()), T.StructField("score", T.DoubleType()),
                                   *[T.StructField(c, T.LongType()) for c in self.names], *[rows.schema[c] for c in self.extra]])
            return spark.createDataFrame([], schema).select("query_id", "rank", "score", *dict.fromkeys([*self.names, *carry]))
        won = ranked.select("query_id", "rank", "score", ROW, *[F.when(F.col(k) != NO_ID, F.col(k)).alias(c) for k, c in zip(self.keys, self.names)])
        if not self.extra:
            return won.select("query_id", "rank", "score", *dict.fromkeys([*self.names, *carry]))
        late = rows.select(ROW, *self.extra)
        if n <= WINNERS:
            won = F.broadcast(won)
        else:
            won = stored(won, "won")                          # read twice
            late = _only(late, won)
        return late.join(won, ROW).select("query_id", "rank", "score", *dict.fromkeys([*self.names, *carry]))


def _only(late: DataFrame, won: DataFrame) -> DataFrame:
    """The stored rows that won, found by a broadcast bit for every stored row,
    so that the text of the others is not moved; all of them where the bits are
    too many."""
    marks = won.groupBy(F.bitmap_bucket_number(ROW).alias("_map")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(ROW)).alias("_bits"))
    marks = stored(marks, "marks")
    if marks.count() > BITMAPS:
        return late
    at = F.bitmap_bit_position(ROW)
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return late.withColumn("_map", F.bitmap_bucket_number(ROW)).join(F.broadcast(marks), "_map") \
               .where(F.getbit(byte, (at % 8).cast("int")) == 1).select(*late.columns)


def number_rows(df: DataFrame, partition_by: Sequence[str] | None = None) -> DataFrame:
    """``df`` stored with a number of its own for every row (column ``_row``)."""
    return stored(df.withColumn(ROW, F.monotonically_increasing_id()), "candidates", partition_by, "zstd")


def knn(queries: DataFrame, candidates: DataFrame, k: int = 4, metric: str = "cosine",
        query_id: str = "query_id", query_vec: str = "embedding",
        cand_id: str | Sequence[str] = "chunk_id", cand_vec: str = "embedding",
        carry: Sequence[str] = (), where: Column | str | None = None,
        exclude_self: bool = False, max_block_bytes: int = MAX_BLOCK_BYTES, dim: int | None = None) -> DataFrame:
    """SCH-1 exact k nearest candidates for every question.

    Returns ``query_id, rank, score, <cand_id...>, <carry...>`` with
    ``rank`` 1..min(k, candidates).  ``where`` (FLT-3) filters candidates
    before scoring, so k rows still come back when enough remain.  Vectors
    are arrays of numbers, or sparse arrays of (bucket, weight) below
    ``dim``.  Question ids are unique; candidate ids may repeat (and be
    null): every candidate row is a candidate of its own.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    if where is not None:
        candidates = candidates.filter(F.expr(where) if isinstance(where, str) else where)
    c = _Candidates(candidates, cand_id, cand_vec, carry)
    q = _questions(queries, query_id, query_vec).withColumn("_cell", F.lit(0))
    side = c.side(c.df, F.lit(0))
    facts = side.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.avg(F.size("_v")), F.lit(0.0)).alias("entries")).first()
    found, n = _groups(q, side, c.keys, k, metric, exclude_self, dim, {0: facts.n}, max_block_bytes, facts.entries)
    return c.hits(None if found is None else _rank(found, k, c.keys), c.df, n * k, carry)


# ---------------------------------------------------------------- text search

def text_index(chunks: DataFrame, dim: int = 256, chunk_text: str = "content") -> DataFrame:
    """The chunk table stored with its hash embeddings (sparse) and row
    numbers: chunked and hashed once for any number of searches."""
    from docsift.operators.embedding import sparse_vector
    return number_rows(chunks.withColumn("embedding", sparse_vector(F.col(chunk_text), dim)))


def search_text(questions: DataFrame, chunks: DataFrame, k: int = 4, dim: int = 256,
                question_id: str = "query_id", question_text: str = "question",
                chunk_id: str | Sequence[str] = "chunk_id", chunk_text: str = "content",
                carry: Sequence[str] = ("path", "content"), metric: str = "cosine",
                where: Column | None = None, embedded: bool = False,
                centroids: np.ndarray | None = None, nprobe: int = 2, exact: bool = False) -> DataFrame:
    """SCH-2: embed the question texts (and the chunks unless ``embedded``)
    with the hash model, then exact k-NN; with ``centroids`` the chunks are a
    stored index partitioned by cell and are searched by cell (``knn_ivf``)."""
    from docsift.operators.embedding import hash_vector, sparse_vector
    if not embedded:
        if where is not None:
            chunks, where = chunks.filter(where), None
        chunks = text_index(chunks, dim, chunk_text)
    embed = sparse_vector if _is_sparse(chunks, "embedding") else hash_vector
    q = questions.select(F.col(question_id).alias("query_id"), embed(F.col(question_text), dim).alias("embedding"))
    if centroids is not None:
        index = chunks if where is None else chunks.filter(where)
        return knn_ivf(q, index, centroids, k=k, nprobe=nprobe, metric=metric, cand_id=chunk_id, carry=list(carry), exact=exact)
    return knn(q, chunks, k=k, metric=metric, query_id="query_id", query_vec="embedding",
               cand_id=chunk_id, cand_vec="embedding", carry=list(carry), where=where, dim=dim)


def collect_docs(hits: DataFrame, fields: Sequence[str] = ("content", "path")) -> DataFrame:
    """SCH-3: hits -> one row per question with ``docs`` in rank order and ``n_docs`` (SCH-4).

    A group holds at most k rows, so ``collect_list`` is bounded.
    """
    st = F.struct(F.col("rank"), *[F.col(f) for f in fields])
    return (hits.groupBy("query_id")
                .agg(F.array_sort(F.collect_list(st)).alias("docs"))
                .withColumn("n_docs", F.size("docs")))


def retrieve(questions: DataFrame, chunks: DataFrame, k: int = 4, **kw) -> DataFrame:
    """SCH-3 retriever: top-k chunks per question as a ``docs`` array."""
    return collect_docs(search_text(questions, chunks, k=k, **kw))


def recall_at_k(approx: DataFrame, exact: DataFrame, cand_id: str = "chunk_id") -> DataFrame:
    """Share of exact top-k ids that the approximate search also returned."""
    a = approx.select("query_id", cand_id).withColumn("hit", F.lit(1))
    j = exact.select("query_id", cand_id).join(a, ["query_id", cand_id], "left")
    return j.agg(F.round(F.avg(F.coalesce(F.col("hit"), F.lit(0))), 6).alias("recall"))


# ---------------------------------------------------------------- approximate (IVF)

def normalize(vec: Column) -> Column:
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double") * x.cast("double")))
    # bound to a lambda's variable, the norm is summed once per vector and not again for each of its components
    unit = F.transform(F.array(norm), lambda n: F.when(n > 0, F.transform(vec, lambda x: (x / n).cast("float"))).otherwise(vec))
    return F.element_at(unit, 1)


def train_centroids(candidates: DataFrame, n_lists: int, vec: str = "embedding", seed: int = 7,
                    max_iter: int = 20):
    """k-means centroids of the unit-normalised vectors (Spark ML, distributed).

    Returns a float64 matrix (n_lists x dim): a small, bounded model.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    data = candidates.select(array_to_vector(normalize(F.col(vec))).alias("features"))
    model = KMeans(k=n_lists, seed=seed, maxIter=max_iter, initMode="k-means||").fit(data)
    return np.array([np.asarray(c, dtype=np.float64) for c in model.clusterCenters()], dtype=np.float64)


def sample_centroids(candidates: DataFrame, n_lists: int, key: str, vec: str = "embedding", embed=None) -> np.ndarray:
    """Centroids without a fit: the unit vectors of the ``n_lists`` rows with
    the smallest key hashes (the same on every run); ``embed`` makes the
    vectors of these rows only.  Search by cell stays exact with any
    centroids; only the pruning depends on them."""
    rows = candidates.orderBy(F.xxhash64(key), key).limit(n_lists)
    got = [r[0] for r in (embed(rows) if embed else rows).select(vec).collect() if r[0] is not None]
    m = np.array(got, dtype=np.float64)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12) if len(m) else np.zeros((0, 0))


def assign_cells(df: DataFrame, centroids: np.ndarray, vec: str = "embedding",
                 out_col: str = "centroid", dist_col: str = "cell_dist") -> DataFrame:
    """Nearest centroid of every row (cosine), one Arrow pass, centroids broadcast.

    Also stores the distance between the unit-normalised vector and its
    centroid, from which a cell's radius is a small aggregation.  A row
    without a vector lies in cell 0, its distance is null.
    """
    ship_package(df.sparkSession)
    bc = df.sparkSession.sparkContext.broadcast(centroids)
    step = max(64, (1 << 20) // max(1, centroids.shape[1] if centroids.ndim == 2 else 1))
    out_schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.IntegerType()),
                                                  T.StructField(dist_col, T.DoubleType())])

    def run(it):
        cen = bc.value
        cn = cen / np.maximum(np.linalg.norm(cen, axis=1, keepdims=True), 1e-12)
        for whole in it:
            for r in range(0, whole.num_rows, step):          # float64 copies of one slice at a time
                b = whole.slice(r, step)
                has = b.column(vec).is_valid().to_numpy(zero_copy_only=False)
                u = np.zeros((b.num_rows, cen.shape[1]))
                u[has] = _matrix(b.column(vec).drop_null(), cen.shape[1])
                u /= np.maximum(np.linalg.norm(u, axis=1, keepdims=True), 1e-300)
                cell = np.where(has, np.argmax(u @ cn.T, axis=1), 0)
                dist = np.linalg.norm(u - cen[cell], axis=1)
                yield b.append_column(out_col, pa.array(cell.astype(np.int32), type=pa.int32())) \
                       .append_column(dist_col, pa.array(dist, type=pa.float64(), mask=~has))

    return df.mapInArrow(run, out_schema)


def cell_facts(index: DataFrame, cell_col: str = "centroid", dist_col: str | None = "cell_dist") -> dict[int, tuple[int, float]]:
    """cell -> (rows, largest member distance); one row per cell reaches the driver."""
    far = F.coalesce(F.max(dist_col), F.lit(0.0)) if dist_col else F.max(F.lit(0.0))
    return {r[cell_col]: (r.n, float(r.far)) for r in
            index.groupBy(cell_col).agg(F.count(F.lit(1)).alias("n"), far.alias("far")).collect() if r[cell_col] is not None}


def build_ivf(candidates: DataFrame, path: str, n_lists: int = 16, vec: str = "embedding",
              seed: int = 7, mode: str = "overwrite"):
    """SCH-6 (b): write the corpus partitioned by nearest centroid, with row
    numbers; returns centroids."""
    cen = train_centroids(candidates, n_lists, vec, seed)
    assign_cells(candidates, cen, vec).withColumn(ROW, F.monotonically_increasing_id()) \
        .write.mode(mode).partitionBy("centroid").parquet(path)
    return cen


def _routes(questions: DataFrame, centroids: np.ndarray, cells: Sequence[int], far: Sequence[float]) -> DataFrame:
    """Adds ``_near``: the cells that hold rows, nearest first, each with the
    highest cosine that a member can have (unit vectors, triangle inequality:
    |q - x| >= |q - centroid| - radius)."""
    spec = (centroids[list(cells)], np.asarray(cells, np.int32), np.asarray(far))
    out = T.StructType(questions.schema.fields + T.StructType.fromDDL("_near array<struct<cell:int,upper:double>>").fields)
    ship_package(questions.sparkSession)

    def run(batches):
        cen, ids, radius = spec
        cn = cen / np.maximum(np.linalg.norm(cen, axis=1, keepdims=True), 1e-12)
        for b in batches:
            if not b.num_rows:
                continue
            m = _dense(b.column("_v"), cen.shape[1])
            q = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
            order = np.argsort(-(q @ cn.T), axis=1, kind="stable")
            d2 = (q * q).sum(axis=1)[:, None] + (cen * cen).sum(axis=1)[None, :] - 2.0 * (q @ cen.T)
            upper = 1.0 - np.maximum(np.sqrt(np.maximum(d2, 0.0)) - radius[None, :], 0.0) ** 2 / 2.0
            flat = pa.StructArray.from_arrays([pa.array(ids[order].ravel()), pa.array(np.take_along_axis(upper, order, 1).ravel())], ["cell", "upper"])
            off = pa.array(np.arange(0, len(flat) + 1, len(ids), dtype=np.int32))
            yield b.append_column("_near", pa.ListArray.from_arrays(off, flat))
    return questions.mapInArrow(run, out)


def knn_ivf(queries: DataFrame, index: DataFrame, centroids: np.ndarray, k: int = 4, nprobe: int = 2,
            metric: str = "cosine", query_id: str = "query_id", query_vec: str = "embedding",
            cand_id: str | Sequence[str] = "chunk_id", cand_vec: str = "embedding", carry: Sequence[str] = (),
            exclude_self: bool = False, exact: bool = False, max_block_bytes: int = MAX_BLOCK_BYTES) -> DataFrame:
    """Top-k over an IVF index: each question first meets only its ``nprobe``
    nearest cells; the probed cells filter the partition column, so the scan
    reads only their files.

    ``exact=True`` (cosine) makes the result equal to exact search: with the
    k-th score s_k found for a question, a cell c can still hold a row
    scoring >= s_k only if 1 - max(0, |q - mu_c| - r_c)^2 / 2 >= s_k (unit
    vectors, triangle inequality, r_c = cell radius); a second join, again
    reading only those cells, meets exactly these, and both are merged.
    """
    if exact and metric != "cosine":
        raise ValueError("exact IVF search is defined for cosine")
    dim = centroids.shape[1]
    c = _Candidates(index, cand_id, cand_vec, carry, "centroid")
    facts = cell_facts(c.df, "centroid", "cell_dist" if exact else None)
    sizes = {cell: n for cell, (n, _) in facts.items()}
    cells = sorted(sizes)
    q = _questions(queries, query_id, query_vec)
    if not cells or q.isEmpty():
        return c.hits(None, c.df, 0, carry)
    routes = stored(_routes(q, centroids, cells, [facts[x][1] for x in cells]), "routes")
    side = c.side(c.df, F.col("centroid"))

    def meet(near: Column, asked: DataFrame) -> tuple[DataFrame | None, int]:
        to = asked.select("query_id", "_v", F.explode(near).alias("_n")).select("query_id", "_v", F.col("_n.cell").alias("_cell"))
        return _groups(to, side, c.keys, k, metric, exclude_self, dim, sizes, max_block_bytes)

    found, routed = meet(F.slice("_near", 1, nprobe), routes)
    if exact and nprobe < len(cells):
        first = stored(_rank(found, k, c.keys).drop("rank"), "first")
        kth = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("_kth"))
        more = F.filter(F.slice("_near", nprobe + 1, len(cells)), lambda x: F.col("_kth").isNull() | (x["upper"] + 1e-5 >= F.col("_kth")))
        second, _ = meet(more, routes.join(kth, "query_id", "left"))
        found = first if second is None else first.unionByName(second)
    return c.hits(_rank(found, k, c.keys), c.df, routed * k, carry)
