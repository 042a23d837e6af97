"""Operator 9: quality classifier, histogram gradient-boosted trees over
document statistics.

The statistics of a document (shares of byte classes, word and line lengths,
repetition) are computed from whole texts, a batch at a time, from the bytes
themselves.  Training uses at most ``TRAIN_ROWS`` labelled documents outside
the held-out fold (a documented bound: their statistics are a few MB on the
driver); features are cut into at most ``BINS`` quantile bins and trees grow
level by level from gradient histograms.  A trained model is four arrays over
complete binary trees, so a batch walks all trees with ``DEPTH`` gathers.

Cases: null and empty texts have all statistics 0 and are scored like any
other; with labels of one class only (or none) every score is the smoothed
share of label 1; labels, lang, source and doc_id are not features; equal
texts have equal scores; an empty table gives an empty result; ids with
several labels count as the largest; further columns are kept by ``score``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm.common import Texts, chunks, documents, held_out, mix, training_sample, with_fields

TRAIN_ROWS = 20_000
BINS, DEPTH, TREES, RATE, L2 = 64, 4, 60, 0.15, 1.0
THRESHOLD = 0.3

_CLASS = np.zeros(256, np.uint8)
for _n, _bytes in enumerate([b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\x0b\x0c\r", b"\n",
                             b"#*$%&", b"|<>", b"!?", b".", b",;:", b"()[]{}\"'`-_/\\@+=~^"], start=1):
    _CLASS[list(_bytes)] = _n
N_CLASS = 12
NAMES = ("log_words", "log_bytes", "word_len", "word_len_sd", "line_words", "distinct", "top_word", "same_as_before",
         "distinct_pairs", "dup_lines", "ends_sentence", "ends_symbol", "upper_first", "all_upper",
         *(f"class_{k}" for k in range(N_CLASS)))


def statistics(t: Texts) -> np.ndarray:
    """One row of ``NAMES`` per document."""
    out = np.zeros((t.n, len(NAMES)))
    if not len(t.buf):
        return out
    kind = _CLASS[t.buf]
    s, e, first = t.words()
    size = np.maximum(np.diff(t.off), 1)
    n = np.diff(first)
    safe = np.maximum(n, 1)

    def per_doc(x, bounds):
        c = np.concatenate([[0.0], np.cumsum(x, dtype=np.float64)])
        return c[bounds[1:]] - c[bounds[:-1]]

    def per_byte(x):
        """Running counts in 32 bits: a chunk is a few MB, or one text, which is under 2 GB."""
        c = np.zeros(len(x) + 1, np.int32)
        np.cumsum(x, dtype=np.int32, out=c[1:])
        return c

    def of_class(k):
        c = per_byte(kind == k)
        return c[t.off[1:]] - c[t.off[:-1]]

    for k in range(N_CLASS):
        out[:, len(NAMES) - N_CLASS + k] = of_class(k) / size
    if not len(s):
        return out
    length = (e - s).astype(np.float64)
    h = t.hashes(s, e)
    mean = per_doc(length, first) / safe
    out[:, 0], out[:, 1], out[:, 2] = np.log1p(n), np.log1p(np.diff(t.off)), mean
    out[:, 3] = np.sqrt(np.maximum(0, per_doc(length ** 2, first) / safe - mean ** 2))
    out[:, 4] = n / np.maximum(1, of_class(5).astype(np.float64) + 1)
    again = np.concatenate([[False], h[1:] == h[:-1]])
    again[first[:-1][n > 0]] = False
    out[:, 7] = per_doc(again, first) / safe
    last, start = kind[e - 1], kind[s]
    out[:, 10] = per_doc((last == 9) | (last == 8), first) / safe
    out[:, 11] = per_doc((last == 6) | (last == 7), first) / safe
    out[:, 12] = per_doc(start == 1, first) / safe
    uppers = per_byte(kind == 1)
    out[:, 13] = per_doc((uppers[e] - uppers[s]).astype(np.int64) * 2 > (e - s), first) / safe
    pair = mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) if len(h) > 1 else h[:0]
    line = per_byte(t.buf == 10)[s]
    line_hash = mix(h + (np.arange(len(h), dtype=np.uint64) - np.maximum.accumulate(
        np.where(np.diff(line, prepend=-1) != 0, np.arange(len(h)), 0)).astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93))
    for d in np.flatnonzero(n):
        a, b = first[d], first[d + 1]
        word = np.sort(h[a:b])
        run = np.diff(np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1], [True]])))
        out[d, 5], out[d, 6] = len(run) / n[d], run.max() / n[d]
        if n[d] > 1:
            out[d, 8] = len(np.unique(pair[a:b - 1])) / (n[d] - 1)
        cut = np.flatnonzero(np.diff(line[a:b], prepend=-1))
        sums = np.add.reduceat(line_hash[a:b], cut)
        out[d, 9] = 1 - len(np.unique(sums)) / len(sums)
    return out


class Trees:
    """Flattened ensemble: node k of a tree has children 2k+1 and 2k+2."""

    def __init__(self, feature, cut, leaf, bias):
        self.feature, self.cut, self.leaf, self.bias = feature, cut, leaf, bias

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        trees, nodes = np.arange(len(self.feature)), self.feature.shape[1] if len(self.feature) else 0
        if not nodes:
            return total
        for lo in range(0, len(x), 4096):
            part = x[lo:lo + 4096]
            at = np.zeros((len(part), len(trees)), np.int64)
            while at[0, 0] < nodes:
                right = np.take_along_axis(part, self.feature[trees, at], 1) > self.cut[trees, at]
                at = 2 * at + 1 + right
            total[lo:lo + 4096] += self.leaf[trees, at - nodes].sum(1)
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def train(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Trees:
    """Logistic boosting on gradient histograms."""
    share = (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(share / (1 - share)))
    nodes = (1 << depth) - 1
    if len(np.unique(y)) < 2:
        return Trees(np.zeros((0, nodes), np.int64), np.zeros((0, nodes)), np.zeros((0, nodes + 1)), bias)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)   # x <= edge b: bin <= b
    margin = np.full(len(y), bias)
    feature, cut, leaf = (np.zeros((trees, nodes), np.int64), np.full((trees, nodes), np.inf), np.zeros((trees, nodes + 1)))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, hess = p - y, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for d in range(depth):
            base, width = (1 << d) - 1, 1 << d
            best = np.zeros(width)
            local = at - base
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                key = local * (len(e) + 1) + binned[:, f]
                hg = np.bincount(key, g, width * (len(e) + 1)).reshape(width, -1)
                hh = np.bincount(key, hess, width * (len(e) + 1)).reshape(width, -1)
                lg, lh = np.cumsum(hg, 1)[:, :-1], np.cumsum(hh, 1)[:, :-1]
                tg, th = hg.sum(1, keepdims=True), hh.sum(1, keepdims=True)
                gain = lg ** 2 / (lh + L2) + (tg - lg) ** 2 / (th - lh + L2) - tg ** 2 / (th + L2)
                gain[(lh < 1) | (th - lh < 1)] = 0
                k = gain.argmax(1)
                top = gain[np.arange(width), k]
                for j in np.flatnonzero(top > best + 1e-9):
                    best[j], feature[t, base + j], cut[t, base + j] = top[j], f, e[k[j]]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[t, at]] > cut[t, at])
        end = at - nodes
        sg, sh = np.bincount(end, g, nodes + 1), np.bincount(end, hess, nodes + 1)
        leaf[t] = -rate * sg / (sh + L2)
        margin += leaf[t, end]
    return Trees(feature, cut, leaf, bias)


def fit(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_ROWS) -> Trees:
    """A model from the labelled sample; only its statistics reach the driver."""
    sample = training_sample(docs, labels, "quality", bound)

    def run(batches):
        for b in batches:
            for i, t in chunks(b.column("text")):
                x = statistics(t)
                yield pa.RecordBatch.from_arrays([b.column("y").slice(i, t.n), pa.array(x.tolist(), pa.list_(pa.float64()))], ["y", "x"])
    rows = sample.select("y", "text").mapInArrow(run, "y int, x array<double>").collect()   # at most ``bound`` rows
    x = np.array([r.x for r in rows]).reshape(len(rows), len(NAMES))
    order = np.lexsort(x.T[::-1])       # the model does not depend on the order of arrival
    return train(x[order], np.array([r.y for r in rows], float)[order])


def score(docs: DataFrame, model: Trees) -> DataFrame:
    """All columns of ``docs`` and ``quality_score`` (0 to 1) of every whole text."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)      # a few KB per tree
    keep = [c for c in docs.columns if c != "quality_score"]
    src = docs.select(*keep, docs["text"].cast("string").alias("_text"))

    def run(batches):
        for b in batches:
            got = [shipped.value.score(statistics(t)) for _, t in chunks(b.column("_text"))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(np.concatenate(got) if got else [], pa.float64())],
                                             [*keep, "quality_score"])
    return src.mapInArrow(run, with_fields(docs.select(*keep), "quality_score double"))


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))
    src = docs.withColumn("held_out", held_out())
    return score(src, model).select("doc_id", "held_out", F.col("quality_score").alias("score"),
                                    (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"))
