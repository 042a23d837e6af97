"""Operator 1: toxicity by a string-kernel support vector machine with Nyström
landmarks, trained on labelled sentences.

Kernel.  Two strings are compared by their common subsequences of three
characters; a subsequence spread over a span of s steps counts ``DECAY**s``,
spans above ``SPAN`` count nothing, and a string is scaled by the norm of a
string of its length whose subsequences all differ.  Gaps let an insult
match with inserted characters ("i.d-i.o.t"); single characters set apart by
spaces count as one string, punctuation is dropped, letters fold case and
common digit look-alikes, and the ends of a string are marked.

Nyström.  ``LANDMARKS`` strings, found among the words over-represented in
sentences labelled toxic and among frequent clean ones, span the feature
space; a string's features are its kernel values with them, whitened.

Training.  A sentence has its document's label.  As most sentences of a toxic
document are harmless, each is represented by its witness, its most toxic
string so far, and toxic documents by their best sentences; the linear SVM
(squared hinge, Newton steps) and the witnesses are fitted in turn, clean
sentences serving as hard negatives.  A logistic fit over a document's best
sentence and share of toxic sentences gives the score.

Scoring.  The decision function is linear in the subsequence counts, so the
landmark expansion is multiplied out once into a table of 32**3 weights, and
whole texts are scored by gathers over the bytes: no word list, no cut-off.

Cases: null and empty texts score as a document without sentences; labels of
one class or no labels give the smoothed share of label 1 everywhere;
labels, lang, source and doc_id are never inputs; equal texts score equally;
texts of any length are scored whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm.common import Texts, chunks, documents, held_out, training_sample, with_fields

TRAIN_ROWS = 6_000
LANDMARKS, SPAN, DECAY = 600, 5, 0.7
ROUNDS = 4
MAX_NORM = 64          # longer strings are scaled like one of this length

_FOLD = np.full(256, 31, np.int32)
for _i in range(26):
    _FOLD[97 + _i] = _FOLD[65 + _i] = _i + 1
for _a, _b in zip(b"013457@$", b"oleastas", strict=True):
    _FOLD[_a] = _FOLD[_b]
_FOLD[128:] = 27 + np.arange(128) % 4
_STEPS = [(a, b) for a in range(1, SPAN) for b in range(1, SPAN) if a + b <= SPAN]
_NORM = np.array([1.0] + [max(1e-9, sum(max(0, n - a - b) * DECAY ** (2 * (a + b)) for a, b in _STEPS)) ** 0.5 if n > 2 else 1e9
                          for n in range(1, MAX_NORM + 1)])
_END = np.zeros(256, bool)
_END[[10, 33, 46, 63]] = True


def parts(t: Texts):
    """Start, end, first part per document, and sentence number of each part.

    A part is a run without white space; neighbouring runs of one character
    are one part.  A sentence ends at a part that ends in . ! ? or before a
    line break.
    """
    s, e, first = t.words()
    if not len(s):
        return s, e, first, np.zeros(0, np.int64)
    one = (e - s) == 1
    doc_start = np.zeros(len(s) + 1, bool)
    doc_start[first[:-1]] = True
    glue = np.zeros(len(s), bool)
    glue[1:] = one[1:] & one[:-1] & ~doc_start[1:len(s)]
    keep = np.flatnonzero(~glue)
    ends = np.concatenate([e[keep[1:] - 1], e[-1:]])
    s = s[keep]
    first = np.searchsorted(keep, first)
    lines = np.concatenate([[0], np.cumsum(t.buf == 10)])
    stop = _END[t.buf[ends - 1]]
    stop[:-1] |= lines[s[1:]] != lines[ends[:-1]]
    new = np.concatenate([[True], stop[:-1]])
    new[first[:-1][np.diff(first) > 0]] = True
    return s, ends, first, np.cumsum(new) - 1


def coded(t: Texts, s: np.ndarray, e: np.ndarray):
    """Symbols of all parts, each between two marks 0, the part of each symbol,
    and the scale of each part."""
    edge = np.zeros(len(t.buf) + 1, np.int32)
    np.add.at(edge, s, 1)
    owner = np.cumsum(edge[:-1], dtype=np.int32) - 1
    np.subtract.at(edge, e, 1)
    # white space and punctuation inside a part are dropped
    solid = np.cumsum(edge[:-1], dtype=np.int32).astype(bool) & (_FOLD[t.buf] != 31)
    owner = owner[solid]
    size = np.bincount(owner, minlength=len(s)) + 2
    c = np.zeros(len(owner) + 2 * len(s), np.int32)
    c[np.arange(len(owner)) + 2 * owner + 1] = _FOLD[t.buf[solid]]
    return c, np.repeat(np.arange(len(s), dtype=np.int32), size), _NORM[np.minimum(size, MAX_NORM)]


def triples(c: np.ndarray, owner: np.ndarray):
    """(number of the triple's first symbol, code, weight) for every spacing."""
    hi, mid = c << 10, c << 5
    for a, b in _STEPS:
        n = len(c) - a - b
        if n > 0:
            yield n, hi[:n] + mid[a:a + n] + c[a + b:], owner[:n] == owner[a + b:], np.float32(DECAY ** (a + b))


def part_scores(t: Texts, s: np.ndarray, e: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sum of ``table`` over all gapped triples of each part, scaled by its norm."""
    if not len(s):
        return np.zeros(0)
    c, owner, norm = coded(t, s, e)
    total = np.zeros(len(c), np.float32)
    for n, code, same, w in triples(c, owner):
        got = table[code]
        got *= w
        got *= same
        total[:n] += got
    return np.bincount(owner, total, minlength=len(s)) / norm


def spread(words: list[str], table: np.ndarray) -> np.ndarray:
    """Like ``part_scores`` for strings and a table of several columns."""
    raw = [w.encode("utf-8") for w in words]
    end = np.cumsum([len(w) + 1 for w in raw])
    t = Texts(np.frombuffer(b" ".join(raw) + b" ", np.uint8), np.array([0, end[-1]]))
    c, owner, norm = coded(t, end - 1 - np.array([len(w) for w in raw]), end - 1)
    out = np.zeros((len(words), table.shape[1]), np.float32)
    for _, code, same, w in triples(c, owner):
        own = owner[:len(code)][same]
        if len(own):
            cut = np.flatnonzero(np.diff(own, prepend=-1))
            out[own[cut]] += w * np.add.reduceat(table[code[same]], cut)
    return out / norm[:, None].astype(np.float32)


def vectors_of(words: list[str]) -> np.ndarray:
    """Explicit scaled subsequence vectors (one row of 32**3 per string)."""
    out = np.zeros((len(words), 1 << 15), np.float32)
    for r, word in enumerate(words):
        raw = word.encode("utf-8")
        c, owner, norm = coded(Texts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])), np.array([0]), np.array([len(raw)]))
        for _, code, same, w in triples(c, owner):
            np.add.at(out[r], code[same], w)
        out[r] /= norm[0]
    return out


class Model:
    def __init__(self, table: np.ndarray, offset: float, calibration: np.ndarray, prior: float, landmarks: list[str]):
        self.table, self.offset, self.calibration, self.prior, self.landmarks = table, offset, calibration, prior, landmarks

    def evidence(self, t: Texts) -> np.ndarray:
        """Per document: best sentence, log of toxic sentences, share of them."""
        s, e, first, sentence = parts(t)
        out = np.zeros((t.n, 3))
        out[:, 0] = -3.0
        if not len(s):
            return out
        f = np.clip(part_scores(t, s, e, self.table) + self.offset, -3, 3)
        starts = np.flatnonzero(np.diff(sentence, prepend=-1))
        best = np.maximum.reduceat(f, starts)                 # a sentence counts as its witness
        doc = np.searchsorted(first, starts, "right") - 1
        doc_from = np.searchsorted(doc, np.arange(t.n + 1))
        full = np.flatnonzero(np.diff(doc_from))
        out[full, 0] = np.maximum.reduceat(best, doc_from[full])
        hits = np.bincount(doc, best > 0, minlength=t.n)
        out[:, 1], out[full, 2] = np.log1p(hits), hits[full] / np.diff(doc_from)[full]
        return out

    def score(self, t: Texts) -> np.ndarray:
        if self.calibration is None:
            return np.full(t.n, self.prior)
        z = self.evidence(t) @ self.calibration[:-1] + self.calibration[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 300.0) -> np.ndarray:
    """Squared-hinge linear SVM by Newton steps; the last entry is the offset."""
    x = np.hstack([z, np.ones((len(z), 1))]).astype(np.float32)
    w, reg = np.zeros(x.shape[1]), np.ones(x.shape[1])
    reg[-1] = 1e-3
    for _ in range(15):
        m = 1 - y * (x @ w.astype(np.float32))
        on = np.flatnonzero(m > 0)
        part = x[on] * np.sqrt(weight[on])[:, None].astype(np.float32)
        grad = reg * w - c * (part.T @ (np.sqrt(weight[on]) * y[on] * m[on]).astype(np.float32)).astype(float)
        step = np.linalg.solve(np.diag(reg) + c * (part.T @ part).astype(float), grad)
        w -= step
        if np.abs(step).max() < 1e-3 * max(1.0, np.abs(w).max()):
            break
    return w


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-2) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1))])
    w, reg = np.zeros(x.shape[1]), np.full(x.shape[1], l2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(np.diag(reg) + (x.T * (p * (1 - p) + 1e-9)) @ x, x.T @ (p - y) + reg * w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(texts: list[str], y: np.ndarray, landmarks: int = LANDMARKS) -> Model:
    prior = (y.sum() + 1) / (len(y) + 2)
    if len(np.unique(y)) < 2:
        return Model(None, 0.0, None, float(prior), [])
    # sentences as lists of parts, with their document and its label
    docs: list[list[list[str]]] = []
    same: dict[str, str] = {}
    for x in texts:
        raw = x.encode("utf-8")
        t = Texts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        s, e, _, sent = parts(t)
        out: list[list[str]] = [[] for _ in range(int(sent[-1]) + 1 if len(sent) else 0)]
        for a, b, k in zip(s.tolist(), e.tolist(), sent.tolist(), strict=True):
            w = raw[a:b].decode("utf-8", "replace").strip(".,;:!?\"'()|").lower()
            out[k].append(same.setdefault(w, w))
        docs.append(out)
    n_docs = {1: Counter(), 0: Counter()}
    for d, label in zip(docs, y.astype(int).tolist(), strict=True):
        n_docs[label].update({w for s in d for w in s if len(w) > 2})
    tox, clean = n_docs[1], n_docs[0]
    size = {1: y.sum(), 0: len(y) - y.sum()}
    # how much more often a word's documents are toxic than by chance, shrunk for rare words
    lift = {w: np.log((k + 0.05) / size[1]) - np.log((clean.get(w, 0) + 0.5 * size[0] / size[1] * 0.1 + 0.05) / size[0]) for w, k in tox.items()}
    ranked = sorted(lift, key=lambda w: (-lift[w], w))

    chosen: list[str] = []
    held = np.zeros((0, 1 << 15), np.float32)

    def land(words: list[str], most: int, like: float) -> None:
        """Take words as landmarks, in order, that are unlike those taken."""
        nonlocal held
        v = vectors_of(words)
        near = (v @ held.T).max(1) if len(held) else np.zeros(len(words))
        own = v @ v.T
        take: list[int] = []
        for i in range(len(words)):
            if len(take) < most and near[i] < like and (not take or own[i, take].max() < like):
                take.append(i)
        chosen.extend(words[i] for i in take)
        held = np.vstack([held, v[take]])

    share = landmarks // (ROUNDS + 2)
    land(ranked[:10 * share], share, 0.7)
    land(sorted(clean, key=lambda w: (-clean[w], w))[:2 * share], share, 0.95)
    pool = sorted(clean, key=hash_of)[:6_000]
    score = {w: lift.get(w, -3.0) - 1.0 for w in {*tox, *clean}}
    w_svm = None
    for turn in range(ROUNDS):
        # witnesses: of toxic documents their suspicious sentences' (at least the best), of clean ones the three worst
        positive, weight = [], []
        negative = set(pool)
        for d, label in zip(docs, y, strict=True):
            best = {max(s, key=lambda w: (score.get(w, -9.0), w)) for s in d if s}
            rank = sorted(best, key=lambda w: (-score.get(w, -9.0), w))
            if label:
                take = [w for w in rank if score.get(w, -9.0) > 0][:10] or rank[:1]
                positive += take
                weight += [1.0 / max(1, len(take))] * len(take)
                longer = [inserted(w) for w in take[:3] if len(w) > 4 and score.get(w, -9.0) > 0]
                positive += longer
                weight += [0.3 / max(1, len(take))] * len(longer)
            else:
                negative.update(rank[:3])
        worst = sorted(negative, key=lambda w: (-score.get(w, -9.0), w))
        land(worst[:3 * share], share, 0.95)                       # landmarks where mistakes are made
        negative = sorted(negative)
        values, vectors = np.linalg.eigh((held @ held.T).astype(float))
        good = values > 1e-4 * values.max()
        whiten = vectors[:, good] / np.sqrt(values[good])          # K_mm^(-1/2) on its range
        columns = np.ascontiguousarray(held.T)
        names = list(dict.fromkeys(positive + negative))
        z = np.vstack([spread(names[i:i + 500], columns) @ whiten for i in range(0, len(names), 500)])
        row = {w: i for i, w in enumerate(names)}
        at = np.array([row[w] for w in positive + negative])
        y_svm = np.array([1.0] * len(positive) + [-1.0] * len(negative), np.float32)
        pos, neg = np.array(weight), np.sqrt([1.0 + clean.get(w, 0) for w in negative])
        w_svm = _svm(z[at], y_svm, np.concatenate([pos / pos.sum(), 2 * neg / neg.sum()]) * len(positive))
        table = (columns @ (whiten @ w_svm[:-1])).astype(np.float32)
        names = list(score)
        for i in range(0, len(names), 20_000):
            score.update(zip(names[i:i + 20_000], (spread(names[i:i + 20_000], table[:, None])[:, 0] + w_svm[-1]).tolist(), strict=True))
    model = Model(table, float(w_svm[-1]), None, float(prior), chosen)
    ev = []
    for x in texts:
        raw = x.encode("utf-8")
        ev.append(model.evidence(Texts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])))[0])
    model.calibration = _logistic(np.array(ev), y)
    return model


def inserted(word: str) -> str:
    """The word with one letter put in at a place, both chosen by its hash."""
    h = hash_of(word)
    at = 1 + h % (len(word) - 1)
    return word[:at] + chr(97 + h // 64 % 26) + word[at:]


def hash_of(word: str) -> int:
    import zlib
    return zlib.crc32(word.encode("utf-8"))


def fit(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_ROWS) -> Model:
    """A model from at most ``bound`` labelled documents (their texts reach the driver)."""
    rows = sorted((r.text, r.y) for r in training_sample(docs, labels, "toxic", bound).select("text", "y").toLocalIterator())
    return train([t for t, _ in rows], np.array([y for _, y in rows], float))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and ``toxic_score`` (0 to 1) of every whole text."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)      # 128 KB of weights
    keep = [c for c in docs.columns if c != "toxic_score"]
    src = docs.select(*keep, docs["text"].cast("string").alias("_text"))

    def run(batches):
        for b in batches:
            got = [shipped.value.score(t) for _, t in chunks(b.column("_text"), 1 << 20)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(np.concatenate(got) if got else [], pa.float64())],
                                             [*keep, "toxic_score"])
    return src.mapInArrow(run, with_fields(docs.select(*keep), "toxic_score double"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
    return score(docs.withColumn("held_out", held_out()), model).select(
        "doc_id", "held_out", F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"))
