"""Most likely topics by a fitted LDA model, a block of rows at a time.

``LDAModel.transform`` infers one row after another; here the same iteration
(variational inference with the model's term weights, from the same starting
point, to the same bound on the change) runs for a block of rows at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: cells (rows x distinct terms) of one block; bounds the memory of a task
BLOCK_CELLS = 1 << 15
#: a block with this share of its rows left leaves them for later
LATE = 0.25
#: as in Spark: shape of the gamma draws that inference starts from, and the mean change that ends it
GAMMA_SHAPE, CHANGE = 100.0, 1e-3


def exp_digamma(x: np.ndarray) -> np.ndarray:
    """exp of the derivative of log gamma of positive numbers: the asymptotic
    series at x + 6 less 1/x + ... + 1/(x + 5), the latter as one fraction."""
    u = x * (x + 5)
    r = (2 * x + 5) * (3 * u * u + 20 * u + 24) / (u * (u + 4) * (u + 6))
    y = x + 6
    s = 1 / (y * y)
    r += 0.5 / y + s * (1 / 12 - s * (1 / 120 - s * (1 / 252 - s * (1 / 240 - s / 132))))
    return y * np.exp(-r)


def _starting_point(spark: SparkSession, model) -> np.ndarray:
    """The draws every inference of the model starts from: its class's default seed, k values."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    seed = 0
    for c in model._java_obj.getClass().getName():
        seed = (31 * seed + ord(c)) & 0xFFFFFFFF
    low = seed - (1 << 32) if seed >> 31 else seed
    words = gateway.new_array(jvm.int, 2)                     # a 64-bit seed: high word, low word
    words[0], words[1] = -1 if low < 0 else 0, low
    source = jvm.org.apache.commons.math3.random.MersenneTwister(words)
    stats = jvm.breeze.stats.distributions
    draws = stats.Gamma(GAMMA_SHAPE, 1 / GAMMA_SHAPE, stats.RandBasis(source))
    return np.array([draws.draw() for _ in range(len(model.estimatedDocConcentration()))])


class Inference:
    """What a task needs of a model: topics x terms weights (a last, empty term pads), prior, start."""

    def __init__(self, weights: np.ndarray, prior: np.ndarray, start: np.ndarray):
        self.weights = np.concatenate([self._expected(weights), np.zeros((1, weights.shape[1]))]).T.copy()
        self.prior, self.start = prior, start

    @classmethod
    def of(cls, spark: SparkSession, model) -> Inference:
        return cls(model.topicsMatrix().toArray(), model.estimatedDocConcentration().toArray(), _starting_point(spark, model))

    def top(self, terms: np.ndarray, counts: np.ndarray, off: np.ndarray) -> np.ndarray:
        """The most likely topic of every row; -1 for a row without terms.  Row i
        has terms[off[i]:off[i + 1]], each once, and their counts."""
        out = np.full(len(off) - 1, -1, np.int32)
        gamma = np.repeat(self.start[:, None], len(out), 1)
        rows, end = np.flatnonzero(np.diff(off)), LATE
        while len(rows):
            # the rows that take long go on together, from where they are
            rows = np.concatenate([self._block(r, terms, counts, off, gamma, out, end) for r in self._blocks(rows, off)])
            end = 0 if len(rows) < 64 else end
        return out

    def _blocks(self, rows: np.ndarray, off: np.ndarray):
        """Rows of like length, longest first, of about ``BLOCK_CELLS`` cells."""
        size = off[rows + 1] - off[rows]
        order = np.argsort(size, kind="stable")
        rows, size, hi = rows[order], size[order], len(rows)
        while hi:
            lo = max(0, hi - max(1, BLOCK_CELLS // int(size[hi - 1])))
            yield rows[lo:hi]
            hi = lo

    @staticmethod
    def _expected(gamma: np.ndarray) -> np.ndarray:
        return exp_digamma(gamma) / exp_digamma(gamma.sum(0))

    def _block(self, rows, terms, counts, off, gammas, out, end) -> np.ndarray:
        """Infer until a share of at most ``end`` of the rows is left; these are
        returned and ``gammas`` holds where they are.  Rows are columns here:
        terms and counts are (longest row) x (rows)."""
        k, first, size = len(self.prior), len(rows), off[rows + 1] - off[rows]
        at = np.arange(size.max())[:, None]
        real = at < size
        cell = np.where(real, off[rows] + at, 0)
        w = self.weights[:, np.where(real, terms[cell], self.weights.shape[1] - 1)]      # topics x terms x rows
        n, gamma = np.where(real, counts[cell], 0.0), gammas[:, rows]
        while True:
            mass = self._expected(gamma)
            share = n / (np.einsum("knm,km->nm", w, mass) + 1e-100)
            new = mass * np.einsum("knm,nm->km", w, share) + self.prior[:, None]
            done = (np.abs(new - gamma).sum(0) / k <= CHANGE) & (out[rows] < 0)
            gamma = new
            if not done.any():
                continue
            out[rows[done]] = (gamma[:, done] / gamma[:, done].sum(0)).argmax(0)
            go = np.flatnonzero(out[rows] < 0)
            if len(go) <= end * first:
                gammas[:, rows[go]] = gamma[:, go]
                return rows[go]
            if len(go) <= 0.6 * len(rows):                   # the ended ones leave, some at a time
                rows, gamma, n, w = rows[go], gamma[:, go], n[:, go], w[:, :, go]


def top_topics(df: DataFrame, vectors: str, model, out: str, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``out``: the most likely topic by ``model`` of a
    column of sparse term counts, null for a row without terms."""
    spark = df.sparkSession
    shipped = spark.sparkContext.broadcast(Inference.of(spark, model))       # topics x terms numbers
    v = F.unwrap_udt(vectors)
    src = df.select(*keep, v["indices"].alias("_i"), v["values"].alias("_n"))

    def run(batches):
        for b in batches:
            i, n = b.column("_i"), b.column("_n")
            off = i.offsets.to_numpy().astype(np.int64)
            top = shipped.value.top(i.flatten().to_numpy(), n.flatten().to_numpy(), off - off[0])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(top, pa.int32(), mask=top < 0)], [*keep, out])
    schema = StructType(df.select(*keep).schema.fields + StructType.fromDDL(f"{out} int").fields)
    return src.mapInArrow(run, schema)
