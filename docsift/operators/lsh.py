"""SCH-6 (a): approximate cosine search by multi-probe hash buckets.

Random hyperplanes give a vector one bit each; ``bits`` of them name a bucket,
and ``tables`` independent sets of planes give as many buckets to every
candidate.  A question looks into its own bucket of each table and into those
that differ in the bits it is least sure of: bits whose hyperplanes lie
closest, cheapest combinations first (the cost of a combination is the sum of
the squared distances to the planes crossed, up to ``flips`` bits).

Buckets are the cells of ``operators.search``: large ones are split over
salts, members of a bucket stream past the questions that probe it, and only
the best k of each come out with their true scores.  No pairs of a bucket are
listed.  A candidate found in several tables counts once.
"""

from __future__ import annotations

from itertools import combinations
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.operators.search import MAX_BLOCK_BYTES, ROW, _Candidates, _dense, _groups, _questions, _rank, number_rows
from docsift.session import ship_package, stored


class Planes:
    """The hash functions: ``tables`` x ``bits`` hyperplanes through the origin
    (a bounded model of tables * bits * dim numbers, drawn from ``seed``)."""

    def __init__(self, dim: int, tables: int = 12, bits: int = 6, seed: int = 11):
        if not 1 <= bits <= 24:
            raise ValueError("bits must be 1 to 24")
        self.dim, self.tables, self.bits = dim, tables, bits
        w = np.random.default_rng(seed).normal(size=(tables * bits, dim))
        self.w = w / np.linalg.norm(w, axis=1, keepdims=True)

    def sides(self, m: np.ndarray) -> np.ndarray:
        """Signed distances of unit vectors to the planes: (rows, tables, bits)."""
        u = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
        return (u @ self.w.T).reshape(len(m), self.tables, self.bits)

    def buckets(self, sides: np.ndarray) -> np.ndarray:
        """Bucket numbers, different in every table: (rows, tables)."""
        own = (sides > 0) @ (1 << np.arange(self.bits))
        return own + (np.arange(self.tables) << self.bits)

    def probes(self, sides: np.ndarray, n: int, flips: int = 3) -> np.ndarray:
        """The ``n`` buckets of each table to look into, own bucket first."""
        masks = [c for r in range(min(flips, self.bits) + 1) for c in combinations(range(self.bits), r)]
        member = np.zeros((len(masks), self.bits))
        for i, c in enumerate(masks):
            member[i, list(c)] = 1
        cost = (sides ** 2) @ member.T                                    # (rows, tables, masks)
        cheapest = np.argsort(cost, axis=2, kind="stable")[:, :, :n]
        flip = (member @ (1 << np.arange(self.bits))).astype(np.int64)[cheapest]
        return self.buckets(sides)[:, :, None] ^ flip                     # flips stay below the table's number


def _with_buckets(df: DataFrame, vec: str, out: str, find) -> DataFrame:
    """``df`` with an array of bucket numbers per row."""
    ship_package(df.sparkSession)

    def run(batches):
        for b in batches:
            if b.num_rows:
                got = find(_dense(b.column(vec), None))
                off = pa.array(np.arange(0, got.size + 1, got.shape[1], dtype=np.int32))
                yield b.append_column(out, pa.ListArray.from_arrays(off, pa.array(got.ravel().astype(np.int32))))
    return df.mapInArrow(run, T.StructType(df.schema.fields + T.StructType.fromDDL(f"`{out}` array<int>").fields))


def knn_lsh(queries: DataFrame, candidates: DataFrame, planes: Planes, k: int = 5, probes: int = 8, flips: int = 3,
            query_id: str = "query_id", query_vec: str = "embedding", cand_id: str | Sequence[str] = "chunk_id",
            cand_vec: str = "embedding", carry: Sequence[str] = (), exclude_self: bool = False,
            max_block_bytes: int = MAX_BLOCK_BYTES) -> DataFrame:
    """Approximate k nearest by cosine: ``query_id, rank, score, ids, carry``.

    Scores are exact for every hit; what may be missing are hits that share
    no probed bucket with the question.  Measure it with ``recall_at_k``.
    """
    q, side, c, sizes = _sides(queries, candidates, planes, probes, flips, query_id, query_vec, cand_id, cand_vec, carry)
    found, routed = _groups(q, side, c.keys, k, "cosine", exclude_self, None, sizes, max_block_bytes)
    if found is not None:
        found = found.dropDuplicates(["query_id", *c.keys])               # at most k rows a group reach this
    return c.hits(None if found is None else _rank(found, k, c.keys), c.df, routed * k, carry)


def _sides(queries, candidates, planes, probes, flips, query_id, query_vec, cand_id, cand_vec, carry):
    if ROW not in candidates.columns:
        names = [cand_id] if isinstance(cand_id, str) else list(cand_id)
        candidates = number_rows(candidates.select(*dict.fromkeys([*names, cand_vec, *carry])))
    c = _Candidates(candidates, cand_id, cand_vec, carry)
    own = _with_buckets(c.side(c.df, F.lit(0)).drop("_cell"), "_v", "_b", lambda m: planes.buckets(planes.sides(m)))
    side = stored(own, "buckets").select("*", F.explode("_b").alias("_cell")).drop("_b")
    asked = _with_buckets(_questions(queries, query_id, query_vec), "_v", "_b",
                          lambda m: planes.probes(planes.sides(m), probes, flips).reshape(len(m), -1))
    q = stored(asked, "probes").select("query_id", "_v", F.explode("_b").alias("_cell"))
    sizes = {r["_cell"]: r["count"] for r in side.groupBy("_cell").count().collect()}   # tables * 2^bits rows at most
    return q, side, c, sizes


def scored_share(queries: DataFrame, candidates: DataFrame, planes: Planes, probes: int = 8, flips: int = 3,
                 query_vec: str = "embedding", cand_vec: str = "embedding") -> float:
    """Share of all (question, candidate) pairs that the search scores; a pair
    that meets in several tables counts each time."""
    def counts(df, vec, find):
        return _with_buckets(df.select(F.col(vec).alias("_v")).where(F.col("_v").isNotNull()), "_v", "_b", find) \
            .select(F.explode("_b").alias("b")).groupBy("b").agg(F.count(F.lit(1)).cast("double").alias("n"))
    a = counts(candidates, cand_vec, lambda m: planes.buckets(planes.sides(m)))
    b = counts(queries, query_vec, lambda m: planes.probes(planes.sides(m), probes, flips).reshape(len(m), -1)).withColumnRenamed("n", "m")
    met = a.join(b, "b").agg(F.coalesce(F.sum(F.col("n") * F.col("m")), F.lit(0.0)).alias("met")).first().met
    return met / max(1, candidates.where(F.col(cand_vec).isNotNull()).count() * queries.where(F.col(query_vec).isNotNull()).count())
