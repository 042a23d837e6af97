"""Operator 12: k-means in exact integers over a table of pivot distances (LAESA).

Vectors become integers, floor(scale * x).  P pivots are chosen once among the
first centroids, far from each other, and every vector's distances to them are
stored beside it.  In each round only the k x P distances between centroids
and pivots are new.  By the triangle inequality the distance of vector v to
centroid c is at least |d(v, p) - d(c, p)| for every pivot p; the largest of
these bounds orders and prunes the centroids: the one with the smallest bound
gets its exact distance first, and after it only centroids whose bound does
not exceed the best exact distance so far.  Bounds are compared with a margin
over rounding, exact distances are 64-bit integers, so results are exact.

On Spark: one pass makes the stored table, one pass a round reads it.  A task
adds up its vectors of a cluster before anything is shuffled (at most k rows
of a task), so a cluster with a third of all rows costs no more than another.
Only k centroids, P pivots and k x dims sums reach the driver.

Cases: vectors that are null, of another length, or with a null, NaN or
infinite component are left out; so are those with an integer component
beyond ``LARGEST``, whose squared distances need not fit in 64 bits.  Repeated
rows are vectors of their own; vectors of equal start hash (repeated or null
ids) start in order of their components.  With fewer vectors than centroids
every vector starts one; an empty table gives no rows.  Columns are kept only
when asked for, results go before kept columns of the same name.  (Texts do
not occur.)
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm.common import stage, with_fields

#: components up to here keep every squared distance of 64 components below 2^63
LARGEST = 1 << 27
PIVOTS = 12
RESULTS = ("cluster", "distance", "n_exact")


def integers(vectors: DataFrame, vector: str, dims: int, scale: int, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` columns and ``_v``, the kept vectors as integers."""
    x = F.col(vector).cast("array<double>")
    ok = (F.size(x) == dims) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST / scale))
    return vectors.where(ok).select(*keep, F.transform(x, lambda c: F.floor(c * scale).cast("int")).alias("_v"))


def far_apart(points: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` different points, each the farthest from those before (the first point first)."""
    if not len(points):
        return points
    chosen = [0]
    near = ((points - points[0]) ** 2).sum(1)
    while len(chosen) < n and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((points - points[chosen[-1]]) ** 2).sum(1))
    return points[chosen]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of integer points, each the root of an exact square."""
    return np.sqrt(np.stack([((a - p) ** 2).sum(1) for p in b], 1).astype(np.float64)) if len(a) else np.zeros((0, len(b)))


def nearest(v: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, centroid_pivots: np.ndarray):
    """(centroid, squared distance, exact distances computed) of every vector."""
    n, k = len(v), len(centroids)
    bound = np.zeros((n, k))
    for p in range(to_pivots.shape[1]):
        np.maximum(bound, np.abs(to_pivots[:, p, None] - centroid_pivots[None, :, p]), out=bound)
    bound *= 1 - 1e-12                                       # below the true distance whatever was rounded
    bound -= 1e-6
    first = bound.argmin(1)
    best, square = first.copy(), ((v - centroids[first]) ** 2).sum(1)
    reach, count = np.sqrt(square.astype(np.float64)) * (1 + 1e-12), np.ones(n, np.int32)
    for c in range(k):
        rows = np.flatnonzero((bound[:, c] <= reach) & (first != c))
        if not len(rows):
            continue
        d = ((v[rows] - centroids[c]) ** 2).sum(1)
        count[rows] += 1
        better = (d < square[rows]) | ((d == square[rows]) & (c < best[rows]))
        rows, d = rows[better], d[better]
        best[rows], square[rows] = c, d
        reach[rows] = np.sqrt(d.astype(np.float64)) * (1 + 1e-12)
    return best, square, count


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), width)


class Clusters:
    """Final centroids and the table that assigns them.

    ``assigned``: kept columns, ``cluster``, ``distance`` (squared, integer),
    ``n_exact`` (exact distances that the bounds left to compute).
    """

    def __init__(self, centroids: np.ndarray, assigned: DataFrame):
        self.centroids, self.assigned = centroids, assigned


def start(kept: DataFrame, vec_id: str, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest id hashes (k rows on the driver)."""
    rows = (kept.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(vec_id).cast("string"), F.lit(""))).cast("binary"), 256).alias("h"), "_v")
            .orderBy("h", "_v").limit(k).collect())
    return np.array([r._v for r in rows], np.int64)


def with_pivots(kept: DataFrame, pivots: np.ndarray, keep: tuple[str, ...]) -> DataFrame:
    """The pivot table: kept columns, ``_v`` and ``_p``, the distances to the pivots."""
    dims = pivots.shape[1]

    def run(batches):
        for b in batches:
            d = distances(_matrix(b.column("_v"), dims, np.int64), pivots)
            off = pa.array(np.arange(0, d.size + 1, len(pivots), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in [*keep, "_v"]), pa.ListArray.from_arrays(off, pa.array(d.ravel()))], [*keep, "_v", "_p"])
    return kept.mapInArrow(run, with_fields(kept, "_p array<double>"))


def _assigner(centroids: np.ndarray, pivots: np.ndarray):
    across = distances(centroids, pivots)

    def assign(b: pa.RecordBatch):
        v = _matrix(b.column("_v"), centroids.shape[1], np.int64)
        return v, *nearest(v, _matrix(b.column("_p"), len(pivots), np.float64), centroids, across)
    return assign


def moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    k, dims = centroids.shape
    assign = _assigner(centroids, pivots)

    def sums(batches):
        # Python integers: a task's sum may pass 64 bits before it is cut into columns
        total, count = np.zeros((k, dims), object), np.zeros(k, np.int64)
        for b in batches:
            v, best, _, _ = assign(b)
            order = np.argsort(best, kind="stable")
            found, at = np.unique(best[order], return_index=True)
            if len(found):
                total[found] += np.add.reduceat(v[order], at, axis=0)
            count += np.bincount(best, minlength=k)
        some = np.flatnonzero(count)
        flat = pa.array([str(x) for x in total[some].ravel()], pa.string())
        off = pa.array(np.arange(0, len(some) * dims + 1, dims, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(count[some]), pa.ListArray.from_arrays(off, flat)], ["c", "n", "s"])

    parts = table.select("_v", "_p").mapInArrow(sums, "c int, n long, s array<string>")
    means = (parts.select("c", "n", F.posexplode("s").alias("dim", "s")).groupBy("c", "dim")
             .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")))
    new = centroids.copy()
    for r in means.collect():                                # k x dims rows at most
        new[r.c, r.dim] = int(r.s) // r.n
    return new


def cluster(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", dims: int = 64, k: int = 40,
            rounds: int = 5, scale: int = 256, seed: int = 2, n_pivots: int = PIVOTS, keep: tuple[str, ...] | None = None) -> Clusters:
    """k-means from hashed starts: ``rounds`` of assignment and exact floor
    means, then a last assignment; ties go to the smaller number."""
    keep = tuple(c for c in (keep or (vec_id,)) if c not in (*RESULTS, "_v", "_p"))
    ids = tuple(dict.fromkeys((*keep, vec_id)))
    kept = integers(vectors, vector, dims, scale, ids)
    centroids = start(kept, vec_id, k, seed)
    fields = "cluster int, distance long, n_exact int"
    if not len(centroids):
        out = kept.select(*keep).limit(0).selectExpr("*", "cast(null as int) cluster", "cast(null as long) distance", "cast(null as int) n_exact")
        return Clusters(np.zeros((0, dims), np.int64), out)
    pivots = far_apart(centroids, n_pivots)
    table = stage(with_pivots(kept.select(*keep, "_v"), pivots, keep), "pivots")
    for _ in range(rounds):
        centroids = moved(table, centroids, pivots)
    assign = _assigner(centroids, pivots)

    def last(batches):
        for b in batches:
            _, best, square, count = assign(b)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(best.astype(np.int32)), pa.array(square), pa.array(count)],
                                             [*keep, *RESULTS])
    return Clusters(centroids, table.mapInArrow(last, with_fields(table.select(*keep), fields)))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    rows = stage(got.assigned, "clusters")
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in got.centroids.tolist()]
    per = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()   # k rows
    whole = sum(int(r.s) for r in per)
    facts = spark.createDataFrame([(r.cluster, _long(r.s), _long(whole), sha[r.cluster]) for r in per],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _long(x) -> int | None:
    """A sum as a long; null where it does not fit."""
    return int(x) if int(x) < 1 << 63 else None


def oracle(dims: int = 64, k: int = 40, rounds: int = 5, scale: int = 256, seed: int = 2) -> str:
    """The query's rows in DuckDB: every distance of every round."""
    def squares(a: str, b: str) -> str:
        return " + ".join(f"({a}[{j}] - {b}[{j}]) * ({a}[{j}] - {b}[{j}])" for j in range(1, dims + 1))

    out = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
  list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE) AND abs(x::DOUBLE) < {LARGEST // scale})) = {dims})""",
           f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, e) - 1 AS c, e FROM
  (SELECT sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')) AS h, e FROM v ORDER BY h, e LIMIT {k}))"""]
    for i in range(rounds + 1):
        out.append(f"""a{i} AS MATERIALIZED (SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM
  (SELECT v.r, c{i}.c, {squares('v.e', f'c{i}.e')} AS d FROM v CROSS JOIN c{i}) GROUP BY r)""")
        if i < rounds:
            out.append(f"""m{i} AS (SELECT c, j, sum(x) AS s, count(*) AS n FROM
  (SELECT a{i}.c, unnest(v.e) AS x, unnest(range({dims})) AS j FROM a{i} JOIN v USING (r)) GROUP BY c, j)""")
            out.append(f"""c{i + 1} AS MATERIALIZED (SELECT c, coalesce(n.e, o.e) AS e FROM c{i} o LEFT JOIN
  (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS e FROM m{i} GROUP BY c) n USING (c))""")
    return "WITH " + ",\n".join(out) + f"""
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(f.e, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN c{rounds} f USING (c)"""
