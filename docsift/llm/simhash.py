"""Operator 7: SimHash document fingerprints (DataFrame functions only).

Terms are pairs of neighbouring words (a lone word by itself); the weight of
a term is one more than the number of its words with four or more
characters.  Each term's 64-bit hash votes with its weight on every bit; a
fingerprint bit is set where more than half of the weight is for it.  Votes
are counted 32 bits apart in one long (two counters of 32 bits each), so 32
ordinary sums make all 64 counts.

Neighbours in Hamming space are found by permuted block tables: the 64 bits
are cut into ``blocks`` blocks; two fingerprints at most ``radius`` apart
agree on at least ``blocks - radius`` whole blocks, so for every choice of
that many blocks there is a table keyed by them.  A pair is taken from the
first table in which it meets, after its distance is checked.  Equal
fingerprints are one entry.

Cases: null and empty texts have no terms and the fingerprint 0; equal texts
have equal fingerprints; the next document of a table's last one is its
first (with one row: itself); null ids come last, equal ids are ordered by
text hash; an empty table gives an empty result.  A text's votes may weigh
up to 2**31 in all.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsift.llm.common import documents, stage
from docsift.llm.native import let, whole, words

RADIUS = 3
BLOCKS = 6
PAIR = (1 << 32) | 1


# ---------------------------------------------------------------- fingerprints

def terms(text: Column) -> Column:
    """array<struct<h, w>>: hash and weight of every term of a text."""
    long = lambda x: F.when(F.length(x) >= 4, 1).otherwise(0)

    def of(ws: Column) -> Column:
        pair = F.zip_with(F.slice(ws, 1, F.size(ws) - 1), F.slice(ws, 2, F.size(ws) - 1),
                          lambda a, b: F.struct(F.xxhash64(a, b).alias("h"), (F.lit(1) + long(a) + long(b)).cast("long").alias("w")))
        one = F.transform(ws, lambda a: F.struct(F.xxhash64(a).alias("h"), (F.lit(1) + long(a)).cast("long").alias("w")))
        return F.when(F.size(ws) < 2, one).otherwise(pair)
    return let(words(text), of)


def fingerprints(rows: DataFrame, texts: dict[str, str], keys: list[str]) -> DataFrame:
    """``keys`` (they tell rows apart) and, for each name in ``texts``, the
    fingerprint (long) of the column it names."""
    units = F.array(*[F.struct(F.lit(k).alias("u"), F.col(c).alias("t")) for k, c in enumerate(texts.values())])
    x = rows.select(*keys, F.explode(units).alias("_x")).select(*keys, F.col("_x.u").alias("_u"), F.explode_outer(terms(F.col("_x.t"))).alias("_t"))
    x = x.select(*keys, "_u", F.coalesce("_t.h", F.lit(0)).alias("_h"), F.coalesce("_t.w", F.lit(0)).alias("_w"))
    votes = [F.sum(F.shiftrightunsigned("_h", k).bitwiseAND(F.lit(PAIR)) * F.col("_w")).alias(f"_v{k}") for k in range(32)]
    c = x.groupBy(*keys, "_u").agg(F.sum("_w").alias("_all"), *votes)
    bit = lambda count, k: F.when(2 * count > F.col("_all"), F.lit(1 << k if k < 63 else -(1 << 63))).otherwise(F.lit(0))
    fp = F.lit(0).cast("long")
    for k in range(32):
        fp = fp.bitwiseOR(bit(F.col(f"_v{k}").bitwiseAND(F.lit(0xFFFFFFFF)), k))
        fp = fp.bitwiseOR(bit(F.shiftrightunsigned(f"_v{k}", 32), k + 32))
    c = c.select(*keys, "_u", fp.alias("_fp"))
    return c.groupBy(*keys).agg(*[F.max(F.when(F.col("_u") == k, F.col("_fp"))).alias(n) for k, n in enumerate(texts)])


def likeness(a: str, b: str) -> Column:
    return F.lit(1.0) - F.bit_count(F.col(a).bitwiseXOR(F.col(b))) / F.lit(64.0)


# ---------------------------------------------------------------- block tables

def block_keys(fp: str, radius: int, blocks: int) -> Column:
    """array<struct<tab, key>>: the table number and key of every table."""
    edge = [round(64 * k / blocks) for k in range(blocks + 1)]
    part = [F.shiftrightunsigned(fp, edge[k]).bitwiseAND(F.lit((1 << (edge[k + 1] - edge[k])) - 1)) for k in range(blocks)]
    out = []
    for n, pick in enumerate(itertools.combinations(range(blocks), blocks - radius)):
        key, at = F.lit(0).cast("long"), 0
        for k in pick:
            key = key.bitwiseOR(F.shiftleft(part[k], at))
            at += edge[k + 1] - edge[k]
        out.append(F.struct(F.lit(n).alias("tab"), key.alias("key")))
    return F.array(*out)


def first_table(a: str, b: str, radius: int, blocks: int) -> Column:
    """Number of the first table in which two fingerprints meet."""
    edge = [round(64 * k / blocks) for k in range(blocks + 1)]
    x = F.col(a).bitwiseXOR(F.col(b))
    same = [F.shiftrightunsigned(x, edge[k]).bitwiseAND(F.lit((1 << (edge[k + 1] - edge[k])) - 1)) == 0 for k in range(blocks)]
    out = None
    for n, pick in reversed(list(enumerate(itertools.combinations(range(blocks), blocks - radius)))):
        met = same[pick[0]]
        for k in pick[1:]:
            met = met & same[k]
        out = F.when(met, F.lit(n)) if out is None else F.when(met, F.lit(n)).otherwise(out)
    return out


def search(index: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(query, fp, n, dist): every distinct fingerprint of ``index`` (column fp)
    within ``radius`` of a distinct query fingerprint, with its row count."""
    if not 0 <= radius < blocks:
        raise ValueError("blocks must exceed the radius")
    idx = index.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).withColumn("_b", F.explode(block_keys("fp", radius, blocks)))
    q = queries.select(F.col("fp").alias("query")).distinct().withColumn("_b", F.explode(block_keys("query", radius, blocks)))
    idx, q = idx.select("fp", "n", "_b.tab", "_b.key"), q.select("query", F.col("_b.tab").alias("qtab"), F.col("_b.key").alias("qkey"))
    dist = F.bit_count(F.col("fp").bitwiseXOR(F.col("query")))
    met = (F.col("tab") == F.col("qtab")) & (F.col("key") == F.col("qkey")) & (dist <= radius)
    return (idx.join(q, met & (F.col("tab") == first_table("fp", "query", radius, blocks)))
            .select("query", "fp", "n", dist.alias("dist")))


# ---------------------------------------------------------------- order of documents

def range_of(col: Column, bounds: list[int]) -> Column:
    """Number of bounds that are <= the value (null: all of them), by one step
    over every s-th bound and one over the s that follow."""
    if not bounds:
        return F.lit(0)
    s = max(1, math.isqrt(len(bounds)))
    top = F.array(*[F.lit(b) for b in bounds[s - 1::s]])
    every = F.array(*[F.lit(b) for b in bounds])
    def inner(v: Column) -> Column:
        return let(F.size(F.filter(top, lambda b: b <= v)), lambda k: k * s + F.size(F.filter(F.slice(every, k * s + 1, s), lambda b: b <= v)))
    return F.when(col.isNull(), F.lit(len(bounds))).otherwise(let(col, inner))


def ordered(docs: DataFrame) -> DataFrame:
    """(doc_id, text, pos, next): position from 0 in ascending order, and the
    next document's text.  Texts are moved once, to ranges of ids; the first
    row of each range also goes to the range before."""
    spark = docs.sparkSession
    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    q = docs.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 100 * n).alias("q")).first().q
    d = docs.select("doc_id", whole().alias("text")).withColumn("_h", F.xxhash64("text"))
    d = d.withColumn("_r", range_of(F.col("doc_id"), sorted(set(q or []))))
    by_key = [F.col("doc_id").asc_nulls_last(), F.col("_h")]
    # one row per range from here on: counts, places before, first row, range before
    key = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("i"), F.col("_h").alias("h"))
    ranges = stage(d.groupBy("_r").agg(F.count(F.lit(1)).alias("_n"), F.min(key).alias("_first")), "ranges")
    w = Window.orderBy("_r")
    ranges = ranges.select("_r", "_n", "_first",
                           F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
                           F.lag("_r").over(w).alias("_prev"))
    last = ranges.agg(F.max("_r")).first()[0]
    halo = ranges.select(F.coalesce("_prev", F.lit(last)).alias("_to"), F.col("_first.i").alias("_i"), F.col("_first.h").alias("_hh"))
    extra = (d.join(F.broadcast(halo), F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("_h") == F.col("_hh")))
             .select("doc_id", "text", "_h", F.col("_to").alias("_r"), F.lit(1).alias("_halo")).dropDuplicates(["_r"]))
    rows = d.select("doc_id", "text", "_h", "_r", F.lit(0).alias("_halo")).unionByName(extra)
    w = Window.partitionBy("_r").orderBy(F.col("_halo"), *by_key)
    rows = rows.select("doc_id", "text", "_r", "_halo", F.lead("text").over(w).alias("next"), F.row_number().over(w).alias("_i"))
    return (rows.where("_halo = 0").join(F.broadcast(ranges.select("_r", "_before")), "_r")
            .select("doc_id", "text", "next", (F.col("_before") + F.col("_i") - 1).alias("pos")))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = ordered(documents(spark, sf_dir, "doc_id", "text"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    o = o.withColumn("edited", F.concat(F.substring("text", 1, n - half), F.substring("next", 1, half)))
    o = o.select("pos", "doc_id", n.cast("long").alias("n_chars"), F.unhex(F.sha2(F.col("edited").cast("binary"), 256)).alias("_sha"), "text", "edited")
    f = stage(fingerprints(o, {"fp": "text", "efp": "edited"}, ["pos", "doc_id", "n_chars", "_sha"]), "fingerprints")
    total = f.count()
    after = f.select(F.pmod(F.col("pos") - 1, F.lit(max(1, total))).alias("pos"), F.col("fp").alias("nfp"))
    near = search(f.select("fp"), f.where("doc_id % 100 = 0").select("fp"))
    near = near.groupBy(F.col("query").alias("fp")).agg((F.sum("n") - 1).alias("n_near"))
    hexed = lambda c: F.lpad(F.lower(F.hex(c)), 16, "0")
    # n_near: documents within the radius of the queries, which are the ids divisible by 100
    return (f.join(after, "pos").join(near, "fp", "left")
            .select("doc_id", "n_chars", F.lower(F.hex("_sha")).alias("edited_sha256"), hexed("fp").alias("fingerprint"),
                    hexed("efp").alias("edited_fingerprint"), likeness("fp", "efp").alias("near_edited"),
                    likeness("fp", "nfp").alias("near_next"),
                    F.when(F.col("doc_id") % 100 == 0, F.col("n_near")).alias("n_near")))
