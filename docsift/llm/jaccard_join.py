"""Operator 6: N-gram Jaccard join in the Jaccard metric space, exact.

Distance is one minus Jaccard similarity of the sets of word shingles, a
metric; two documents link within ``r`` = 1 - similarity threshold.  Equal
sets are one point (a class) with many documents.

1. *Outer regions.*  The first pivots are the one-shingle sets.  A point's
   nearest pivots are its own shingles; ties follow one global order
   (shingles found frequent last, then by hash).  Two points within ``r``
   share enough shingles that the first one they share, in that order, lies
   among the first n - ceil((1 - r) n) + 1 of each: a point is replicated to
   the regions of just those pivots, its window, and every link meets in a
   region.  Sizes and places in the order give a bound on the overlap that
   drops most other pairs.
2. *Pivots inside a region.*  Regions of up to ``SMALL`` points are compared
   whole.  In larger ones a point meets the pivot of its first such region;
   all points of a pivot's ball (distance <= r) link to it and need no
   comparison with each other to be connected.
3. *Recursion.*  Regions whose points are one component are closed.  In an
   open region every component but its largest in turn supplies pivots,
   ``PIVOTS`` a round, compared with all points of other components except
   where the triangle inequality rules a link out: points of one Voronoi cell
   (nearest pivot) whose distances to that pivot differ by more than ``r``.
   Rounds go on until no region has a pivot left, so no link between
   components is missed.

4. *Links.*  Both ends of a link lie in one component, so the links are found
   by comparing all points of a component: large ones are dealt into blocks
   by the point's hash, every two blocks meet in one task, and the sizes of
   all intersections of two blocks come from products of 0/1 matrices.
   Copies are never expanded: a class counts with its number of documents.

A pair that meets in many regions is listed once, in the list of one of its
points.  Lists with the same first point are compared in one slot (large ones
in several), where a point and its set come once, whether it lists others or
is listed.  Bit sketches (a bit per class of shingles, more bits for longer
texts) bound the overlap of what is left from above and drop most
pairs that do not link; the rest are compared exactly.

Which shingles count as frequent changes the work, never the result: a
shingle is noted where a batch of documents has it several times, and counts
are summed over all batches.

Spark side: texts are read three times and never shuffled; what is shuffled
are 32-bit shingle keys of the windows and the sets of points that take part
in comparisons.  Tables between the steps lie in the shared folder, sketches
and sets in buckets of points.

Cases: null and empty texts have the empty set and link with nothing;
fewer words than a shingle are one shingle; repeated rows fall in one class;
a null doc_id links like any other and counts last when the smallest id of a
component is taken; further columns are ignored by ``components``, ``joined``
and ``link_pairs`` and kept by ``keep_one``; an empty table gives an empty result.  Shingles are compared by
64-bit hashes, 48 bits of them in the exact comparison.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsift.llm.common import chunks, documents, mix, shared_path, shingle_hashes, stage
from docsift.llm.native import SPACES, whole

SHINGLE = 5
NUM, DEN = 75, 100                  # similarity at least NUM / DEN
#: regions of up to so many points are compared whole; pivots a round in larger ones, first and later
SMALL, PIVOTS = 16, (64, 512)
#: bits of a sketch, at least, and for each shingle of the point, at least; always a power of two
SKETCH_BITS, SHINGLE_BITS = 2048, 4
#: a shingle is noted if a batch has it in so many points, and frequent with so many noted in all
NOTED, FREQUENT = 3, 24
#: bound of the broadcast table of frequent shingles (16 bytes each); the most frequent ones
LATE = 500_000
BLOOM_BITS = 1 << 24
#: points and shingles of a block of a component, about; columns of one matrix product
BLOCK, BLOCK_SHINGLES, COLUMNS = 256, 1 << 18, 4096
#: entries of the lists of a slot of comparisons, about, and different points among them, at most
LISTED, BLOCK_LISTED = 1 << 17, 4096
#: text bytes taken apart at once
TEXT_BYTES = 1 << 20


def row_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), whole())


def point_sets(column, size: int):
    """For every text of an Arrow column: its sorted distinct shingle hashes."""
    for _, t in chunks(column, TEXT_BYTES):
        s, e, first = t.words()
        h, bounds = shingle_hashes(t.hashes(s, e), first, size)
        for a, b in bounds.tolist():
            yield np.unique(h[a:b])


def set_hash(u: np.ndarray) -> int:
    x = mix(np.array([int(mix(u).sum(dtype=np.uint64)) ^ len(u)], np.uint64))
    return int(x.view(np.int64)[0])


def window_length(n: int) -> int:
    return n - (NUM * n + DEN - 1) // DEN + 1


# ---------------------------------------------------------------- step 1: points and windows

def frequent(docs: DataFrame, size: int) -> DataFrame:
    """(h, n) of frequent shingles, at most ``LATE``."""
    def run(batches):
        for b in batches:
            seen, sets = set(), []
            for u in point_sets(b.column("_text"), size):
                k = set_hash(u)
                if k not in seen:
                    seen.add(k)
                    sets.append(u)
            if not sets:
                continue
            h = np.concatenate(sets)
            sets.clear()
            h.sort()
            at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, int)
            n = np.diff(np.concatenate([at, [len(h)]]))
            hit = n >= NOTED
            yield pa.RecordBatch.from_arrays([pa.array(h[at[hit]].view(np.int64)), pa.array(n[hit], pa.int64())], ["h", "n"])
    noted = docs.select(whole().alias("_text")).mapInArrow(run, "h long, n long")
    return (noted.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
            .orderBy(F.desc("n"), "h").limit(LATE))


def sketch_of(u: np.ndarray) -> bytes:
    """The number of shingles (64 bits) and a bit per class of shingles."""
    bits = max(SKETCH_BITS, 1 << (SHINGLE_BITS * len(u) - 1).bit_length())
    marks = np.zeros(bits, np.uint8)
    marks[(u & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.uint64(len(u)).tobytes() + np.packbits(marks).tobytes()


def most_shared(x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: int) -> np.ndarray:
    """Upper bounds of the shingles that points with the bits in the rows of
    ``x`` share with a point with bits ``y``: the classes in common plus the
    shingles of the one that share a class.  Longer bits are folded to the shorter."""
    words = min(x.shape[1], len(y))
    x, y = np.bitwise_or.reduce(x.reshape(len(x), -1, words), 1), np.bitwise_or.reduce(y.reshape(-1, words), 0)
    count = lambda v: np.bitwise_count(v).sum(-1, dtype=np.int64)
    return count(x & y) + np.minimum(nx - count(x), ny - count(y))


def points(docs: DataFrame, late: tuple[np.ndarray, np.ndarray], size: int) -> DataFrame:
    """(doc_id, key, point, n, window, sketch): a row per document; ``window``
    holds the 32-bit keys of the point's pivots in order, ``sketch`` the number
    of shingles (64 bits) and a bit per class of shingles; both are null where the same task has listed the point."""
    shipped = docs.sparkSession.sparkContext.broadcast(late)

    def run(batches):
        late_h, late_n = shipped.value
        seen: set[int] = set()
        for b in batches:
            ids, ns, wins, sketches = [], [], [], []
            for u in point_sets(b.column("_text"), size):
                n = len(u)
                ns.append(n)
                sketches.append(None)
                if not n:
                    ids.append(None)
                    wins.append(None)
                    continue
                p = set_hash(u)
                ids.append(p)
                if p in seen:
                    wins.append(None)
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(p)
                if len(late_h):
                    at = np.searchsorted(late_h, u)
                    at[at == len(late_h)] = 0
                    is_late = late_h[at] == u
                    if is_late.any():
                        rest = u[is_late]
                        u = np.concatenate([u[~is_late], rest[np.lexsort((rest, late_n[at[is_late]]))]])
                sketches[-1] = sketch_of(u)
                w = u[:window_length(n)]
                w = (w ^ (w >> np.uint64(32))).astype(np.uint32).view(np.int32)
                wins.append(w[np.sort(np.unique(w, return_index=True)[1])])     # of clashing keys the first
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("key"), pa.array(ids, pa.int64()), pa.array(ns, pa.int32()), pa.array(wins, pa.list_(pa.int32())),
                 pa.array(sketches, pa.binary())], ["doc_id", "key", "point", "n", "window", "sketch"])
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), whole().alias("_text"))
    return src.mapInArrow(run, "doc_id long, key long, point long, n int, window array<int>, sketch binary")


def possible(x: dict[str, Column], y: dict[str, Column]) -> Column:
    """Sizes and places allow a link whose first shared shingle is this region's."""
    need = F.ceil((x["n"] + y["n"]) * F.lit(NUM) / F.lit(float(NUM + DEN)) - 1e-9)
    return ((x["n"] * DEN >= y["n"] * NUM) & (y["n"] * DEN >= x["n"] * NUM)
            & (F.least(x["n"] - x["i"], y["n"] - y["i"]) >= need))


def fields(c: Column) -> dict[str, Column]:
    return {k: c[k] for k in ("point", "n", "i")}


def row() -> dict[str, Column]:
    return {k: F.col(k) for k in ("point", "n", "i")}


def regions(pts: DataFrame) -> DataFrame:
    """(region, point, n, i, size, first, others): members of regions with at
    least two points.  ``first`` is the region's first pivot; in regions of up
    to ``SMALL`` points ``others`` lists the points before this one that it
    may link to.  One shuffle by region serves all of it."""
    m = pts.where(F.col("window").isNotNull()).select("point", "n", F.posexplode("window").alias("i", "region"))
    w = Window.partitionBy("region").orderBy("point")
    m = m.withColumn("_after", F.lead("point").over(w)).where(F.col("_after").isNull() | (F.col("_after") != F.col("point")))
    me = F.struct("point", "n", "i")
    m = m.select("region", "point", "n", "i", F.row_number().over(w).alias("_rn"), F.col("_after").isNotNull().alias("_more"),
                 F.first(me).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("first"))
    m = m.where((F.col("_rn") > 1) | F.col("_more"))
    m = m.withColumn("size", F.max("_rn").over(Window.partitionBy("region")))
    before = F.collect_list(F.when(F.col("size") <= SMALL, me)).over(w.rowsBetween(1 - SMALL, -1))
    others = F.transform(F.filter(before, lambda p: possible(fields(p), row())), lambda p: p["point"])
    return m.select("region", "point", "n", "i", "size", "first", others.alias("others"))


def lists_of(lists: DataFrame) -> DataFrame:
    """(point, n, others), a row per point, from (point, n, others): a point's
    lists come together (at most as long as its window times the list bound),
    so a point that it meets in many regions is listed once."""
    return lists.where(F.size("others") > 0).groupBy("point").agg(F.first("n").alias("n"), F.array_distinct(F.flatten(F.collect_list("others"))).alias("others"))


# ---------------------------------------------------------------- values of points

def by_point(df: DataFrame, name: str) -> DataFrame:
    """``stage`` for rows that several steps join by point: stored in buckets of
    points, so those joins do not move them again.  The table's name goes at
    once, the files in the shared folder stay."""
    spark = df.sparkSession
    path, n = shared_path(spark, name), int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"by_point_{path[-32:]}"
    df.repartition(n, "point").write.bucketBy(n, "point").option("path", path).saveAsTable(table)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out


def with_values(rows: DataFrame, values: list[DataFrame]) -> DataFrame:
    """``rows`` joined by point with the tables of values, which share no point."""
    return functools.reduce(DataFrame.unionByName, [rows.join(v, "point") for v in values])


# ---------------------------------------------------------------- slots of comparisons

def slots(lists: DataFrame, name: str) -> DataFrame:
    """(slot, point, others, listed), a row for each point of a slot: points that
    share the first point of their lists come together, dealt by hash so that a
    slot has bounded numbers of points, shingles and list entries (about), and
    with them the points that they list (``listed``; ``others`` is null unless
    such a point has its own list there too).  What a slot lists is made
    distinct as one array, so no step has a row for each pair."""
    m = stage(lists.select("point", "n", "others", F.array_min("others").alias("_g")), f"lists-{name}")
    many = m.groupBy("_g").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_SHINGLES, F.sum(F.size("others")) / LISTED)).alias("_k"))
    slot = F.xxhash64("_g", F.pmod(F.xxhash64("point"), F.col("_k")))
    m = stage(m.join(many, "_g").select(slot.alias("slot"), "point", "others"), f"dealt-{name}")
    all_listed = stage(m.groupBy("slot").agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("_l")), f"listed-{name}")
    # a slot that lists too many is cut into parts of them, each with the lists' share
    part = F.xxhash64("slot", "_p")
    parts = F.ceil(F.size("_l") / BLOCK_LISTED).cast("int")
    share = lambda p: F.slice("_l", p * BLOCK_LISTED + 1, BLOCK_LISTED)
    listed = (all_listed.select("slot", "_l", F.explode(F.sequence(F.lit(0), parts - 1)).alias("_p"))
              .select(part.alias("slot"), F.explode(share(F.col("_p"))).alias("point"), F.lit(None).cast("array<bigint>").alias("others"), F.lit(True).alias("listed")))
    cut = all_listed.where(parts > 1)
    own = (m.join(cut, "slot", "left").select("slot", "point", "others", "_l", F.explode(F.sequence(F.lit(0), F.coalesce(parts, F.lit(1)) - 1)).alias("_p"))
           .select(part.alias("slot"), "point", F.when(F.col("_l").isNull(), F.col("others")).otherwise(F.array_intersect("others", share(F.col("_p")))).alias("others"),
                   F.lit(False).alias("listed")).where(F.size("others") > 0))
    return stage(listed.unionByName(own).groupBy("slot", "point").agg(F.first("others", ignorenulls=True).alias("others"), F.max("listed").alias("listed")), f"slots-{name}")


def side_by_side(lists: DataFrame, values: DataFrame | list[DataFrame], name: str) -> DataFrame:
    """(slot, point, others, listed, v) in order of slots, from lists or their
    slots: first the listed points of a slot, then the others.  A value (point,
    v) moves once for each slot with the point, not for every pair."""
    here = lists if "slot" in lists.columns else slots(lists, name)
    values = values if isinstance(values, list) else [values]
    return with_values(here, values).select("slot", "point", "others", "listed", "v").repartition("slot").sortWithinPartitions("slot", F.desc("listed"))


def by_slot(batches, made):
    """(point, others, value, values) of the points with lists in sorted slots;
    ``values`` holds what ``made`` has made of the listed points of the slot."""
    slot, known, waiting = None, {}, []
    for b in batches:
        for lo in range(0, b.num_rows, 1024):
            c = b.slice(lo, 1024)
            rows = zip(*(c.column(x).to_pylist() for x in ("slot", "point", "others", "listed")), strict=True)
            for k, (at, point, others, listed) in enumerate(rows):
                if waiting and (at != slot or not listed):          # all listed points are there
                    yield from ((p, o, known[p], known) for p, o in waiting)
                    waiting = []
                if at != slot:
                    slot, known = at, {}
                v = made(c.column("v")[k].as_buffer())
                if listed:
                    known[point] = v
                    if others is not None:
                        waiting.append((point, others))
                else:
                    yield point, others, v, known
    yield from ((p, o, known[p], known) for p, o in waiting)


# ---------------------------------------------------------------- exact distances

def bloom_of(keys: DataFrame) -> np.ndarray:
    """Bit table of fixed size over row keys; at any fill it only lets too many pass."""
    def run(batches):
        for b in batches:
            k = b.column("key").to_numpy().view(np.uint64)
            bits = np.unique(np.concatenate([mix(k), mix(k ^ np.uint64(0x5851F42D4C957F2D))]) % np.uint64(BLOOM_BITS)).astype(np.int64)
            word, at = bits >> 5, bits & 31
            cut = np.flatnonzero(np.diff(word, prepend=-1))
            yield pa.RecordBatch.from_arrays([pa.array(word[cut]), pa.array(np.bitwise_or.reduceat(np.int64(1) << at, cut) if len(cut) else at)], ["w", "b"])
    rows = keys.mapInArrow(run, "w long, b long").groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()   # BLOOM_BITS / 32 rows at most
    table = np.zeros(BLOOM_BITS // 32, np.uint32)
    table[rows.column("w").to_numpy()] = rows.column("b").to_numpy().astype(np.uint32)
    return table


def sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(point, s): the sets of wanted (key, point), 6 bytes a shingle, sorted.
    Texts that the bit table rules out are not taken apart."""
    shipped = docs.sparkSession.sparkContext.broadcast(bloom_of(wanted.select("key")))

    def run(batches):
        table = shipped.value
        for b in batches:
            k = b.column("key").to_numpy().view(np.uint64)
            hit = np.ones(len(k), bool)
            for x in (mix(k), mix(k ^ np.uint64(0x5851F42D4C957F2D))):
                at = x % np.uint64(BLOOM_BITS)
                hit &= (table[at >> np.uint64(5)] >> (at & np.uint64(31)).astype(np.uint32) & np.uint32(1)).astype(bool)
            b = b.filter(pa.array(hit))
            for lo in range(0, b.num_rows, 256):
                c = b.slice(lo, 256)
                got = list(point_sets(c.column("_text"), size))
                packed = [np.ascontiguousarray(u.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes() for u in got]
                yield pa.RecordBatch.from_arrays([pa.array([set_hash(u) for u in got], pa.int64()), pa.array(packed, pa.binary())], ["point", "s"])
    src = docs.select(row_key().alias("key"), whole().alias("_text"))
    # the task that makes a set names its point, so the sets move once, by point
    return src.mapInArrow(run, "point long, s binary").join(wanted.select("point"), "point", "left_semi").dropDuplicates(["point"])


def plausible(lists: DataFrame, sketches: DataFrame, name: str) -> DataFrame:
    """The lists without the points whose bit sketches rule a link out."""
    def run(batches):
        def made(raw):
            v = np.frombuffer(raw, np.uint64)
            return v[1:], int(v[0])
        out = []
        for point, others, (y, ny), known in by_slot(batches, made):
            by_size: dict[int, list[int]] = {}
            for o in others:
                by_size.setdefault(len(known[o][0]), []).append(o)
            kept = []
            for same in by_size.values():
                x, nx = (np.array(z) for z in zip(*(known[o] for o in same), strict=True))
                most = most_shared(x, nx, y, ny)
                kept += [same[k] for k in np.flatnonzero(DEN * most >= NUM * (nx + ny - most))]
            if kept:
                out.append((point, ny, kept))
            if len(out) >= 1024:
                yield lists_batch(out)
                out = []
        if out:
            yield lists_batch(out)
    return side_by_side(lists, sketches, name).mapInArrow(run, "point long, n int, others array<bigint>")


def lists_batch(rows: list[tuple]) -> pa.RecordBatch:
    point, n, others = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(point, pa.int64()), pa.array(n, pa.int32()), pa.array(others, pa.list_(pa.int64()))], ["point", "n", "others"])


def unpack(raw) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    out = np.zeros((len(b), 8), np.uint8)
    out[:, :6] = b
    return np.sort(out.view("<u8")[:, 0])


def distances(lists: DataFrame, sets: DataFrame | list[DataFrame], name: str) -> DataFrame:
    """(a, b, dist, linked) of every point b and point a of its list."""
    def run(batches):
        def batch(a, b, inter, total):
            i, u = np.array(inter, np.int64), np.array(total, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(1 - i / np.maximum(u, 1)), pa.array(DEN * i >= NUM * u)],
                                              ["a", "b", "dist", "linked"])
        a, b, inter, total = [], [], [], []
        for point, others, y, known in by_slot(batches, unpack):
            for o in others:
                n = len(np.intersect1d(known[o], y, assume_unique=True))
                a.append(o)
                b.append(point)
                inter.append(n)
                total.append(len(known[o]) + len(y) - n)
            if len(a) >= 4096:
                yield batch(a, b, inter, total)
                a, b, inter, total = [], [], [], []
        if a:
            yield batch(a, b, inter, total)
    return side_by_side(lists, [s.withColumnRenamed("s", "v") for s in (sets if isinstance(sets, list) else [sets])], name).mapInArrow(run, "a long, b long, dist double, linked boolean")


# ---------------------------------------------------------------- components

def connect(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (u, v): comp is the same within a
    connected component and differs between them.

    Each round every node joins its smallest neighbour and edges are redrawn
    between what is left; at least every second node with an edge goes.
    """
    e = stage(edges.where("u <> v").select("u", "v").distinct(), "edges")
    maps = []
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        to = stage(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("comp")), "hooks")
        maps.append(to)
        e = stage(e.join(to.select(F.col("node").alias("u"), F.col("comp").alias("cu")), "u")
                  .join(to.select(F.col("node").alias("v"), F.col("comp").alias("cv")), "v")
                  .where("cu <> cv").select(F.least("cu", "cv").alias("u"), F.greatest("cu", "cv").alias("v")).distinct(), "edges")
    if not maps:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).limit(0)
    out = maps[0]
    for m in maps[1:]:
        out = stage(out.join(m.select(F.col("node").alias("comp"), F.col("comp").alias("_c")), "comp", "left")
                    .select("node", F.coalesce("_c", "comp").alias("comp")), "comps")
    return out


def linked_points(docs: DataFrame, pts: DataFrame, size: int, rounds: list | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """(node, comp) of all points with a link to another point, and tables
    (point, s) with the sets of these points among others (none: no point was compared)."""
    spark = docs.sparkSession
    reg = stage(regions(pts), "regions")
    listed = pts.where(F.col("window").isNotNull())
    reps = listed.groupBy("point").agg(F.min("key").alias("key"))
    hot = reg.where(F.col("size") > SMALL)
    # small regions whole; in a hot region each point meets the pivot of its first hot region
    home = Window.partitionBy("point").orderBy("i")
    star = (hot.withColumn("_k", F.row_number().over(home)).where("_k = 1 and first.point <> point")
            .where(possible(fields(F.col("first")), row())).select("point", "n", F.array("first.point").alias("others")))
    here = slots(lists_of(reg.where(F.col("size") <= SMALL).select("point", "n", "others").unionByName(star)), "bits-0")
    # sketches of the points that can still be asked for, moved once
    sketches = listed.select("point", F.col("sketch").alias("v"))
    sketches = by_point(sketches.join(here.select("point").union(hot.select("point")).distinct(), "point", "left_semi").dropDuplicates(["point"]), "sketches")
    reg = hot.select("region", "point", "n", "i", F.lit(False).alias("done"))
    sets, checked = [], None
    comps = spark.createDataFrame([], "node long, comp long")
    k = 0
    while True:
        lists = stage(plausible(here, sketches, f"bits-{k}"), f"plausible-{k}")
        here = slots(lists, f"sets-{k}")
        asked = here.select("point").distinct()
        wanted = asked
        for s in sets:
            wanted = wanted.join(s.select("point"), "point", "left_anti")
        wanted = stage(wanted.join(reps, "point"), f"wanted-{k}")
        if not wanted.isEmpty():
            sets.append(by_point(sets_of(docs, wanted, size), f"sets-{k}"))
        if not lists.isEmpty():
            found = stage(distances(here, sets, f"sets-{k}"), f"distances-{k}")
            checked = found if checked is None else checked.unionByName(found)
            comps = connect(checked.where("linked").select(F.col("a").alias("u"), F.col("b").alias("v")))
        # Voronoi cell: nearest pivot so far, in either role
        near = spark.createDataFrame([], "point long, near struct<dist:double,a:bigint>") if checked is None else (
            checked.select("a", "b", "dist").unionByName(checked.select(F.col("b").alias("a"), F.col("a").alias("b"), "dist"))
            .groupBy(F.col("b").alias("point")).agg(F.min(F.struct("dist", "a")).alias("near")))
        most_pivots = PIVOTS[min(k, len(PIVOTS) - 1)]
        m = stage(open_regions(reg, comps, near, most_pivots), f"open-{k}")
        if rounds is not None:
            rounds.append({"pairs": lists.select(F.explode("others")).count(), "open": m.count(), "pivots": m.where("turn").count()})
        if m.isEmpty():
            return comps, sets
        lists = lists_of(m.select("point", "n", "others"))
        if checked is not None:            # a row per point on both sides, never one per pair
            known = checked.groupBy(F.col("b").alias("point")).agg(F.collect_set("a").alias("_known"))
            rest = F.array_except("others", F.coalesce("_known", F.array().cast("array<bigint>")))
            lists = lists.join(known, "point", "left").select("point", "n", rest.alias("others")).where(F.size("others") > 0)
        here = slots(lists, f"bits-{k + 1}")
        reg = m.select("region", "point", "n", "i", (F.col("done") | F.col("turn")).alias("done"))
        k += 1


def open_regions(reg: DataFrame, comps: DataFrame, near: DataFrame, most: int) -> DataFrame:
    """Members of regions where some point still has to be a pivot: it is of
    another component than most of the region and has not been one.  ``turn``
    marks up to ``most`` of them, ``others`` the turning pivots that a member
    may link to.  One shuffle by region."""
    m = (reg.join(comps.withColumnRenamed("node", "point"), "point", "left").join(near, "point", "left")
         .withColumn("comp", F.coalesce("comp", "point")).repartition("region"))
    whole_region = Window.partitionBy("region")
    m = m.withColumn("_c", F.count(F.lit(1)).over(Window.partitionBy("region", "comp")))
    m = m.withColumn("_most", F.max(F.struct("_c", "comp")).over(whole_region)["comp"])
    m = m.withColumn("_due", ~F.col("done") & (F.col("comp") != F.col("_most")))
    m = m.withColumn("_any", F.max("_due").over(whole_region)).where("_any")
    m = m.withColumn("turn", F.col("_due") & (F.row_number().over(whole_region.orderBy(F.desc("_due"), "point")) <= most))
    pivots = F.collect_list(F.when(F.col("turn"), F.struct("point", "n", "i", "comp", "near"))).over(whole_region)
    r = 1 - NUM / DEN + 1e-9

    def meets(p: Column) -> Column:
        # triangle inequality inside a Voronoi cell: distances to its pivot differ by more than r
        out = F.coalesce((p["near"]["a"] == F.col("near.a")) & (F.abs(p["near"]["dist"] - F.col("near.dist")) > r), F.lit(False))
        once = ~F.col("turn") | (p["point"] < F.col("point"))          # two turning pivots: in the list of one
        return once & (p["comp"] != F.col("comp")) & possible(fields(p), row()) & ~out
    others = F.transform(F.filter(pivots, meets), lambda p: p["point"])
    return m.select("region", "point", "n", "i", "done", "turn", others.alias("others"))


# ---------------------------------------------------------------- links

def block_pairs(pts: DataFrame, comps: DataFrame, sets: list[DataFrame]) -> DataFrame:
    """(comp, i, j, b, point, docs, s): the points of block ``b`` of a component,
    once for each block they meet; i and j <= i are the two blocks."""
    docs = pts.where(F.col("point").isNotNull()).groupBy("point").agg(F.count(F.lit(1)).alias("docs"), F.first("n").alias("n"))
    m = stage(comps.withColumnRenamed("node", "point").join(docs, "point"), "members")
    many = m.groupBy("comp").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("_k"))
    m = with_values(m.join(many, "comp").withColumn("b", F.pmod(F.xxhash64("point"), F.col("_k")).cast("int")), sets)
    m = m.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    return m.select("comp", F.greatest("b", "_o").alias("i"), F.least("b", "_o").alias("j"), "b", "point", "docs", "s")


def overlaps(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of ``x`` with every set of ``y``."""
    hx, hy = np.concatenate(x), np.concatenate(y)
    shared = np.intersect1d(hx, hy)

    def places(sets, h):
        row = np.repeat(np.arange(len(sets)), [len(u) for u in sets])
        at = np.minimum(np.searchsorted(shared, h), max(0, len(shared) - 1))
        hit = np.flatnonzero(shared[at] == h) if len(shared) else np.zeros(0, int)
        hit = hit[np.argsort(at[hit], kind="stable")]
        return row[hit], at[hit]
    (rx, cx), (ry, cy) = places(x, hx), places(y, hy)
    out = np.zeros((len(x), len(y)), np.int64)
    for lo in range(0, len(shared), COLUMNS):
        part = []
        for n, r, c in ((len(x), rx, cx), (len(y), ry, cy)):
            p, q = np.searchsorted(c, [lo, lo + COLUMNS])
            one = np.zeros((n, min(COLUMNS, len(shared) - lo)), np.float32)
            one[r[p:q], c[p:q] - lo] = 1
            part.append(one)
        out += (part[0] @ part[1].T).astype(np.int64)
    return out


def compared(t: pa.Table):
    """Points of two blocks (or of one and itself): their places in ``t``, and
    which link and their similarity."""
    i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
    b = t.column("b").to_numpy()
    x, y = np.flatnonzero(b == i), np.flatnonzero(b == j)
    if not len(x) or not len(y):
        return x, y, np.zeros((len(x), len(y)), bool), np.zeros((len(x), len(y)))
    u = [unpack(v.as_buffer()) for v in t.column("s")]
    n = np.array([len(v) for v in u])
    inter = overlaps([u[k] for k in x], [u[k] for k in y])
    total = n[x][:, None] + n[y][None, :] - inter
    linked = NUM * total <= DEN * inter
    if i == j:
        np.fill_diagonal(linked, False)
    return x, y, linked, inter / total


def link_counts(pts: DataFrame, comps: DataFrame, sets: list[DataFrame]) -> DataFrame:
    """(point, links): the number of documents of other classes that link to a point."""
    def run(t: pa.Table) -> pa.Table:
        x, y, linked, _ = compared(t)
        point, docs = t.column("point").to_numpy(), t.column("docs").to_numpy()
        at, links = [x], [linked @ docs[y]]
        if t.column("i")[0] != t.column("j")[0]:
            at.append(y)
            links.append(docs[x] @ linked)
        return pa.table({"point": pa.array(point[np.concatenate(at)], pa.int64()), "links": pa.array(np.concatenate(links), pa.int64())})
    found = block_pairs(pts, comps, sets).groupBy("comp", "i", "j").applyInArrow(run, "point long, links long")
    return found.groupBy("point").agg(F.sum("links").alias("links"))


def analysed(docs: DataFrame, size: int, rounds: list | None = None) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """The points of all rows, (node, comp), and the sets of the points in it."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    late = stage(frequent(docs, size), "frequent").toArrow()                      # at most LATE rows
    h, n = late.column("h").to_numpy().view(np.uint64), late.column("n").to_numpy()
    order = np.argsort(h)
    pts = stage(points(docs, (h[order], n[order]), size), "points")
    return pts, *linked_points(docs, pts, size, rounds)


def labelled(pts: DataFrame, comps: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """(doc_id, key, n_shingles, component_id, group) of every row, and n_links if ``links`` are given."""
    # per point its smallest id; then per component; hot classes send one row per task
    least = pts.where(F.col("point").isNotNull()).groupBy("point").agg(F.min("doc_id").alias("_least"), F.count(F.lit(1)).alias("_c"))
    by_point = least.join(comps.withColumnRenamed("node", "point"), "point", "left").withColumn("comp", F.coalesce("comp", "point"))
    by_comp = by_point.groupBy("comp").agg(F.min("_least").alias("component_id"), F.sum("_c").alias("_docs"))
    shared = by_point.join(by_comp.where("_docs > 1"), "comp")
    cols = ["point", "comp", "component_id"]
    if links is not None:
        shared = shared.join(links, "point", "left").withColumn("n_links", F.col("_c") - 1 + F.coalesce("links", F.lit(0)))
        cols.append("n_links")
    j = pts.join(stage(shared.select(*cols), "shared"), "point", "left")
    return j.select("doc_id", "key", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
                    F.coalesce("comp", "key").alias("group"), *([F.coalesce("n_links", F.lit(0)).alias("n_links")] if links is not None else []))


def components(docs: DataFrame, size: int = SHINGLE, rounds: list | None = None) -> DataFrame:
    """(doc_id, key, n_shingles, component_id, group) of every row; ``group`` is
    the same within a component of several rows and differs between all others."""
    pts, comps, _ = analysed(docs, size, rounds)
    return labelled(pts, comps)


def joined(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``components`` with ``n_links``: how many other rows a row links to."""
    pts, comps, sets = analysed(docs, size)
    links = docs.sparkSession.createDataFrame([], "point long, links long") if not sets else stage(link_counts(pts, comps, sets), "links")
    return labelled(pts, comps, links)


def link_pairs(docs: DataFrame, size: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """(a, b, similarity), a < b, of all linked pairs of classes; and (doc_id,
    key, point), the class of every row with words. Rows of one class are equal
    sets, which link as well and are not listed as pairs."""
    pts, comps, sets = analysed(docs, size)
    members = pts.where(F.col("point").isNotNull()).select("doc_id", "key", "point")

    def run(t: pa.Table) -> pa.Table:
        x, y, linked, sim = compared(t)
        point = t.column("point").to_numpy()
        p, q = np.nonzero(linked)
        a, b = point[x[p]], point[y[q]]
        once = (a < b) | (t.column("i")[0] != t.column("j")[0])
        return pa.table({"a": np.minimum(a, b)[once], "b": np.maximum(a, b)[once], "similarity": sim[p, q][once]})
    if not sets:
        return docs.sparkSession.createDataFrame([], "a long, b long, similarity double"), members
    return block_pairs(pts, comps, sets).groupBy("comp", "i", "j").applyInArrow(run, "a long, b long, similarity double"), members


def keep_one(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """The columns of ``docs``, one row of each component: the smallest doc_id
    (null last; equal ids: the smallest row key; rows equal in id and text are
    one row), and every row without words: it is linked with nothing."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("d"), F.col("key").alias("k")))
    keep = stage(components(docs, size).groupBy("group").agg(first.alias("f")).select(F.col("f.k").alias("_k")), "kept")
    worded = F.btrim(whole(), F.lit(SPACES)) != ""
    kept = docs.where(worded).withColumn("_k", row_key()).join(keep, "_k", "left_semi").dropDuplicates(["_k"]).select(*docs.columns)
    return kept.unionByName(docs.where(~worded))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(documents(spark, sf_dir, "doc_id", "text")).select("doc_id", "n_shingles", "component_id", "n_links")
