"""Operator 4: mixing sources to target weights.

Sizes are words per document.  Per source (summed with partial aggregation,
so a hot source sends one row per task) the target is its weighted share of
the total, at most ``cap`` times its size; what a source cannot take is
shared out again by weight until no target is above its limit.  Each round
of that is one aggregation over the table of sources; only three sums reach
the driver.  The rate of a source is target / size, and each of its
documents is taken floor(rate) times, plus once more if a hash of the whole
row, seeded, falls below the fraction.  Equal rows are numbered, and the
number goes into the hash, so each has a draw of its own.

Cases: null or empty text has size 0 and is taken 0 words' worth of times
like any other; null source is a source of its own and ordered last; a
source without words has target 0 and rate 0; rows of one
id (or of none) draw by their other columns, and of equal rows reruns take
the same number; columns with maps are not hashed; an empty table
gives an empty result; further columns are kept by ``mix`` and its own
columns begin with ``mix_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsift.llm.common import WORD_RE, documents, stage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
SEED = 20240229
#: groups that the rows of one key are numbered in
SALTS = 64


def word_count(text: str | Column = "text") -> Column:
    """Number of maximal runs without ASCII white space."""
    c = F.coalesce((F.col(text) if isinstance(text, str) else text).cast("string"), F.lit(""))
    return F.regexp_count(c, F.lit(WORD_RE)).cast("long")


def ranked_sources(sized: DataFrame) -> DataFrame:
    """(source, source_size, rank): ranks from 0 by code point, null last.

    Sources are numbered within ranges of the order; the range of a source is
    found from sampled splits, the numbers before a range from its count, so
    no task holds all sources.
    """
    agg = stage(sized.groupBy("source").agg(F.sum("mix_size").alias("source_size")), "sources")
    in_order = agg.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("_p", F.spark_partition_id())
    in_order = stage(in_order, "sources-in-order")
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)      # one row per range
    offs = in_order.groupBy("_p").agg(F.count(F.lit(1)).alias("_n")) \
        .select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    pos = F.row_number().over(Window.partitionBy("_p").orderBy(F.col("source").asc_nulls_last())) - 1
    return in_order.withColumn("_pos", pos).join(F.broadcast(offs), "_p") \
        .select("source", "source_size", (F.col("_off") + F.col("_pos")).cast("long").alias("rank"))


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Adds ``target`` and ``rate`` to (source, source_size, rank)."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    s = stage(sources.withColumn("_w", w).withColumn("_cap", F.lit(float(cap)) * F.col("source_size")), "weighted")
    total = s.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        # capped: sources whose weighted share at this level is above their limit
        above = F.col("_w") * F.lit(level) > F.col("_cap")
        n, fixed, open_w = s.agg(
            F.count(F.when(above, 1)), F.coalesce(F.sum(F.when(above, F.col("_cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~above, F.col("_w"))), F.lit(0.0))).first()
        if n == capped or not open_w:
            break
        capped, level = n, (share * total - fixed) / open_w
    target = F.least(F.col("_w") * F.lit(level), F.col("_cap"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return s.withColumn("target", target).withColumn("rate", rate).select("source", "source_size", "target", "rate")


def numbered(docs: DataFrame) -> DataFrame:
    """Adds ``mix_key``, a hash of the row, and ``mix_no``: 0, or 1, 2, ... among
    equal rows.  Only repeated rows move; salts are stored before they are
    counted, and which of equal rows has which number does not matter."""
    cols = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and not c.startswith("mix_")]
    d = docs.withColumn("mix_key", F.xxhash64(*cols, *[c.isNull() for c in cols]))
    again = stage(d.groupBy("mix_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("mix_key"), "repeated")
    if again.isEmpty():
        return d.withColumn("mix_no", F.lit(0).cast("long"))
    rows = stage(d.join(again, "mix_key", "left_semi").withColumn("_salt", F.floor(F.rand(SEED) * SALTS).cast("int")), "repeated-rows")
    before = Window.partitionBy("mix_key").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)    # SALTS rows at most
    offs = rows.groupBy("mix_key", "_salt").agg(F.count(F.lit(1)).alias("_n")) \
        .select("mix_key", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    place = F.row_number().over(Window.partitionBy("mix_key", "_salt").orderBy("mix_key"))
    more = rows.withColumn("_place", place).join(offs, ["mix_key", "_salt"]).withColumn("mix_no", (F.col("_off") + F.col("_place")).cast("long"))
    once = d.join(again, "mix_key", "left_anti").withColumn("mix_no", F.lit(0).cast("long"))
    return once.unionByName(more.select(*once.columns))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = SEED) -> DataFrame:
    """All rows and columns of ``docs`` with ``mix_size``, ``mix_source_size``,
    ``mix_target`` and ``mix_copies`` (how often the mix takes the row)."""
    sized = numbered(docs).withColumn("mix_size", word_count())
    t = stage(targets(ranked_sources(sized), weights, share, cap), "targets").select(
        F.col("source").alias("_source"), F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"), F.col("rate").alias("_rate"))
    # Spark broadcasts the table of sources if it is small by its measured size; else it splits hot sources (AQE)
    j = sized.join(t, F.col("source").eqNullSafe(F.col("_source")), "left")
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("mix_key"), F.col("mix_no")), 11)
         .cast("double") / F.lit(float(1 << 53)))
    whole = F.floor("_rate")
    copies = (whole + F.when(u < F.col("_rate") - whole, 1).otherwise(0)).cast("int")
    return j.withColumn("mix_copies", copies).drop("_source", "_rate", "mix_key", "mix_no")


def emit(mixed: DataFrame) -> DataFrame:
    """Each row ``mix_copies`` times, with the columns it came with."""
    keep = [c for c in mixed.columns if not c.startswith("mix_")]
    return (mixed.where("mix_copies > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies")))).select(*keep))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mix(documents(spark, sf_dir, "doc_id", "text", "source"))
    return m.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                    F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).cast("long").alias("taken"))
