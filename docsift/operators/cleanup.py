"""Corpus-level cleanup (TXT-15): remove lines repeated across a source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.operators.joins import join_small, salted_join


def source_key(source: Column) -> Column:
    """A source as a join key that a null source equals too."""
    return F.struct(source.isNull().alias("n"), F.coalesce(source.cast("string"), F.lit("")).alias("s"))


def boilerplate_lines(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                      text_col: str = "text", min_docs: int = 3, min_share: float = 0.05) -> DataFrame:
    """(source, line) pairs found in at least ``max(min_docs, min_share x docs of
    the source)`` documents of that source.  Blank lines never count.

    Lines are de-duplicated within each document row, so the per-line count
    is a map-side partial aggregation and a line present in a third of all
    documents does not land on one reducer.
    """
    # distinct non-blank lines per document row: de-duplicated without a shuffle
    uniq = F.array_distinct(F.filter(F.split(text_col, "\n"), lambda l: F.trim(l) != ""))
    lines = docs.select(source_col, F.explode(uniq).alias("line"))
    per_line = lines.groupBy(source_col, "line").agg(F.count(F.lit(1)).alias("n_docs"))
    per_source = docs.groupBy(source_col).agg(F.count(F.lit(1)).alias("source_docs"))
    # a null source is a source like any other
    key = source_key(F.col(source_col))
    j = join_small(per_line.withColumn("_s", key), per_source.select(key.alias("_s"), "source_docs"), ["_s"])
    return (j.filter(F.col("n_docs") >= F.greatest(F.lit(min_docs).cast("double"),
                                                     F.col("source_docs") * F.lit(min_share)))
             .select(source_col, "line"))


def drop_boilerplate_lines(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                           text_col: str = "text", min_docs: int = 3, min_share: float = 0.05,
                           salts: int = 16) -> DataFrame:
    """Rebuild each document without its source's boilerplate lines.

    Returns ``id, source, text, n_removed``; line order and blank lines are
    kept; null text stays null with nothing removed; rows that share an id
    stay apart; documents without a source are one source.

    One plan for all sizes: the corpus sends only (source, line hash, line
    number) to a salted join with the boilerplate lines, so a line found in
    a third of all documents is spread; what comes back per document are the
    numbers of its boilerplate lines, and the text is rebuilt row by row.
    """
    bp = boilerplate_lines(docs, id_col, source_col, text_col, min_docs, min_share)
    # two independent 64-bit hashes stand for a line
    line_key = lambda l: F.struct(F.xxhash64(l).alias("a"), F.xxhash64(F.lit(1), l).alias("b"))
    flag = bp.select(source_key(F.col(source_col)).alias("_s"), line_key(F.col("line")).alias("_l"))
    d = docs.select(id_col, source_col, text_col) \
        .withColumn("_row", F.struct(F.xxhash64(id_col, text_col).alias("a"), F.xxhash64(F.lit(1), id_col, source_col, text_col).alias("b")))
    lines = d.where(F.col(text_col).isNotNull()).select("_row", source_col, F.posexplode(F.split(text_col, "\n")).alias("_no", "line")) \
        .select("_row", source_key(F.col(source_col)).alias("_s"), "_no", line_key(F.col("line")).alias("_l"))
    hit = salted_join(lines, flag, ["_s", "_l"], "inner", salts) \
        .groupBy("_row").agg(F.collect_set("_no").alias("_drop"))          # at most the document's lines
    j = d.join(hit, "_row", "left")
    split = F.split(text_col, "\n")
    flags = F.coalesce("_drop", F.array().cast("array<int>"))
    left = F.when(F.size(flags) == 0, split).otherwise(
        F.transform(F.filter(F.arrays_zip(split.alias("l"), F.sequence(F.lit(0), F.size(split) - 1).alias("i")),
                             lambda x: ~F.array_contains(F.col("_drop"), x["i"])), lambda x: x["l"]))
    return j.select(id_col, source_col, F.when(F.col(text_col).isNotNull(), F.array_join(left, "\n")).alias(text_col),
                    F.size(flags).cast("long").alias("n_removed"))
