"""Segmentation and chunking (TXT-6..TXT-12, TXT-15, TXT-16, GEN-1).

Chunkers work row by row with higher-order SQL functions, so a document is
cut on the task that read it: no shuffle, no Python worker.  Chunk rows are
produced with ``posexplode`` (null and empty arrays give no row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from docsift.functions import text as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- units

CUT_T = "struct<a:int,b:int>"


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is read."""
    return F.element_at(F.transform(F.array(value), use), 1)


def between(array: Column, a: Column, b: Column) -> Column:
    """Elements a..b-1 (0-based, a < b), read one by one: cost b - a, not the array's length."""
    return F.transform(F.sequence(a, b - 1), lambda i: F.get(array, i))


def sentence_units(col, size: int) -> Column:
    """Sentences as ``array<struct<s:string,t:int>>`` (text, token count).

    A sentence of more than ``size`` tokens is cut into pieces of ``size``
    tokens (joined by one space); a sentence without any token is dropped.
    Linear in the text: tokens are counted, and listed only for a sentence
    that has to be cut.
    """
    counted = F.transform(T.sentences(col), lambda u: F.struct(u.alias("s"), F.regexp_count(u, F.lit(T.TOKEN_PATTERN)).alias("t")))

    def pieces(x):
        parts = F.sequence(F.lit(0), F.floor((x["t"] - 1) / size).cast("int"))
        return let(T.tokens(x["s"]), lambda k: F.transform(parts, lambda i: F.struct(
            F.array_join(between(k, i * size, F.least((i + 1) * size, x["t"])), " ").alias("s"),
            F.least(F.lit(size), x["t"] - i * size).alias("t"))))

    return F.flatten(F.transform(F.filter(counted, lambda x: x["t"] > 0),
                                 lambda x: F.when(x["t"] <= size, F.array(x)).otherwise(pieces(x))))


def sentence_cuts(counts: Column, size: int, overlap: int) -> Column:
    """Greedy left-to-right packing of units with these token
    counts: ``array<struct<a,b>>``, each chunk the units a..b-1.

    When the next unit would push a non-empty chunk over ``size`` the chunk
    ends and the next one starts with the longest suffix of its units holding
    <= ``overlap`` tokens, provided suffix + unit still fit.  The fold keeps
    positions and sums only; a unit has a token at least, so a suffix is
    found within ``overlap`` steps.
    """
    init = F.struct(F.array().cast(f"array<{CUT_T}>").alias("out"), F.lit(0).alias("a"), F.lit(0).alias("n"), F.lit(0).alias("i"))

    def suffix(acc, t):
        """(units, tokens) of the end of the chunk that the next one repeats."""
        none = F.struct(F.lit(0).alias("c"), F.lit(0).alias("s"))
        if overlap <= 0:
            return none
        back = F.sequence(acc["i"] - 1, F.greatest(acc["a"], acc["i"] - overlap), F.lit(-1))
        # tokens of the last 1, 2, ... units; the first sum above the overlap ends the walk
        walk = F.aggregate(back, F.struct(F.lit(0).alias("c"), F.lit(0).alias("s"), F.lit(True).alias("go")), lambda w, j: F.when(
            w["go"] & (w["s"] + F.get(counts, j) <= overlap),
            F.struct((w["c"] + 1).alias("c"), (w["s"] + F.get(counts, j)).alias("s"), F.lit(True).alias("go"))
        ).otherwise(F.struct(w["c"].alias("c"), w["s"].alias("s"), F.lit(False).alias("go"))),
            lambda w: F.struct(w["c"].alias("c"), w["s"].alias("s")))
        return let(walk, lambda w: F.when(w["s"] + t <= size, w).otherwise(none))

    def step(acc, t):
        cut = let(suffix(acc, t), lambda w: F.struct(
            F.concat(acc["out"], F.array(F.struct(acc["a"].alias("a"), acc["i"].alias("b")))).alias("out"),
            (acc["i"] - w["c"]).alias("a"), (w["s"] + t).alias("n"), (acc["i"] + 1).alias("i")))
        return F.when((acc["n"] > 0) & (acc["n"] + t > size), cut).otherwise(
            F.struct(acc["out"].alias("out"), acc["a"].alias("a"), (acc["n"] + t).alias("n"), (acc["i"] + 1).alias("i")))

    return F.aggregate(counts, init, step, _last_cut)


def _last_cut(acc):
    return F.when(acc["n"] > 0, F.concat(acc["out"], F.array(F.struct(acc["a"].alias("a"), acc["i"].alias("b"))))).otherwise(acc["out"])


def cut_texts(units: Column, cuts: Column) -> Column:
    """The text of every cut: its units, end to end."""
    return F.transform(cuts, lambda p: F.array_join(F.transform(between(units, p["a"], p["b"]), lambda u: u["s"]), ""))


# ---------------------------------------------------------------- chunkers

def chunk_sentences_col(col, size: int = 500, overlap: int = 50) -> Column:
    """Sentence chunker as a column expression -> ``array<string>``."""
    return let(sentence_units(col, size), lambda u: let(F.transform(u, lambda x: x["t"]),
               lambda t: cut_texts(u, sentence_cuts(t, size, overlap))))


def chunk_window_col(col, size: int = 200, overlap: int = 20, tokens_col=None) -> Column:
    """Fixed windows of ``size`` tokens starting every ``size - overlap`` tokens.

    Pass ``tokens_col`` (a column already holding ``tokens(col)``) to avoid
    re-tokenising the text inside the per-window lambda; ``chunk_window``
    does so.
    """
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")
    toks = _c(tokens_col) if tokens_col is not None else T.tokens(col)
    n = F.size(toks)
    step = size - overlap
    starts = F.sequence(F.lit(0), F.greatest(n - overlap - 1, F.lit(0)), F.lit(step))
    return F.when(n > 0, F.transform(starts, lambda i: F.array_join(F.slice(toks, i + 1, size), " "))) \
            .otherwise(F.array().cast("array<string>"))


def explode_chunks(df: DataFrame, chunks: Column, keep: list[str],
                   no_col: str = "chunk_no", out_col: str = "content") -> DataFrame:
    """GEN-1: one row per array element with its 0-based position."""
    return df.select(*keep, F.posexplode(chunks).alias(no_col, out_col))


def chunk_sentences(df: DataFrame, text_col: str = "text", keep=("path",), size: int = 500, overlap: int = 50) -> DataFrame:
    """TXT-6 rows ``keep..., chunk_no, content``; evaluated where the row is read, linear in its text."""
    return explode_chunks(df, chunk_sentences_col(text_col, size, overlap), list(keep))


def chunk_window(df: DataFrame, text_col: str = "text", keep=("path",),
                 size: int = 200, overlap: int = 20) -> DataFrame:
    # tokens once per row, then every window slices that column
    t = df.select(*keep, T.tokens(text_col).alias("_toks"))
    return explode_chunks(t, chunk_window_col(None, size, overlap, tokens_col="_toks"), list(keep))


def chunk_whole(df: DataFrame, text_col: str = "text", keep=("path",)) -> DataFrame:
    """TXT-8: one chunk per document (blank documents give none)."""
    return (df.filter(F.col(text_col).isNotNull() & (F.trim(F.col(text_col)) != ""))
              .select(*keep, F.lit(0).alias("chunk_no"), F.col(text_col).alias("content")))


def split_sentences(df: DataFrame, text_col: str = "text", keep=("doc_id",)) -> DataFrame:
    """TXT-9: one row per sentence unit."""
    return explode_chunks(df, T.sentences(text_col), list(keep), "sent_no", "sentence")


def split_paragraphs(df: DataFrame, text_col: str = "text", keep=("doc_id",)) -> DataFrame:
    """TXT-10: one row per non-blank paragraph."""
    return explode_chunks(df, T.paragraphs(text_col), list(keep), "para_no", "paragraph")


def split_headings(df: DataFrame, html_col: str = "html", keep=("page_id",)) -> DataFrame:
    """TXT-11: one row per heading-led section of an HTML page."""
    return explode_chunks(df, T.heading_sections(html_col), list(keep), "section_no", "section")


def chunk_key(*cols) -> Column:
    """SNK-3 content id: stable on replay, needs no coordination."""
    return F.xxhash64(*[_c(c) for c in cols])


# ---------------------------------------------------------------- reports

def profile_chunks(chunks: DataFrame, by: str = "path", content: str = "content",
                   limit: int = 500) -> DataFrame:
    """TXT-16: per-document chunk statistics, flags chunks over ``limit`` tokens."""
    c = chunks.select(by, T.token_count(content).alias("_t"))   # count tokens once per chunk
    t = F.col("_t")
    return (c.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.min(t).alias("min_tokens"),
        F.max(t).alias("max_tokens"),
        F.round(F.avg(t), 6).alias("avg_tokens"),
        F.sum(F.when(t > limit, 1).otherwise(0)).alias("n_over_limit"),
    ))


# ---------------------------------------------------------------- semantic / topic

def chunk_semantic_col(col, threshold: float = 0.1, size: int = 500) -> Column:
    """TXT-13: cut between adjacent units whose term sets are dissimilar.

    A unit's embedding is its binary bag of terms; similarity with the
    previous unit is |A n B| / sqrt(|A| |B|) (0 when either is empty).  A new
    chunk starts where similarity < ``threshold`` or where the chunk would
    exceed ``size`` tokens; units are the sentence pieces of ``sentence_units``,
    so no chunk is longer than ``size``.  Row-wise: no window, no shuffle; the
    fold keeps positions only, so it is linear in the text.
    """
    with_terms = F.transform(sentence_units(col, size),
                             lambda u: F.struct(u["s"].alias("s"), u["t"].alias("t"), F.array_distinct(T.terms(u["s"])).alias("tt")))

    def cuts(units):
        init = F.struct(F.array().cast(f"array<{CUT_T}>").alias("out"), F.lit(0).alias("a"), F.lit(0).alias("n"), F.lit(0).alias("i"))

        def far(acc, u):
            prev = F.get(units, acc["i"] - 1)["tt"]
            den = F.sqrt((F.size(prev) * F.size(u["tt"])).cast("double"))
            return F.coalesce(F.when(den > 0, F.size(F.array_intersect(prev, u["tt"])) / den), F.lit(0.0)) < threshold

        def step(acc, u):
            cut = (acc["n"] > 0) & ((acc["n"] + u["t"] > size) | far(acc, u))
            return F.when(cut, F.struct(F.concat(acc["out"], F.array(F.struct(acc["a"].alias("a"), acc["i"].alias("b")))).alias("out"),
                                        acc["i"].alias("a"), u["t"].alias("n"), (acc["i"] + 1).alias("i"))) \
                    .otherwise(F.struct(acc["out"].alias("out"), acc["a"].alias("a"), (acc["n"] + u["t"]).alias("n"), (acc["i"] + 1).alias("i")))
        return F.aggregate(units, init, step, _last_cut)

    return let(with_terms, lambda u: cut_texts(u, cuts(u)))


def chunk_semantic(df: DataFrame, text_col: str = "text", keep=("path",), threshold: float = 0.1, size: int = 500) -> DataFrame:
    """TXT-13 rows."""
    return explode_chunks(df, chunk_semantic_col(text_col, threshold, size), list(keep))


def chunk_topics(sentences_df: DataFrame, id_col: str = "doc_id", no_col: str = "sent_no",
                 text_col: str = "sentence", k: int = 8, dims: int = 1 << 14, seed: int = 7,
                 max_iter: int = 10) -> DataFrame:
    """TXT-14: topic segmentation with Spark ML (hashed term counts + LDA).

    Terms are hashed into ``dims`` counters, so every term of the corpus
    counts and no vocabulary is gathered.  Each sentence gets its most likely
    topic; a sentence without terms keeps the topic of the one before it (the
    first ones: of the first that has one; a document without terms: topic
    0).  A chunk is a maximal run of consecutive sentences of one document
    sharing a topic.  Training is distributed; regrouping is per document
    (bounded by its length).  Returns ``id, chunk_no, topic, content``.
    """
    from pyspark.ml.clustering import LDA
    from pyspark.ml.feature import HashingTF
    from docsift.operators.topics import top_topics
    toks = sentences_df.withColumn("_terms", F.coalesce(T.terms(text_col), F.array().cast("array<string>")))
    tf = HashingTF(numFeatures=dims, inputCol="_terms", outputCol="_tf").transform(toks)
    lda = LDA(k=k, seed=seed, maxIter=max_iter, featuresCol="_tf", topicDistributionCol="_topics") \
        .fit(tf.where(F.size("_terms") > 0))
    scored = top_topics(tf, "_tf", lda, "_own", [id_col, no_col, text_col])
    w = Window.partitionBy(id_col).orderBy(no_col)
    scored = scored.withColumn("topic", F.coalesce(
        F.last("_own", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        F.first("_own", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.lit(0)))
    per_doc = scored.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct(F.col(no_col), F.col("topic"), F.col(text_col).alias("s")))).alias("u"))

    def runs(u):
        """One struct per run; positions only until its texts are joined, so linear in the document."""
        first = F.filter(F.sequence(F.lit(0), F.size(u) - 1),
                         lambda i: (i == 0) | (F.get(u, i)["topic"] != F.get(u, F.greatest(i - 1, F.lit(0)))["topic"]))

        def text(a, b):
            return let(F.transform(between(u, a, b), lambda x: x["s"]),
                       lambda p: F.when(F.forall(p, lambda x: x.isNotNull()), F.array_join(p, "")))
        return let(first, lambda f: F.transform(f, lambda a, j: F.struct(
            F.get(u, a)["topic"].alias("topic"), text(a, F.coalesce(F.get(f, j + 1), F.size(u))).alias("content"))))

    chunks = per_doc.select(id_col, F.posexplode(let(F.col("u"), runs)).alias("chunk_no", "c"))
    return chunks.select(id_col, "chunk_no", F.col("c.topic").alias("topic"), F.col("c.content").alias("content"))


def dense_id(df: DataFrame, order_by: list[str], out_col: str = "id", start: int = 1) -> DataFrame:
    """SNK-3 (batch): dense ids ``start..start+n-1`` in ``order_by`` order.

    No single-partition window over the data: rows are range-partitioned
    and sorted by the (unique) key, each partition is counted, offsets are
    a running sum over the per-partition counts (one row per partition,
    broadcast), and an id is offset + position inside the partition.
    """
    from pyspark.sql import Window
    from docsift.session import reuse
    s = (df.repartitionByRange(*[F.col(c) for c in order_by]).sortWithinPartitions(*order_by)
           .withColumn("_pid", F.spark_partition_id())
           .withColumn("_pos", F.monotonically_increasing_id()))
    s = reuse(s)   # read by the counts and the final join; ids must not be recomputed differently
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    j = s.join(F.broadcast(offs.select("_pid", "_off", "_first")), "_pid")
    return j.withColumn(out_col, (F.col("_off") + F.col("_pos") - F.col("_first") + start).cast("long")) \
            .drop("_pid", "_pos", "_off", "_first")
