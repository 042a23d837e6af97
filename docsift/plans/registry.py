"""Named queries over the driver tables, each with its DuckDB oracle SQL.

Every query reads whole tables (or data Spark derives from them); no id
subsets or row caps.  ``QUERIES[name](spark, sf_dir) -> DataFrame`` and
``ORACLE[name] -> SQL`` share column names and types.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift import prompts as P
from docsift.functions import text as T
from docsift.functions import vectors as V
from docsift.operators import chat as CH
from docsift.operators import chunking as C
from docsift.operators import cleanup as CL
from docsift.operators import embedding as E
from docsift.operators import index as IX
from docsift.operators import lsh as LSH
from docsift.operators import monitor as MO
from docsift.operators import search as S
from docsift.operators import versions as VS
from docsift.plans import ingest
from docsift.plans import sql_fragments as Q
from docsift.session import checkpoint_root, stored
from docsift.sources import web as W

QUERIES: dict = {}
ORACLE: dict = {}

# Fixed parameters of the registered queries.
CHUNK_SIZE, CHUNK_OVERLAP = 500, 50          # sentence chunker (SURVEY §2.4.1)
SMALL_CHUNK = 100                            # no-overlap variant, forces more cuts
WINDOW_SIZE, WINDOW_OVERLAP = 200, 20        # fixed token windows
TRUNCATE_AT = 50
SYNC_CELLS = 16                              # cells of the stored index in sync_index
DIM = 1024                                   # hash-embedding buckets (the reference model has 1024 dims)
CHUNK_KEY = ("doc_id", "chunk_no")            # identity of a chunk


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin only when the scan gives fewer tasks than the cluster has
    cores (a single-row-group file); large inputs keep their scan split."""
    par = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(par) if df.rdd.getNumPartitions() < par else df


def documents(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.withColumn("path", F.concat(F.lit("doc/"), F.col("doc_id").cast("string")))


def sentence_chunks(spark, sf_dir, size=CHUNK_SIZE, overlap=CHUNK_OVERLAP) -> DataFrame:
    d = spread(documents(spark, sf_dir).select("doc_id", "path", "text"))
    return C.chunk_sentences(d, "text", keep=("doc_id", "path"), size=size, overlap=overlap)


DOCS_SQL = "(SELECT *, 'doc/' || doc_id::VARCHAR AS path FROM documents)"


def chunks_sql(size=CHUNK_SIZE, overlap=CHUNK_OVERLAP) -> str:
    return (f"(SELECT doc_id, path, chunk_no, content, {{'doc_id': doc_id, 'chunk_no': chunk_no}} AS chunk_key FROM "
            f"{Q.chunk_rows(DOCS_SQL, 'doc_id, path', 'text', size, overlap)})")


# ------------------------------------------------------------------ TXT

@register("clean_text", f"""
SELECT doc_id, {Q.clean('text')} AS content, length({Q.clean('text')})::INTEGER AS n_chars FROM documents""")
def q_clean_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    c = T.clean_text("text")
    return d.select("doc_id", c.alias("content"), F.length(c).alias("n_chars"))


@register("token_count", f"""
SELECT doc_id, {Q.ntok('text')}::INTEGER AS n_tokens, len({Q.terms('text')})::INTEGER AS n_terms FROM documents""")
def q_token_count(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", T.token_count("text").alias("n_tokens"), F.size(T.terms("text")).alias("n_terms"))


@register("split_sentences", f"""
SELECT doc_id, (generate_subscripts(s, 1) - 1)::INTEGER AS sent_no, unnest(s) AS sentence
FROM (SELECT doc_id, {Q.sentences('text')} AS s FROM documents)""")
def q_split_sentences(spark, sf_dir):
    return C.split_sentences(table(spark, sf_dir, "documents"), "text", keep=("doc_id",))


@register("split_paragraphs", r"""
SELECT doc_id, (generate_subscripts(p, 1) - 1)::INTEGER AS para_no, unnest(p) AS paragraph
FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '\n+'), lambda x: trim(x) <> '') AS p FROM documents)""")
def q_split_paragraphs(spark, sf_dir):
    return C.split_paragraphs(table(spark, sf_dir, "documents"), "text", keep=("doc_id",))


@register("truncate_tokens", f"""
SELECT doc_id, array_to_string(list_slice({Q.tokens('text')}, 1, {TRUNCATE_AT}), ' ') AS content FROM documents""")
def q_truncate(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", T.truncate_tokens("text", TRUNCATE_AT).alias("content"))


@register("chunk_window", f"""
SELECT path, (generate_subscripts(ch, 1) - 1)::INTEGER AS chunk_no, unnest(ch) AS content
FROM (SELECT path, {Q.chunk_window('text', WINDOW_SIZE, WINDOW_OVERLAP)} AS ch FROM {DOCS_SQL})""")
def q_chunk_window(spark, sf_dir):
    d = spread(documents(spark, sf_dir).select("path", "text"))
    return C.chunk_window(d, "text", keep=("path",), size=WINDOW_SIZE, overlap=WINDOW_OVERLAP)


@register("chunk_sentences", f"""
SELECT path, chunk_no, content FROM {chunks_sql()}""")
def q_chunk_sentences(spark, sf_dir):
    return sentence_chunks(spark, sf_dir).select("path", "chunk_no", "content")


@register("chunk_sentences_sql", f"""
SELECT path, chunk_no, content FROM {chunks_sql()}""")
def q_chunk_sentences_sql(spark, sf_dir):
    """The same chunks from the column form, in one select without a helper."""
    d = spread(documents(spark, sf_dir).select("path", "text"))
    return d.select("path", F.posexplode(C.chunk_sentences_col("text", CHUNK_SIZE, CHUNK_OVERLAP)).alias("chunk_no", "content"))


@register("chunk_sentences_no_overlap", f"""
SELECT path, chunk_no, content FROM {chunks_sql(SMALL_CHUNK, 0)}""")
def q_chunk_sentences_no_overlap(spark, sf_dir):
    return sentence_chunks(spark, sf_dir, SMALL_CHUNK, 0).select("path", "chunk_no", "content")


@register("chunk_whole", f"""
SELECT path, 0 AS chunk_no, text AS content FROM {DOCS_SQL} WHERE text IS NOT NULL AND trim(text) <> ''""")
def q_chunk_whole(spark, sf_dir):
    return C.chunk_whole(documents(spark, sf_dir), "text", keep=("path",))


@register("profile_chunks", f"""
SELECT path, count(*) AS n_chunks, min({Q.ntok('content')})::INTEGER AS min_tokens,
       max({Q.ntok('content')})::INTEGER AS max_tokens, round(avg({Q.ntok('content')}), 6) AS avg_tokens,
       sum(CASE WHEN {Q.ntok('content')} > {CHUNK_SIZE} THEN 1 ELSE 0 END)::BIGINT AS n_over_limit
FROM {chunks_sql()} GROUP BY path""")
def q_profile_chunks(spark, sf_dir):
    return C.profile_chunks(sentence_chunks(spark, sf_dir), by="path", limit=CHUNK_SIZE)


# ------------------------------------------------------------------ EMB

@register("hash_embed", f"""
SELECT id AS doc_id, bucket, weight FROM {Q.postings('documents', 'doc_id', 'text', DIM)}""")
def q_hash_embed(spark, sf_dir):
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return E.sparse_terms(d, "doc_id", "text", DIM)


# ------------------------------------------------------------------ SCH

def _knn_sql(metric: str, k: int, where: str = "TRUE") -> str:
    a, b = "q.embedding::DOUBLE[]", "c.embedding::DOUBLE[]"
    if metric == "cosine":
        den = f"(sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b})))"
        score = f"CASE WHEN {den} > 0 THEN list_dot_product({a}, {b}) / {den} ELSE 0 END"
    elif metric == "dot":
        score = f"list_dot_product({a}, {b})"
    else:
        score = f"-sqrt(list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))"
    return f"""
SELECT query_id, rank, score, vec_id FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, round({score}, 6) AS score
    FROM embeddings q, (SELECT * FROM embeddings WHERE {where}) c WHERE q.vec_id <> c.vec_id))
WHERE rank <= {k}"""


def _knn_query(metric: str, k: int, where=None):
    def run(spark, sf_dir):
        e = table(spark, sf_dir, "embeddings")
        q = e.select(F.col("vec_id").alias("query_id"), "embedding")
        return S.knn(q, e, k=k, metric=metric, query_id="query_id", cand_id="vec_id",
                     where=where, exclude_self=True)
    return run


QUERIES["knn_exact_cosine"] = _knn_query("cosine", 5)
ORACLE["knn_exact_cosine"] = _knn_sql("cosine", 5)
QUERIES["knn_exact_l2"] = _knn_query("l2", 5)
ORACLE["knn_exact_l2"] = _knn_sql("l2", 5)
QUERIES["knn_filtered"] = _knn_query("dot", 3, where="label < 5")
ORACLE["knn_filtered"] = _knn_sql("dot", 3, "label < 5")


def benchmark_questions(spark, sf_dir) -> DataFrame:
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))


@register("search_text", f"""
SELECT t.query_id, t.rank, t.score, c.doc_id, c.chunk_no::BIGINT AS chunk_no, c.path
FROM {Q.text_topk('benchmark', 'item_id', 'text', chunks_sql(), 'chunk_key', 'content', DIM, 4)} t
JOIN {chunks_sql()} c ON c.chunk_key = t.cid""")
def q_search_text(spark, sf_dir):
    hits = S.search_text(benchmark_questions(spark, sf_dir), sentence_chunks(spark, sf_dir), k=4, dim=DIM,
                         chunk_id=CHUNK_KEY, carry=("path",))
    return hits.select("query_id", "rank", "score", *CHUNK_KEY, "path")


@register("retrieve_top4", f"""
SELECT query_id, count(*) AS n_docs,
       string_agg(path, '|' ORDER BY rank) AS sources,
       sum(length(content))::BIGINT AS context_chars
FROM (SELECT t.query_id, t.rank, c.path, c.content
      FROM {Q.text_topk('benchmark', 'item_id', 'text', chunks_sql(), 'chunk_key', 'content', DIM, 4)} t
      JOIN {chunks_sql()} c ON c.chunk_key = t.cid)
GROUP BY query_id""")
def q_retrieve_top4(spark, sf_dir):
    r = S.retrieve(benchmark_questions(spark, sf_dir), sentence_chunks(spark, sf_dir), k=4, dim=DIM,
                   chunk_id=CHUNK_KEY, carry=("path", "content"))
    return r.select(
        "query_id", F.col("n_docs").cast("long").alias("n_docs"),
        F.array_join(F.transform("docs", lambda d: d["path"]), "|").alias("sources"),
        F.aggregate(F.transform("docs", lambda d: F.length(d["content"]).cast("long")),
                    F.lit(0).cast("long"), lambda s, x: s + x).alias("context_chars"))


# ------------------------------------------------------------------ CHT


MIN_DF_SHARE, RELEVANCE_THRESHOLD = 0.005, 0.5


def messages(spark, sf_dir) -> DataFrame:
    return CH.to_messages(table(spark, sf_dir, "conversations"))


@register("chat_messages", f"""
WITH {Q.MESSAGES_CTE}
SELECT conv_id, len(msgs)::INTEGER AS n_messages, question, len(hist)::INTEGER AS n_history,
       msgs[len(msgs)].role AS last_role,
       (SELECT msgs[len(msgs)].role = 'user') AS ends_with_user,
       coalesce(list_filter(msgs, lambda x: x.role = 'user')[-1].content, NULL) AS last_user_question
FROM h""")
def q_chat_messages(spark, sf_dir):
    m = messages(spark, sf_dir)
    return m.select("conv_id", F.size("messages").alias("n_messages"), CH.question("messages").alias("question"),
                    F.size(CH.history("messages")).alias("n_history"),
                    F.element_at("messages", -1)["role"].alias("last_role"),
                    (F.element_at("messages", -1)["role"] == "user").alias("ends_with_user"),
                    CH.last_user_question("messages").alias("last_user_question"))


@register("chat_prompt", f"""
WITH {Q.MESSAGES_CTE}
SELECT conv_id, {Q.render(P.RELEVANCE, chat_history=Q.history_text('hist'), question='question')} AS prompt FROM h""")
def q_chat_prompt(spark, sf_dir):
    m = messages(spark, sf_dir)
    h = CH.history("messages")
    return m.select("conv_id", CH.render(P.RELEVANCE, chat_history=CH.history_text(h),
                                         question=CH.question("messages")).alias("prompt"))


@register("chat_relevance", f"""
WITH {Q.MESSAGES_CTE}, {Q.lexicon_cte(MIN_DF_SHARE)}, {Q.verdict_cte(RELEVANCE_THRESHOLD)}
SELECT conv_id, round(lex_share, 6) AS lex_share, verdict,
       CASE WHEN contains(lower(verdict), 'yes') THEN 'answer' WHEN contains(lower(verdict), 'no') THEN 'refuse'
            ELSE 'refuse' END AS route
FROM j""")
def q_chat_relevance(spark, sf_dir):
    m = messages(spark, sf_dir).select("conv_id", CH.question("messages").alias("question"))
    lex = CH.corpus_lexicon(spread(table(spark, sf_dir, "documents")), min_share=MIN_DF_SHARE)
    j = CH.classify_relevance(m, lex, "conv_id", "question", RELEVANCE_THRESHOLD)
    return j.select("conv_id", F.round("lex_share", 6).alias("lex_share"), "verdict",
                    CH.route("verdict").alias("route"))


@register("chat_rewrite", f"""
WITH {Q.MESSAGES_CTE}
SELECT conv_id, {Q.rewrite('question', 'hist')} AS query FROM h""")
def q_chat_rewrite(spark, sf_dir):
    m = messages(spark, sf_dir)
    return m.select("conv_id", CH.rewrite_query(CH.question("messages"), CH.history("messages")).alias("query"))


@register("chat_transcript", f"""
WITH {Q.MESSAGES_CTE}
SELECT conv_id, array_to_string(list_transform(msgs, lambda x: CASE WHEN x.role = 'user' THEN 'user: '
       ELSE 'assistant: ' END || x.content), chr(10)) AS transcript FROM h""")
def q_chat_transcript(spark, sf_dir):
    return messages(spark, sf_dir).select("conv_id", CH.render_transcript("messages").alias("transcript"))


def _answers_sql(q_src: str, q_id: str, q_text: str) -> str:
    topk = Q.text_topk(q_src, q_id, q_text, chunks_sql(), "chunk_key", "content", DIM, 4)
    return f"""hits AS (SELECT t.query_id, t.rank, c.path, c.content FROM {topk} t
                       JOIN {chunks_sql()} c ON c.chunk_key = t.cid),
docs AS (SELECT query_id, string_agg(content, chr(10) || chr(10) ORDER BY rank) AS context,
                string_agg(path, '|' ORDER BY rank) AS sources, count(*)::INTEGER AS n_sources
         FROM hits GROUP BY query_id)"""


@register("answer_questions", f"""
WITH {_answers_sql('benchmark', 'item_id', 'text')}
SELECT b.item_id AS query_id, b.text AS question,
       {Q.extractive_answer('b.text', "coalesce(d.context, '')")} AS result,
       coalesce(d.sources, '') AS sources, coalesce(d.n_sources, 0)::INTEGER AS n_sources
FROM benchmark b LEFT JOIN docs d ON d.query_id = b.item_id""")
def q_answer_questions(spark, sf_dir):
    a = CH.answer(benchmark_questions(spark, sf_dir), sentence_chunks(spark, sf_dir), k=4, dim=DIM, chunk_id=CHUNK_KEY)
    return a.select("query_id", "question", "result", F.array_join("sources", "|").alias("sources"),
                    F.size("sources").alias("n_sources"))


CHAT_FULL_SQL = f"""
WITH {Q.MESSAGES_CTE}, {Q.lexicon_cte(MIN_DF_SHARE)}, {Q.verdict_cte(RELEVANCE_THRESHOLD)},
ok AS (SELECT conv_id, question, {Q.rewrite('question', 'hist')} AS query FROM j WHERE verdict = 'yes'),
{_answers_sql('ok', 'conv_id', 'query')}
SELECT ok.conv_id, 'yes' AS verdict, ok.query,
       {Q.extractive_answer('ok.question', "coalesce(d.context, '')")} AS result,
       coalesce(d.sources, '') AS sources, coalesce(d.n_sources, 0)::INTEGER AS n_sources
FROM ok LEFT JOIN docs d ON d.query_id = ok.conv_id
UNION ALL
SELECT conv_id, verdict, NULL AS query, '{P.REFUSAL}' AS result, '' AS sources, 0 AS n_sources
FROM j WHERE verdict <> 'yes'"""


@register("chat_full", CHAT_FULL_SQL)
def q_chat_full(spark, sf_dir):
    lex = CH.corpus_lexicon(spread(table(spark, sf_dir, "documents")), min_share=MIN_DF_SHARE)
    out = CH.chat(messages(spark, sf_dir), sentence_chunks(spark, sf_dir), lex, k=4, dim=DIM,
                  threshold=RELEVANCE_THRESHOLD, chunk_id=CHUNK_KEY)
    return out.select("conv_id", "verdict", "query", "result", F.array_join("sources", "|").alias("sources"),
                      F.size("sources").alias("n_sources"))


# ------------------------------------------------------------------ cleanup, web


BP_MIN_DOCS, BP_MIN_SHARE = 3, 0.05


@register("drop_boilerplate_lines", f"""
WITH lines AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                      generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents),
sc AS (SELECT source, count(*) AS source_docs FROM documents GROUP BY source),
pl AS (SELECT source, line, count(DISTINCT doc_id) AS n_docs FROM lines WHERE trim(line) <> '' GROUP BY source, line),
bp AS (SELECT pl.source, pl.line FROM pl JOIN sc ON pl.source IS NOT DISTINCT FROM sc.source
       WHERE n_docs >= greatest({BP_MIN_DOCS}, sc.source_docs * {BP_MIN_SHARE}))
SELECT l.doc_id, l.source,
       coalesce(string_agg(CASE WHEN bp.line IS NULL THEN l.line END, chr(10) ORDER BY l.line_no), '') AS text,
       count(bp.line) AS n_removed
FROM lines l LEFT JOIN bp ON l.source IS NOT DISTINCT FROM bp.source AND l.line = bp.line
GROUP BY l.doc_id, l.source""")
def q_drop_boilerplate(spark, sf_dir):
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return CL.drop_boilerplate_lines(d, min_docs=BP_MIN_DOCS, min_share=BP_MIN_SHARE)


@register("extract_article", r"""
SELECT page_id, nullif(trim(regexp_extract(html, '(?s)<article>(.*?)</article>', 1)), '') AS article FROM pages""")
def q_extract_article(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", W.article_text(F.col("html")).alias("article"))


@register("fetch_pages_offline", r"""
WITH u AS (SELECT DISTINCT url FROM pages),
f AS (SELECT u.url, p.html FROM u LEFT JOIN (SELECT url, arg_max(html, page_id) AS html FROM pages GROUP BY url) p ON p.url = u.url),
a AS (SELECT url, nullif(trim(regexp_extract(html, '(?s)<article>(.*?)</article>', 1)), '') AS text FROM f)
SELECT url, text,
       trim(regexp_replace(regexp_replace(text, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS plain_text
FROM a WHERE text IS NOT NULL""")
def q_fetch_pages_offline(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    urls = pages.select("url").distinct()
    arts = W.scrape_articles(urls, lambda u: W.fetch_offline(u, pages))
    return arts.select("url", "text", T.strip_tags(F.col("text")).alias("plain_text"))


HEADINGS_SQL = r"""list_filter(list_transform(range(1, len(p) + 1),
       lambda i: CASE WHEN i = 1 THEN p[1] ELSE d[i - 1] || p[i] END), lambda x: trim(x) <> '')"""


@register("split_headings", f"""
SELECT page_id, (generate_subscripts(s, 1) - 1)::INTEGER AS section_no, unnest(s) AS section
FROM (SELECT page_id, {HEADINGS_SQL} AS s
      FROM (SELECT page_id, regexp_split_to_array(html, '(?i)<h[1-6]') AS p,
                   regexp_extract_all(html, '(?i)<h[1-6]') AS d FROM pages))""")
def q_split_headings(spark, sf_dir):
    """TXT-11: a Java look-ahead split keeps each heading tag; the SQL twin
    (RE2 has no look-ahead) splits on the tag and re-attaches it."""
    return C.split_headings(table(spark, sf_dir, "pages"), "html", keep=("page_id",))


# ------------------------------------------------------------------ index maintenance

@register("diff_snapshots", f"""
WITH o AS (SELECT doc_id, text, CASE WHEN lang = 'fr' THEN source END AS a, CASE WHEN lang <> 'fr' THEN source END AS b
           FROM documents WHERE lang <> 'es'),
n AS (SELECT doc_id, {Q.clean('text')} AS text, CASE WHEN lang <> 'fr' THEN NULL ELSE source END AS a, source AS b
      FROM documents WHERE lang <> 'de')
SELECT coalesce(n.doc_id, o.doc_id) AS doc_id,
       CASE WHEN o.doc_id IS NULL THEN 'insert' WHEN n.doc_id IS NULL THEN 'delete' ELSE 'update' END AS change_type,
       n.a AS a, n.b AS b
FROM o FULL OUTER JOIN n ON o.doc_id = n.doc_id
WHERE o.doc_id IS NULL OR n.doc_id IS NULL OR o.text IS DISTINCT FROM n.text OR o.a IS DISTINCT FROM n.a
   OR o.b IS DISTINCT FROM n.b""")
def q_diff_snapshots(spark, sf_dir):
    """Every document is in at least one snapshot (each leaves out another
    language); two nullable columns change side by rule."""
    d = table(spark, sf_dir, "documents")
    fr = F.col("lang") == "fr"
    old = d.filter(F.col("lang") != "es").select(
        "doc_id", "text", F.when(fr, F.col("source")).alias("a"), F.when(~fr, F.col("source")).alias("b"))
    new = d.filter(F.col("lang") != "de").select(
        "doc_id", T.clean_text("text").alias("text"), F.when(fr, F.col("source")).alias("a"), F.col("source").alias("b"))
    return IX.diff_snapshots(old, new, "doc_id", ["text", "a", "b"]).select("doc_id", "change_type", "a", "b")


@register("upsert_index", f"""
WITH ch AS (
  SELECT l.doc_id, CASE WHEN l.toxic = 1 THEN 'delete' ELSE 'upsert' END AS op, 2 AS version,
         {Q.clean('d.text')} AS text
  FROM labels l JOIN documents d USING (doc_id)
  UNION ALL
  SELECT l.doc_id, 'upsert' AS op, 1 AS version, array_to_string(list_slice({Q.tokens('d.text')}, 1, 10), ' ') AS text
  FROM labels l JOIN documents d USING (doc_id) WHERE l.quality = 0),
last AS (SELECT doc_id, arg_max(op, version) AS op, arg_max(text, version) AS text FROM ch GROUP BY doc_id)
SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM last)
UNION ALL SELECT doc_id, text FROM last WHERE op <> 'delete'""")
def q_upsert_index(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = table(spark, sf_dir, "labels")
    j = lab.join(d, "doc_id")
    newer = j.select("doc_id", F.when(F.col("toxic") == 1, "delete").otherwise("upsert").alias("op"),
                     F.lit(2).alias("version"), T.clean_text("text").alias("text"))
    older = j.filter(F.col("quality") == 0).select("doc_id", F.lit("upsert").alias("op"), F.lit(1).alias("version"),
                                                   T.truncate_tokens("text", 10).alias("text"))
    return IX.apply_changes(d, newer.unionByName(older), "doc_id")


@register("sync_index", f"""
WITH src AS (SELECT doc_id, lang, {Q.clean('text')} AS content FROM documents WHERE lang <> 'de'),
p AS {Q.postings('src', 'doc_id', 'content', DIM)}
SELECT src.doc_id, src.lang, count(p.bucket)::INTEGER AS n_nonzero, coalesce(sum(p.weight * p.weight), 0)::BIGINT AS norm2
FROM src LEFT JOIN p ON p.id = src.doc_id GROUP BY src.doc_id, src.lang""")
def q_sync_index(spark, sf_dir):
    """SCH-7: an index of raw texts without Spanish is brought in step with
    cleaned texts without German; it must equal an index built anew.  Both
    are versions of one stored index, partitioned by the nearest of
    SYNC_CELLS hashed vectors."""
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    root = f"{checkpoint_root(spark)}/indexes/{uuid.uuid4().hex}"
    first = d.filter(F.col("lang") != "es").select("doc_id", "lang", F.col("text").alias("content"))
    cen = S.sample_centroids(first, SYNC_CELLS, "doc_id", embed=lambda x: ingest.embed_chunks(x, DIM))
    make = ingest.index_rows(cen, DIM, key="doc_id")
    VS.sync(spark, root, first, "doc_id", make)
    source = d.filter(F.col("lang") != "de").select("doc_id", "lang", T.clean_text("text").alias("content"))
    new = VS.read_version(spark, root, VS.sync(spark, root, source, "doc_id", make))
    return new.select("doc_id", "lang", F.size(F.filter("embedding", lambda x: x != 0)).alias("n_nonzero"),
                      F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x).cast("long").alias("norm2"))


# ------------------------------------------------------------------ monitoring

def _answers(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "conversations").filter(F.col("role") == "assistant")
    return c.select(F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
                    .alias("request_id"), F.col("text").alias("result"))


@register("answer_metrics", f"""
WITH a AS (SELECT conv_id::VARCHAR || '-' || turn::VARCHAR AS request_id, text AS result
           FROM conversations WHERE role = 'assistant'),
cnt AS (SELECT term, count(*) AS c FROM (SELECT unnest({Q.terms('text')}) AS term FROM documents) GROUP BY term),
tot AS (SELECT sum(c)::DOUBLE AS n_all, count(*)::DOUBLE AS v_all FROM cnt),
pt AS (SELECT request_id, term, count(*) AS n FROM (SELECT request_id, unnest({Q.terms('result')}) AS term FROM a)
       GROUP BY request_id, term),
lp AS (SELECT pt.request_id, sum(pt.n * (ln(coalesce(cnt.c, 0) + 1) - ln((SELECT n_all + v_all FROM tot)))) AS sum_lp
       FROM pt LEFT JOIN cnt USING (term) GROUP BY pt.request_id),
b AS (SELECT request_id, len({Q.terms('result')}) AS n_tokens, len(list_distinct({Q.terms('result')})) AS n_types,
             len(list_filter({Q.sentences('result')}, lambda s: len({Q.tokens('s')}) > 0)) AS n_sentences,
             {Q.ntok('result')} AS n_words, result = '{P.REFUSAL}' AS refused FROM a)
SELECT b.request_id, b.n_tokens::INTEGER AS n_tokens,
       round(CASE WHEN n_sentences > 0 THEN n_words / n_sentences END, 6) AS mean_sentence_tokens,
       round(CASE WHEN n_tokens > 0 THEN n_types / n_tokens END, 6) AS type_token_ratio,
       round(CASE WHEN n_tokens > 0 THEN exp(-lp.sum_lp / n_tokens) END, 4) AS unigram_perplexity,
       refused
FROM b LEFT JOIN lp USING (request_id)""")
def q_answer_metrics(spark, sf_dir):
    counts = MO.term_counts(spread(table(spark, sf_dir, "documents")))
    return MO.answer_metrics(_answers(spark, sf_dir), counts)


def _daily(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    m = MO.metrics_over_time(ev, "ts", "value", ["event_type"], ntz=True)
    return m.withColumn("day", F.date_format("window_start", "yyyy-MM-dd")).drop("window_start")


DAILY_SQL = """(SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n,
       round(avg(value), 6) AS avg_value, round(sum(value), 6) AS sum_value
FROM events GROUP BY ALL)"""


@register("metrics_over_time", f"SELECT day, event_type, n, avg_value, sum_value FROM {DAILY_SQL}")
def q_metrics_over_time(spark, sf_dir):
    return _daily(spark, sf_dir).select("day", "event_type", "n", "avg_value", "sum_value")


@register("drift_zscore", f"""
SELECT event_type, day, avg_value,
       round(avg(avg_value) OVER w, 6) AS ref_mean, round(stddev_samp(avg_value) OVER w, 6) AS ref_sd,
       round(CASE WHEN stddev_samp(avg_value) OVER w > 0
                  THEN (avg_value - avg(avg_value) OVER w) / stddev_samp(avg_value) OVER w END, 6) AS zscore
FROM {DAILY_SQL}
WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""")
def q_drift_zscore(spark, sf_dir):
    return MO.zscore_drift(_daily(spark, sf_dir), ["event_type"], "day", "avg_value", 7)


@register("drift_psi", """
WITH c AS (SELECT event_type, sum(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 0 END) AS na,
                  sum(CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN 1 ELSE 0 END) AS nb FROM events GROUP BY event_type),
s AS (SELECT event_type, greatest(na / sum(na) OVER (), 0.0001) AS pa, greatest(nb / sum(nb) OVER (), 0.0001) AS pb FROM c)
SELECT round(sum((pb - pa) * ln(pb / pa)), 6) AS psi FROM s""")
def q_drift_psi(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn(
        "period", F.when(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"), "a").otherwise("b"))
    return MO.psi(ev, "event_type", "period", "a", "b")


@register("table_counts", """
SELECT 'documents' AS name, count(*) AS n FROM documents UNION ALL
SELECT 'pages', count(*) FROM pages UNION ALL SELECT 'conversations', count(*) FROM conversations UNION ALL
SELECT 'embeddings', count(*) FROM embeddings UNION ALL SELECT 'labels', count(*) FROM labels UNION ALL
SELECT 'benchmark', count(*) FROM benchmark""")
def q_table_counts(spark, sf_dir):
    from functools import reduce
    names = ["documents", "pages", "conversations", "embeddings", "labels", "benchmark"]
    parts = [table(spark, sf_dir, n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n")
             for n in names]
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------ more chunkers

SEM_THRESHOLD, SEM_SIZE = 0.1, 200


@register("chunk_semantic", f"""
SELECT path, (generate_subscripts(ch, 1) - 1)::INTEGER AS chunk_no, unnest(ch) AS content
FROM (SELECT path, CASE WHEN r.n > 0 THEN list_append(r.out, r.cur) ELSE r.out END AS ch
      FROM (SELECT path, {Q.semantic('text', SEM_THRESHOLD, SEM_SIZE)} AS r FROM {DOCS_SQL}))""")
def q_chunk_semantic(spark, sf_dir):
    d = spread(documents(spark, sf_dir).select("path", "text"))
    return C.chunk_semantic(d, "text", keep=("path",), threshold=SEM_THRESHOLD, size=SEM_SIZE)


@register("chunk_topics")
def q_chunk_topics(spark, sf_dir):
    """LDA topic runs over all sentences; iterative ML fit, rows-only check."""
    d = spread(table(spark, sf_dir, "documents"))
    sents = C.split_sentences(d, "text", keep=("doc_id",))
    return C.chunk_topics(sents, "doc_id", "sent_no", "sentence", k=8, max_iter=5)


@register("chunks_head", f"""
SELECT doc_id, path, chunk_no, {Q.ntok('content')}::INTEGER AS n_tokens FROM {chunks_sql()}
ORDER BY doc_id, chunk_no LIMIT 10""")
def q_chunks_head(spark, sf_dir):
    """LIM-1: the first rows of the chunk table in key order (a report)."""
    ch = sentence_chunks(spark, sf_dir)
    return ch.orderBy(*CHUNK_KEY).limit(10).select("doc_id", "path", "chunk_no", T.token_count("content").alias("n_tokens"))


@register("sync_embeddings", f"""
WITH c AS (SELECT * FROM {chunks_sql()}),
todo AS (SELECT c.* FROM c JOIN documents d USING (doc_id) WHERE d.lang <> 'en'),
p AS {Q.postings('todo', 'chunk_key', 'content', DIM)}
SELECT todo.doc_id, todo.path, todo.chunk_no, count(p.bucket)::INTEGER AS n_nonzero
FROM todo LEFT JOIN p ON p.id = todo.chunk_key GROUP BY todo.doc_id, todo.path, todo.chunk_no""")
def q_sync_embeddings(spark, sf_dir):
    """EMB-4: chunks of English documents count as already embedded; embed the rest only."""
    # chunks carry their document's language (no join of many chunks per
    # document back to the documents); read twice, so chunked once
    d = spread(documents(spark, sf_dir).select("doc_id", "path", "lang", "text"))
    ch = stored(C.chunk_sentences(d, "text", keep=("doc_id", "path", "lang"), size=CHUNK_SIZE, overlap=CHUNK_OVERLAP), "chunks")
    done = ch.filter(F.col("lang") == "en").select(*CHUNK_KEY)
    new = E.sync_embeddings(ch.select(*CHUNK_KEY, "path", "content"), done, key=CHUNK_KEY, dim=DIM)
    return new.select("doc_id", "path", "chunk_no",
                      F.size(F.filter("embedding", lambda x: x != 0)).alias("n_nonzero"))


# ------------------------------------------------------------------ approximate search, learned relevance

IVF_LISTS, IVF_PROBE = 8, 6          # probes of the approximate search: recall@5 of 0.9 on these vectors


@register("knn_ivf_exact", _knn_sql("cosine", 5))
def q_knn_ivf_exact(spark, sf_dir):
    """SCH-6 made exact: first probe 6 of 8 cells, then every cell whose
    radius bound can still beat the k-th score; equals exact search."""
    e = spread(table(spark, sf_dir, "embeddings"))
    q = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), "embedding")
    cen = S.train_centroids(e, IVF_LISTS)
    index = S.assign_cells(e, cen)
    return S.knn_ivf(q, index, cen, k=5, nprobe=IVF_PROBE, query_id="query_id", cand_id="vec_id",
                     exclude_self=True, exact=True)


@register("knn_ivf", _knn_sql("dot", 5))
def q_knn_ivf(spark, sf_dir):
    """SCH-6 with every cell probed: complete for any metric, here dot product."""
    e = spread(table(spark, sf_dir, "embeddings"))
    q = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), "embedding")
    cen = S.train_centroids(e, IVF_LISTS)
    return S.knn_ivf(q, S.assign_cells(e, cen), cen, k=5, nprobe=IVF_LISTS, metric="dot", query_id="query_id",
                     cand_id="vec_id", exclude_self=True)


LSH_TABLES, LSH_BITS, LSH_PROBES, LSH_FLIPS = 1, 6, 50, 6   # recall@5 of 0.93 with 0.78 of the pairs: these vectors have no near neighbours
RECALL = 0.9


def _recall_row(approx: DataFrame, e: DataFrame) -> DataFrame:
    """Does the approximate search reach the recall, and is every score that it gives the true one?"""
    exact = S.knn(e.select(F.col("vec_id").alias("query_id"), "embedding"), e, k=5, cand_id="vec_id", exclude_self=True)
    approx = stored(approx, "approx")
    recall = S.recall_at_k(approx, exact, cand_id="vec_id")
    both = approx.join(e.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("_a")), "query_id").join(e.select("vec_id", "embedding"), "vec_id")
    wrong = both.where(F.abs(F.col("score") - V.cosine(F.col("_a"), F.col("embedding"))) > 1e-6).agg(F.count(F.lit(1)).alias("n"))
    return recall.select((F.col("recall") >= RECALL).alias("recall_reached"), (wrong.scalar() == 0).alias("scores_true"))


@register("ivf_recall", "SELECT true AS recall_reached, true AS scores_true")
def q_ivf_recall(spark, sf_dir):
    """recall@5 of the IVF search (6 of 8 cells) against exact search over all vectors: at least RECALL."""
    e = spread(table(spark, sf_dir, "embeddings"))
    cen = S.train_centroids(e, IVF_LISTS)
    approx = S.knn_ivf(e.select(F.col("vec_id").alias("query_id"), "embedding"), S.assign_cells(e, cen), cen, k=5, nprobe=IVF_PROBE,
                       cand_id="vec_id", exclude_self=True)
    return _recall_row(approx, e)


@register("lsh_recall", "SELECT true AS recall_reached, true AS scores_true")
def q_lsh_recall(spark, sf_dir):
    """recall@5 of multi-probe hash buckets against exact search over all vectors: at least RECALL."""
    e = spread(table(spark, sf_dir, "embeddings"))
    approx = LSH.knn_lsh(e.select(F.col("vec_id").alias("query_id"), "embedding"), e, LSH.Planes(64, LSH_TABLES, LSH_BITS), k=5,
                         probes=LSH_PROBES, flips=LSH_FLIPS, cand_id="vec_id", exclude_self=True)
    return _recall_row(approx, e)


@register("chat_relevance_model")
def q_chat_relevance_model(spark, sf_dir):
    """CHT-16: logistic regression on document embeddings labelled by quality,
    applied to every conversation's question (iterative fit: rows-only)."""
    model = CH.train_relevance(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels"), DIM)
    m = messages(spark, sf_dir).select("conv_id", CH.question("messages").alias("question"))
    return CH.classify_with_model(m, model, "question", DIM).select("conv_id", "p_relevant", "verdict")


def _chat_answers(spark, sf_dir) -> DataFrame:
    lex = CH.corpus_lexicon(spread(table(spark, sf_dir, "documents")), min_share=MIN_DF_SHARE)
    return CH.chat(messages(spark, sf_dir), sentence_chunks(spark, sf_dir), lex, k=4, dim=DIM,
                   threshold=RELEVANCE_THRESHOLD, chunk_id=CHUNK_KEY)


@register("answer_log", f"""
WITH c AS ({CHAT_FULL_SQL}),
m AS (SELECT conv_id, count(*) AS n_messages FROM conversations GROUP BY conv_id)
SELECT 'conv-' || c.conv_id::VARCHAR AS request_id,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + to_hours(c.conv_id), '%Y-%m-%d %H:%M:%S') AS ts,
       m.n_messages::INTEGER AS n_messages, c.result, c.sources
FROM c JOIN m USING (conv_id)""")
def q_answer_log(spark, sf_dir):
    """MON-1: the chain's answers shaped as answer-log rows (request id, time,
    messages, result, sources); time = 2024-01-01 + conv_id hours."""
    ans = _chat_answers(spark, sf_dir)
    msgs = messages(spark, sf_dir)
    j = ans.join(msgs, "conv_id")
    ts = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("conv_id"))
    log = MO.log_rows(j, F.concat(F.lit("conv-"), F.col("conv_id").cast("string")), ts,
                      F.transform("messages", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))))
    return log.select("request_id", F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss").alias("ts"),
                      F.size("messages").alias("n_messages"), "result",
                      F.array_join("sources", "|").alias("sources"))


@register("chat_answer_metrics", f"""
WITH a AS (SELECT 'conv-' || conv_id::VARCHAR AS request_id, result FROM ({CHAT_FULL_SQL})),
cnt AS (SELECT term, count(*) AS c FROM (SELECT unnest({Q.terms('text')}) AS term FROM documents) GROUP BY term),
tot AS (SELECT sum(c)::DOUBLE AS n_all, count(*)::DOUBLE AS v_all FROM cnt),
pt AS (SELECT request_id, term, count(*) AS n FROM (SELECT request_id, unnest({Q.terms('result')}) AS term FROM a)
       GROUP BY request_id, term),
lp AS (SELECT pt.request_id, sum(pt.n * (ln(coalesce(cnt.c, 0) + 1) - ln((SELECT n_all + v_all FROM tot)))) AS sum_lp
       FROM pt LEFT JOIN cnt USING (term) GROUP BY pt.request_id),
b AS (SELECT request_id, len({Q.terms('result')}) AS n_tokens, len(list_distinct({Q.terms('result')})) AS n_types,
             len(list_filter({Q.sentences('result')}, lambda s: len({Q.tokens('s')}) > 0)) AS n_sentences,
             {Q.ntok('result')} AS n_words, result = '{P.REFUSAL}' AS refused FROM a)
SELECT b.request_id, b.n_tokens::INTEGER AS n_tokens,
       round(CASE WHEN n_sentences > 0 THEN n_words / n_sentences END, 6) AS mean_sentence_tokens,
       round(CASE WHEN n_tokens > 0 THEN n_types / n_tokens END, 6) AS type_token_ratio,
       round(CASE WHEN n_tokens > 0 THEN exp(-lp.sum_lp / n_tokens) END, 4) AS unigram_perplexity,
       refused
FROM b LEFT JOIN lp USING (request_id)""")
def q_chat_answer_metrics(spark, sf_dir):
    """MON-2 over the chain's own answers (conversations -> answers -> metrics)."""
    ans = _chat_answers(spark, sf_dir).select(
        F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("request_id"), "result")
    counts = MO.term_counts(spread(table(spark, sf_dir, "documents")))
    return MO.answer_metrics(ans, counts)


@register("dense_chunk_ids", f"""
SELECT row_number() OVER (ORDER BY doc_id, chunk_no) AS id, doc_id, chunk_no FROM {chunks_sql()}""")
def q_dense_chunk_ids(spark, sf_dir):
    """SNK-3 (batch): dense ids 1..n over all chunks in (doc_id, chunk_no) order."""
    ch = sentence_chunks(spark, sf_dir).select("doc_id", "chunk_no")
    return C.dense_id(ch, ["doc_id", "chunk_no"], "id")


@register("extract_page_sections", r"""
WITH h AS (SELECT 'page/' || page_id::VARCHAR AS path,
                  regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>', ' ', 'g'),
                                 '(?is)<style\b.*?</style>', ' ', 'g') AS x FROM pages),
sp AS (SELECT path, regexp_split_to_array(x, '(?i)<h[1-6]') AS p, regexp_extract_all(x, '(?i)<h[1-6]') AS d FROM h),
pt AS (SELECT path, list_transform(range(1, len(p) + 1),
                                   lambda i: CASE WHEN i = 1 THEN p[1] ELSE d[i - 1] || p[i] END) AS parts FROM sp),
sc AS (SELECT path, list_filter(list_transform(parts, lambda q: trim(regexp_replace(regexp_replace(q, '<[^>]*>', ' ', 'g'),
                                '[ \t\n\x0b\f\r]+', ' ', 'g'))), lambda t: t <> '') AS s FROM pt)
SELECT path, len(s)::BIGINT AS n_sections,
       length(array_to_string(list_transform(s, lambda t: regexp_replace(regexp_replace(t, chr(10), '', 'g'),
              ' ?\.', '.', 'g')), chr(10)))::INTEGER AS n_chars
FROM sc WHERE len(s) > 0""")
def q_extract_page_sections(spark, sf_dir):
    """TXT-1 + TXT-3: every stored page as file bytes -> heading-led text
    sections (HTML extractor) -> cleaned and joined per page."""
    from docsift.sources import files as SF
    pages = spread(table(spark, sf_dir, "pages")).select(
        F.concat(F.lit("page/"), F.col("page_id").cast("string")).alias("path"),
        F.encode("html", "UTF-8").alias("content"))
    secs = SF.extract_section_arrays(pages, SF.html_sections).where(F.size("sections") > 0)
    text = F.array_join(F.transform("sections", lambda s: T.clean_text(s)), "\n")
    return secs.select("path", F.size("sections").cast("long").alias("n_sections"), F.length(text).alias("n_chars"))


# ------------------------------------------------------------------ injected models, versions, topic properties

SCORE_LIMIT, SCORE_SLICES, MODEL_DIM = 50, 5, 64


@register("score_questions", f"""
WITH first AS (SELECT item_id, text FROM benchmark ORDER BY item_id LIMIT {SCORE_LIMIT}),
{_answers_sql('first', 'item_id', 'text')}
SELECT b.item_id AS query_id, {Q.extractive_answer('b.text', "coalesce(d.context, '')")} AS result,
       coalesce(d.n_sources, 0)::INTEGER AS n_sources
FROM first b LEFT JOIN docs d ON d.query_id = b.item_id""")
def q_score_questions(spark, sf_dir):
    """CHT-17: the first 50 questions of a table (the operator's own limit), in 5 slices, through the answer chain."""
    a = CH.score_questions(benchmark_questions(spark, sf_dir), "query_id", SCORE_LIMIT, SCORE_SLICES,
                           lambda q: CH.answer(q, sentence_chunks(spark, sf_dir), k=4, dim=DIM, chunk_id=CHUNK_KEY))
    return a.select("query_id", "result", F.size("sources").alias("n_sources"))


def _counting_model(prompts: list) -> list:
    return [f"a prompt of {len(p)} characters" for p in prompts]


@register("ask_model", f"""
WITH {Q.MESSAGES_CTE}
SELECT conv_id, 'a prompt of ' || length({Q.render(P.SHORT_ANSWER, question='question')})::VARCHAR || ' characters' AS answer FROM h""")
def q_ask_model(spark, sf_dir):
    """CHT-5: prompt -> model -> string for the question of every conversation."""
    m = messages(spark, sf_dir).select("conv_id", CH.question("messages").alias("question"))
    return CH.ask(m, "question", _counting_model).select("conv_id", "answer")


@register("embed_model", f"""
SELECT id AS doc_id, bucket, weight FROM {Q.postings('documents', 'doc_id', 'text', MODEL_DIM)}""")
def q_embed_model(spark, sf_dir):
    """EMB-1: every document through an injected model in requests of 150 rows."""
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    e = E.embed(d, "text", E.HashModel(MODEL_DIM), dim=MODEL_DIM)
    return e.select("doc_id", F.posexplode("embedding").alias("bucket", "w")).where("w <> 0") \
            .select("doc_id", "bucket", F.col("w").cast("int").alias("weight"))


@register("latest_versions", """
WITH v AS (SELECT event_type AS name, (floor(value)::BIGINT % 40 - 20)::VARCHAR AS version FROM events),
n AS (SELECT DISTINCT event_type AS name FROM events UNION SELECT DISTINCT lang FROM documents)
SELECT n.name, greatest(coalesce(max(v.version::INTEGER), 1), 1)::INTEGER AS latest_version
FROM n LEFT JOIN v USING (name) GROUP BY n.name""")
def q_latest_versions(spark, sf_dir):
    """AGG-3: the highest version of every name, at least 1; names without versions are wanted, too."""
    ev, d = table(spark, sf_dir, "events"), table(spark, sf_dir, "documents")
    v = ev.select(F.col("event_type").alias("name"), (F.floor("value") % 40 - 20).cast("string").alias("version"))
    names = ev.select(F.col("event_type").alias("name")).union(d.select("lang"))
    return MO.latest_version(v, names)


@register("topic_chunks_hold", """
SELECT doc_id, sha256(text) AS text_sha256, true AS neighbours_differ FROM documents WHERE text IS NOT NULL AND text <> ''""")
def q_topic_chunks_hold(spark, sf_dir):
    """TXT-14, what any fit must give: a document's chunks, end to end, are its text, and neighbours differ in topic."""
    ch = q_chunk_topics(spark, sf_dir)
    one = F.array_sort(F.collect_list(F.struct("chunk_no", "topic", "content")))       # chunks of one document
    per = ch.groupBy("doc_id").agg(one.alias("c"))
    differ = F.forall(F.sequence(F.lit(1), F.size("c")), lambda i: (i == F.size("c")) | (F.get("c", i - 1)["topic"] != F.get("c", i)["topic"]))
    return per.select("doc_id", F.sha2(F.array_join(F.transform("c", lambda x: x["content"]), "").cast("binary"), 256).alias("text_sha256"),
                      differ.alias("neighbours_differ"))
