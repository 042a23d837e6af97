"""Operator outputs against the declared table schemas (plan time only)."""

import pytest
from pyspark.sql import functions as F

from docsift import schemas as SC
from docsift.operators import chat as CH
from docsift.operators import chunking as C
from docsift.operators import embedding as E
from docsift.operators import monitor as MO
from docsift.operators import search as S
from docsift.plans import ingest
from docsift.sources import files as SF


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame([("p", "One. Two three.")], "path string, text string")


def test_chunks_and_embeddings(spark, docs):
    raw = spark.createDataFrame([("p", None, 3, bytearray(b"a b."))],
                                "path string, modificationTime timestamp, length bigint, content binary")
    assert SC.conforms(raw, SC.RAW)
    ch = ingest.chunk_files(raw)
    SC.require(ch, SC.CHUNKS, "chunks")
    SC.require(ingest.embed_chunks(ch, 16), SC.CHUNK_EMBEDDINGS, "chunk embeddings")
    SC.require(SF.extract_sections(raw), SC.SECTIONS, "sections")


def test_index_hits_answers(spark):
    emb = spark.createDataFrame([(1, "p", 0, "a b", [1.0, 0.0])],
                                "chunk_id long, path string, chunk_no int, content string, embedding array<float>")
    SC.require(S.assign_cells(emb, __import__("numpy").eye(2)), SC.INDEX, "index")
    q = spark.createDataFrame([(7, [1.0, 0.0])], "query_id long, embedding array<float>")
    SC.require(S.knn(q, emb, k=1, carry=("path", "content")), SC.HITS, "hits")
    chunks = emb.drop("embedding")
    qs = spark.createDataFrame([(7, "a")], "query_id long, question string")
    SC.require(CH.answer(qs, chunks, k=1, dim=16), SC.ANSWERS, "answers")


def test_messages_log_metrics(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hi")], "conv_id long, turn long, role string, text string")
    m = CH.to_messages(turns)
    SC.require(m, SC.MESSAGES, "messages")
    ans = spark.createDataFrame([("r", "Hi there.", ["p"])], "request_id string, result string, sources array<string>")
    log = MO.log_rows(ans, F.col("request_id"), F.current_timestamp(),
                      F.array(F.struct(F.lit("user").alias("role"), F.lit("hi").alias("content"))))
    SC.require(log, SC.ANSWER_LOG, "answer log")
    counts = spark.createDataFrame([("hi", 1)], "term string, c long")
    SC.require(MO.answer_metrics(ans.select("request_id", "result"), counts), SC.ANSWER_METRICS, "answer metrics")


def test_require_raises(spark, docs):
    with pytest.raises(ValueError):
        SC.require(docs, SC.CHUNKS)
