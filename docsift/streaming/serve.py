"""Answer a stream of chat requests and log every answer (CHT-15 + MON-1).

Requests arrive as rows ``request_id string, messages
array<struct<role:string,content:string>>`` (e.g. JSON files dropped in a
folder).  Each micro-batch runs the whole chain in ``foreachBatch`` and
writes its answer-log rows to ``<log>/batch_id=<digest of its request ids>``
in overwrite mode: a micro-batch replayed after a failure rewrites exactly
the same folder, and requests that another folder already holds are left
out, so the log holds every request once, also under a new checkpoint
(``streaming.answerlog``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.operators import chat as CH
from docsift.operators.monitor import log_rows
from docsift.streaming import answerlog as AL
from docsift.streaming.publish import checkpoint_for

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("messages", T.ArrayType(T.StructType([T.StructField("role", T.StringType()),
                                                         T.StructField("content", T.StringType())]))),
])


def read_requests_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines request files in ``folder`` as a stream (schema given, not inferred)."""
    r = spark.readStream.schema(REQUEST_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(folder)


def with_turns(requests: DataFrame) -> DataFrame:
    """Request messages -> the chain's ``messages`` (turn = position)."""
    msgs = F.transform("messages", lambda m, i: F.struct(i.cast("long").alias("turn"), m["role"].alias("role"),
                                                         m["content"].alias("content")))
    return requests.select("request_id", msgs.alias("messages"))


def answer_batch(requests: DataFrame, chunks: DataFrame, lexicon: DataFrame, **chat_kw) -> DataFrame:
    """One batch of requests -> answer-log rows."""
    # search keys questions by a 64-bit id: a hash of the request id
    req = requests.withColumn("_qid", F.xxhash64("request_id"))
    msgs = with_turns(req).join(req.select("request_id", "_qid"), "request_id").drop("request_id")
    ans = CH.chat(msgs, chunks, lexicon, id_col="_qid", **chat_kw)
    j = ans.join(req, "_qid")
    return log_rows(j, F.col("request_id"), F.current_timestamp(), F.col("messages"))


def serve_requests(requests_stream: DataFrame, chunks: DataFrame, lexicon: DataFrame, log_path: str,
                   checkpoint: str | None = None, await_done: bool = True, **chat_kw):
    """Run the chain on every new request and append to the answer log."""
    spark = requests_stream.sparkSession
    ck = checkpoint or checkpoint_for(spark, "serve:" + log_path)

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        key = AL.digest(batch.select("request_id"))
        AL.write_run(answer_batch(AL.unlogged(batch, log_path, key), chunks, lexicon, **chat_kw), log_path, key)

    q = (requests_stream.writeStream.foreachBatch(handle).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    if await_done:
        q.awaitTermination()
    return q
