"""Entries B and C as table-level jobs, plus the monitoring loop.

* ``answer_table``: a table of questions -> retrieval QA -> answer log.
* ``chat_table``: a table of conversation turns -> full chain -> answer log.
* ``monitor_log``: the answer log -> per-answer metrics -> daily metrics
  with z-score drift -> metric table.

Request ids are derived from the input keys; a job run twice, or on input
that overlaps an earlier one, logs each request once
(``streaming.answerlog``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.operators import chat as CH
from docsift.operators import monitor as MO
from docsift.streaming import answerlog as AL


def answer_table(questions: DataFrame, chunks: DataFrame, log_path: str | None = None, k: int = 4,
                 dim: int = 1024, model=None, id_col: str = "query_id", question_col: str = "question", **search) -> DataFrame:
    """Entry B for many questions at once; returns log rows.  With ``log_path``
    they are logged, and questions logged by another run are left out."""
    def rows(some: DataFrame) -> DataFrame:
        ans = CH.answer(some, chunks, k=k, dim=dim, id_col=id_col, question_col=question_col, model=model, **search)
        msgs = F.array(F.struct(F.lit("user").alias("role"), F.col("question").alias("content")))
        return MO.log_rows(ans, F.concat(F.lit("q-"), F.col(id_col).cast("string")), F.current_timestamp(), msgs)
    if not log_path:
        return rows(questions)
    asked = questions.select(id_col, question_col)
    key = AL.digest(asked)
    new = AL.unlogged(asked.withColumn("_r", F.concat(F.lit("q-"), F.col(id_col).cast("string"))), log_path, key, "_r").drop("_r")
    return AL.write_run(rows(new), log_path, key)


def chat_table(turns: DataFrame, chunks: DataFrame, lexicon: DataFrame, log_path: str | None = None,
               k: int = 4, dim: int = 1024, **models) -> DataFrame:
    """Entry C for every conversation in ``turns``; returns log rows.  With
    ``log_path`` they are logged, and conversations logged by another run are
    left out."""
    request = F.concat(F.lit("conv-"), F.col("conv_id").cast("string"))

    def rows(msgs: DataFrame) -> DataFrame:
        ans = CH.chat(msgs, chunks, lexicon, k=k, dim=dim, **models)
        j = ans.join(msgs, "conv_id")
        plain = F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
        return MO.log_rows(j, request, F.current_timestamp(), plain)
    msgs = CH.to_messages(turns)
    if not log_path:
        return rows(msgs)
    key = AL.digest(turns.select("conv_id", "turn", "role", "text"))
    new = AL.unlogged(msgs.withColumn("_r", request), log_path, key, "_r").drop("_r")
    return AL.write_run(rows(new), log_path, key)


def monitor_log(log: DataFrame, counts: DataFrame, every: str = "1 day", drift_window: int = 7,
                out_path: str | None = None) -> DataFrame:
    """MON-2..4 over the answer log: metrics per answer, then per time window
    (mean perplexity, mean tokens, refusal rate, mean sources) with a z-score
    of each window's perplexity against the preceding ``drift_window``."""
    per = MO.answer_metrics(log.select("request_id", "result"), counts)
    per = per.join(log.select("request_id", "ts", F.size("sources").alias("n_sources")), "request_id")
    w = per.groupBy(F.window("ts", every).alias("w")).agg(
        F.count(F.lit(1)).alias("n_answers"),
        F.round(F.avg("unigram_perplexity"), 4).alias("avg_perplexity"),
        F.round(F.avg("n_tokens"), 4).alias("avg_tokens"),
        F.round(F.avg(F.col("refused").cast("double")), 6).alias("refusal_rate"),
        F.round(F.avg("n_sources"), 4).alias("avg_sources"),
    ).select(F.col("w.start").alias("window_start"), "*").drop("w").withColumn("all", F.lit("all"))
    out = MO.zscore_drift(w, ["all"], "window_start", "avg_perplexity", drift_window) \
        .join(w.drop("avg_perplexity"), ["all", "window_start"]).drop("all")
    if out_path:
        out.write.mode("overwrite").parquet(out_path)
    return out
