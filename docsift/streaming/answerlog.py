"""MON-1: an answer log that holds every request once, for batch jobs and streams.

    log/batch_id=<key>/part-*     answers of one run or micro-batch
    log_ids/cell=<c>/part-*       (request_id, batch_id) by a hash of the id

``key`` is a digest of a run's input, and the run's folder is overwritten: a
run repeated, or replayed after a failure, writes the same folder again.
Requests that another run has answered are left out; they are looked up in the
cells of the id table that the run's own ids fall into, so the lookup reads a
share of the ids only and never the answers.  Ids are added after the answers;
a run cut off between the two is answered again, into the same folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.operators.versions import _fs

ID_CELLS = 1024


def _cell(request_id: Column) -> Column:
    return F.pmod(F.xxhash64(request_id), F.lit(ID_CELLS)).cast("int")


def digest(rows: DataFrame) -> str:
    """A name for a set of rows, whatever their order: their number, and sum and exclusive or of their hashes."""
    h = F.xxhash64(*[F.to_json(F.struct(c)) for c in rows.columns])
    one = rows.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(38,0)")).alias("s")).first()
    return f"{one.n}-{(one.x or 0) & (2**64 - 1):016x}-{int(one.s or 0) & (2**64 - 1):016x}"


def unlogged(requests: DataFrame, log: str, key: str, request_id: str = "request_id") -> DataFrame:
    """The requests that no run but ``key`` itself has answered."""
    spark = requests.sparkSession
    ids = f"{log.rstrip('/')}_ids"
    paths = []
    for r in requests.select(_cell(F.col(request_id)).alias("c")).distinct().collect():       # ID_CELLS numbers at most
        p, fs = _fs(spark, f"{ids}/cell={r.c}")
        if fs.exists(p):
            paths.append(f"{ids}/cell={r.c}")
    if not paths:
        return requests
    known = spark.read.schema("request_id string, batch_id string").parquet(*paths).where(F.col("batch_id") != key)
    return requests.join(known.select(F.col("request_id").alias(request_id)), request_id, "left_anti")


def write_run(rows: DataFrame, log: str, key: str) -> DataFrame:
    """Write a run's answers, then its ids; returns the stored answers."""
    spark = rows.sparkSession
    path = f"{log.rstrip('/')}/batch_id={key}"
    rows.write.mode("overwrite").parquet(path)
    done = spark.read.schema(rows.schema).parquet(path)
    done.select("request_id", F.lit(key).alias("batch_id"), _cell(F.col("request_id")).alias("cell")) \
        .write.mode("append").partitionBy("cell").parquet(f"{log.rstrip('/')}_ids")
    return done
