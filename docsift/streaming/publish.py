"""Incremental publishing (SNK-1, SNK-2, SNK-5..SNK-8, SRC-4).

Tables written by a stream are only ever written by that stream (a batch
append into a stream-written parquet table is not seen by readers of the
stream's log); snapshots written by batch jobs are only written by batch.
"""

from __future__ import annotations

import os
import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from docsift.session import checkpoint_root


def checkpoint_for(spark: SparkSession, target: str, root: str | None = None) -> str:
    """Checkpoint folder derived from the *target* name (one per table).

    The root must be configured (``spark.checkpoint.dir``) or given: a folder
    made up per process would start the stream anew after a restart, and the
    sink would skip the batches it has already committed.
    """
    if root is None:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir (or give a checkpoint): streams need a folder that outlives the process")
    safe = re.sub(r"[^A-Za-z0-9_.-]", "_", target)
    return os.path.join(root, "streams", safe)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def refuse_new_checkpoint(spark: SparkSession, sink: str | None, checkpoint: str) -> None:
    """A sink with committed batches and a checkpoint without any: the new
    stream's first batches would be taken for those already written and be
    lost.  Fail instead."""
    if sink and _exists(spark, os.path.join(sink, "_spark_metadata")) and not _exists(spark, os.path.join(checkpoint, "offsets")):
        raise ValueError(f"{sink} holds committed batches, but {checkpoint} is new; use its old checkpoint or a new target")


def table_location(spark: SparkSession, table: str) -> str | None:
    if not table_exists(spark, table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()   # one row
    return rows[0].data_type if rows else None


def publish_stream(df: DataFrame, table: str | None = None, path: str | None = None,
                   checkpoint: str | None = None, fmt: str = "parquet", partition_by=None,
                   await_done: bool = True):
    """SNK-1: run-to-completion append (``availableNow``) with a checkpoint.

    A second run with no new input writes nothing; returns the query (or
    its last progress when awaited).
    """
    if (table is None) == (path is None):
        raise ValueError("give exactly one of table or path")
    spark = df.sparkSession
    ck = checkpoint or checkpoint_for(spark, table or path)
    refuse_new_checkpoint(spark, path or table_location(spark, table), ck)
    w = (df.writeStream.format(fmt).outputMode("append").trigger(availableNow=True)
           .option("checkpointLocation", ck))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.toTable(table) if table else w.start(path)
    if not await_done:
        return q
    q.awaitTermination()
    return q


def read_table_stream(spark: SparkSession, table: str) -> DataFrame:
    """SRC-4: a stream of the rows appended to ``table``."""
    return spark.readStream.table(table)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, fmt: str = "parquet",
                 partition_by=None) -> None:
    """SNK-2: create the table with the declared columns if it is missing."""
    if spark.catalog.tableExists(name):
        return
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {fmt}{part}")


def reset_namespace(spark: SparkSession, db: str, root: str | None = None) -> str:
    """SNK-5: drop and recreate a database and move to a fresh checkpoint
    root (an old checkpoint with a dropped table would write nothing).
    Returns the new checkpoint root."""
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    base = root or checkpoint_root(spark)
    return os.path.join(base, f"{db}-{uuid.uuid4().hex[:12]}")


def use_namespace(spark: SparkSession, db: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    spark.catalog.setCurrentDatabase(db)


def table_exists(spark: SparkSession, name: str) -> bool:
    """SNK-6: any failure counts as 'does not exist'."""
    try:
        return spark.catalog.tableExists(name)
    except Exception:  # noqa: BLE001
        return False


def require_rows(df: DataFrame, message: str = "no rows") -> DataFrame:
    """SNK-7: persist, then fail if there is no row (reads at most one)."""
    df = df.persist()
    if df.isEmpty():
        df.unpersist()
        raise ValueError(message)
    return df


def rows_available(spark: SparkSession, table: str, n: int, tries: int = 10, wait_s: float = 10.0) -> bool:
    """SNK-8: bounded wait until ``table`` holds at least ``n`` rows."""
    for i in range(tries):
        if table_exists(spark, table) and spark.table(table).count() >= n:
            return True
        if i + 1 < tries:
            time.sleep(wait_s)
    return False


def publish_dense_ids(stream: DataFrame, path: str, order_by: list[str], id_col: str = "id", checkpoint: str | None = None):
    """SNK-3 on a stream: rows appended with ids 1, 2, ... without gaps, in
    ``order_by`` order within a micro-batch.

    ``<path>_ledger/<batch>.json`` notes the first id and the number of a
    micro-batch once its rows are written (``<path>/batch=<batch>``); the next
    one goes on from there.  A replayed micro-batch starts from its own entry,
    or from the last one if it was cut off, and overwrites its own folder.
    """
    import json

    from docsift.operators.chunking import dense_id
    from docsift.operators.versions import _fs
    spark = stream.sparkSession
    ck, ledger = checkpoint or checkpoint_for(spark, f"ids:{path}"), f"{path.rstrip('/')}_ledger"
    if _exists(spark, ledger) and not _exists(spark, os.path.join(ck, "offsets")):
        raise ValueError(f"{path} holds numbered batches, but {ck} is new; use its old checkpoint or a new target")

    def entry(n: int) -> dict | None:
        p, fs = _fs(spark, f"{ledger}/{n}.json")
        if not fs.exists(p):
            return None
        f = fs.open(p)
        try:
            return json.loads(bytes(f.readAllBytes()).decode())
        finally:
            f.close()

    def number(batch: DataFrame, n: int) -> None:
        mine, before = entry(n), entry(n - 1) if n else {"start": 1, "n": 0}
        start = mine["start"] if mine else before["start"] + before["n"]
        dense_id(batch, order_by, id_col, start).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={n}")
        if mine is None:
            p, fs = _fs(spark, f"{ledger}/{n}.json")
            out = fs.create(p, False)
            try:
                out.write(bytearray(json.dumps({"start": start, "n": spark.read.parquet(f"{path.rstrip('/')}/batch={n}").count()}).encode()))
            finally:
                out.close()

    q = stream.writeStream.foreachBatch(number).option("checkpointLocation", ck).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
