"""SNK-4: an ordered change log, and a stream that keeps a stored index in step.

    log/c-<n>/part-*      rows (_commit, _seq, key..., op, columns...)

A commit is written aside and renamed, so all of its files appear at once; it
takes the number after the last one and fails if another writer took it.
``op`` is ``upsert`` or ``delete``; order is (_commit, _seq).

``follow`` reads new commits as a stream and applies them to a versioned index
(``operators.versions``).  The index's manifest notes the last commit applied,
made in the same step as the version, so a replayed micro-batch or a new
checkpoint neither loses nor repeats a change.
"""

from __future__ import annotations

import uuid
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.operators import index as IX
from docsift.operators import versions as VS
from docsift.streaming.publish import checkpoint_for

COMMIT, SEQ, OP = "_commit", "_seq", "op"


def commits(spark: SparkSession, log: str) -> list[int]:
    """Commit numbers in the log, ascending."""
    p, fs = VS._fs(spark, log)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n[2:]) for n in names if n.startswith("c-") and n[2:].isdigit())


def append_changes(changes: DataFrame, log: str) -> int:
    """Add one commit; ``changes`` has ``op``, the key and the columns, one row
    per key.  Returns its number."""
    spark = changes.sparkSession
    n = max(commits(spark, log), default=0) + 1
    aside = f"{log.rstrip('/')}/_writing-{uuid.uuid4().hex}"
    changes.select(F.lit(n).cast("long").alias(COMMIT), F.monotonically_increasing_id().alias(SEQ), *changes.columns).write.parquet(aside)
    src, fs = VS._fs(spark, aside)
    dst, _ = VS._fs(spark, f"{log.rstrip('/')}/c-{n}")
    if fs.exists(dst) or not fs.rename(src, dst):
        raise RuntimeError(f"commit {n} of {log} exists already: another writer was first")
    return n


def append_diff(old: DataFrame, new: DataFrame, key: str | Sequence[str], log: str) -> int:
    """The changes from one snapshot to the next as a commit."""
    d = IX.diff_snapshots(old, new, key)
    return append_changes(d.withColumn(OP, F.when(F.col("change_type") == "delete", "delete").otherwise("upsert")).drop("change_type"), log)


def read_log(spark: SparkSession, log: str, after: int = 0) -> DataFrame:
    """The changes of all commits above ``after``."""
    paths = [f"{log.rstrip('/')}/c-{n}" for n in commits(spark, log) if n > after]
    if not paths:
        raise FileNotFoundError(f"no commit above {after} in {log}")
    return spark.read.parquet(*paths)


def follow(spark: SparkSession, log: str, schema: T.StructType, root: str, key: str | Sequence[str],
           make: Callable[[DataFrame], DataFrame], cell: str = "centroid", checkpoint: str | None = None) -> int | None:
    """Apply every commit that the index does not have yet (run to completion)
    and return the index's version.  ``schema``: the columns given to
    ``append_changes``."""
    full = T.StructType([T.StructField(COMMIT, T.LongType()), T.StructField(SEQ, T.LongType()), *schema.fields])

    def apply(batch: DataFrame, _: int) -> None:
        at = VS.manifest(spark, root)
        applied = (at or {"note": {}})["note"].get("applied", 0)
        new = batch.where(F.col(COMMIT) > applied)
        last = new.agg(F.max(COMMIT)).first()[0]
        if last is not None:
            VS.apply_changes(spark, root, new, key, make, [COMMIT, SEQ], OP, cell, {"applied": last})

    q = (spark.readStream.schema(full).parquet(f"{log.rstrip('/')}/c-*").writeStream.foreachBatch(apply)
         .option("checkpointLocation", checkpoint or checkpoint_for(spark, f"follow:{log}:{root}")).trigger(availableNow=True).start())
    q.awaitTermination()
    found = VS.manifest(spark, root)
    return None if found is None else found["version"]
