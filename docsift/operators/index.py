"""Index maintenance (SNK-4, SCH-7, SCH-8): snapshot diff and keyed upserts.

No table format with MERGE or a change feed is assumed: a new snapshot is
computed from the old one plus changes and written as a new version
(``.../v=N``), by batch jobs only.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def diff_snapshots(old: DataFrame, new: DataFrame, key: str | Sequence[str],
                   cols: Sequence[str] | None = None) -> DataFrame:
    """SNK-4: changes from ``old`` to ``new`` keyed by ``key``.

    Full outer join on the key; a row changed if any of ``cols`` differs by
    null-safe equality (a value that moved to another column, or became
    null, is a change).  Returns ``key..., change_type`` (insert / update /
    delete) and the new values; unchanged rows are not reported.  Keys are
    unique per snapshot, so the join has no hot key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = list(cols) if cols is not None else [c for c in new.columns if c not in keys]
    o = old.select(*keys, *[F.col(c).alias(f"_o_{i}") for i, c in enumerate(cols)], F.lit(True).alias("_ho"))
    n = new.select(*keys, *cols, F.lit(True).alias("_hn"))
    j = o.join(n, keys, "full_outer")
    same = F.lit(True)
    for i, c in enumerate(cols):
        same = same & F.col(f"_o_{i}").eqNullSafe(F.col(c))
    ct = (F.when(F.col("_ho").isNull(), F.lit("insert"))
           .when(F.col("_hn").isNull(), F.lit("delete"))
           .when(~same, F.lit("update")))
    return j.withColumn("change_type", ct).filter(F.col("change_type").isNotNull()) \
            .select(*keys, "change_type", *cols)


def apply_changes(base: DataFrame, changes: DataFrame, key: str | Sequence[str],
                  version_col: str = "version", op_col: str = "op") -> DataFrame:
    """SCH-8: upsert / delete rows of a direct index.

    The last write per key wins (partial aggregation makes a key written many
    times cheap); of writes with the same version the one whose operation and
    values order last wins, so the result does not depend on row order.  A
    null version fails the job.  Keys touched by a change are removed from
    ``base`` (left anti) and the surviving upserts appended.  Columns of
    ``changes`` other than key/op/version must match ``base``; null values
    are kept as written.
    """
    keys = [key] if isinstance(key, str) else list(key)
    payload = [c for c in base.columns if c not in keys]
    version = F.when(F.col(version_col).isNull(), F.raise_error(F.lit(f"null {version_col} in changes"))) \
        .otherwise(F.col(version_col))
    last = (changes.groupBy(*keys)
                   .agg(F.max(F.struct(version.alias("_v"), op_col, *payload)).alias("_w"))
                   .select(*keys, "_w.*").drop("_v"))
    kept = base.join(last.select(*keys), keys, "left_anti")
    ups = last.filter(F.col(op_col) != "delete").select(*keys, *payload)
    return kept.unionByName(ups)


def next_version_path(root: str, spark) -> tuple[str, int]:
    """Snapshot folders are ``root/v=N``; returns the next free one (an
    unfinished one is skipped, not reused)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(conf)
    n = 0
    if fs.exists(path):
        for st in fs.listStatus(path):
            name = st.getPath().getName()
            if name.startswith("v=") and name[2:].isdigit():
                n = max(n, int(name[2:]) + 1)
    return f"{root.rstrip('/')}/v={n}", n


def sync_index(old_index: DataFrame | None, source: DataFrame, key: str, centroids: np.ndarray | None,
               embed_fn, text_col: str = "content") -> DataFrame:
    """SCH-7: bring an index snapshot in step with its source table.

    Only inserted and updated rows are embedded (and assigned a cell);
    deleted keys drop out; untouched rows are carried over as they are.
    Returns the new snapshot (the caller writes it as the next version).
    """
    from docsift.operators.search import assign_cells
    src_cols = source.columns
    if old_index is None:
        todo = source
        kept = None
    else:
        ch = diff_snapshots(old_index.select(*src_cols), source, key, [c for c in src_cols if c != key])
        todo = ch.filter(F.col("change_type") != "delete").select(*src_cols)
        kept = old_index.join(ch.select(key), key, "left_anti")
    fresh = embed_fn(todo)
    if centroids is not None:
        fresh = assign_cells(fresh, centroids)
    return fresh if kept is None else kept.unionByName(fresh.select(*kept.columns))


def write_snapshot(df: DataFrame, root: str, partition_by: Sequence[str] | None = ("centroid",)) -> str:
    """Write ``df`` as the next snapshot version ``root/v=N`` (batch writer only);
    partitioned by cell when the column exists.  Returns the path."""
    spark = df.sparkSession
    path, _ = next_version_path(root, spark)
    w = df.write.mode("errorifexists")
    cols = [c for c in (partition_by or []) if c in df.columns]
    if cols:
        w = w.partitionBy(*cols)
    w.parquet(path)
    return path


def read_latest(spark, root: str) -> DataFrame:
    """The newest complete snapshot under ``root``: the highest version whose
    folder has the writer's commit marker; a write cut off has none."""
    _, n = next_version_path(root, spark)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for v in range(n - 1, -1, -1):
        done = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/v={v}/_SUCCESS")
        if done.getFileSystem(conf).exists(done):
            return spark.read.parquet(f"{root.rstrip('/')}/v={v}")
    raise FileNotFoundError(f"no complete snapshot under {root}")
