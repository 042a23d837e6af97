"""SCH-7: versions of a stored table that share files.

A table is partitioned by a cell (a centroid's number, or a hash of the key).
A version is a *manifest*: for every cell, the version that wrote its files.

    root/data/v=<n>/<cell column>=<c>/part-*     the cells that version n wrote
    root/manifest/<n>.json                       {"cells": {c: v}, "schema": ..., "note": {...}}

A change rewrites the cells it touches and no others; all other entries of the
manifest go on pointing to older files, so a reader of version N sees N after
N+1 is written.  The manifest is made last, by exclusive creation: a write cut
off leaves files that nothing points to, and of two writers of one version one
fails.  Only cell numbers and counts pass through the driver.

Every stored row carries two hashes of its source columns, so a comparison
with a new source reads keys, hashes and cells of the old rows and nothing
else of them.  Keys are unique per version and never null.
"""

from __future__ import annotations

import json
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.session import stored

HASHES = ("_h1", "_h2")


# ---------------------------------------------------------------- manifests

def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[int]:
    """The version numbers that have a manifest, ascending."""
    p, fs = _fs(spark, f"{root.rstrip('/')}/manifest")
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict | None:
    """The manifest of a version (the newest that was written to its end); None if there is none."""
    for n in reversed(versions(spark, root) if version is None else [version]):
        p, fs = _fs(spark, f"{root.rstrip('/')}/manifest/{n}.json")
        stream = fs.open(p)
        try:
            text = bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            if version is not None:
                raise
    return None


def _commit(spark: SparkSession, root: str, found: dict) -> None:
    p, fs = _fs(spark, f"{root.rstrip('/')}/manifest/{found['version']}.json")
    out = fs.create(p, False)                       # fails where the version exists
    try:
        out.write(bytearray(json.dumps(found).encode("utf-8")))
    finally:
        out.close()


def _next(spark: SparkSession, root: str) -> int:
    """A version that neither a manifest nor files cut off have used."""
    p, fs = _fs(spark, f"{root.rstrip('/')}/data")
    used = [int(s.getPath().getName()[2:]) for s in fs.listStatus(p) if s.getPath().getName().startswith("v=")] if fs.exists(p) else []
    return max([*used, *versions(spark, root)], default=-1) + 1


def read_version(spark: SparkSession, root: str, version: int | None = None, cells: Sequence[int] | None = None,
                 hashes: bool = False) -> DataFrame:
    """The rows of a version (the newest by default); with ``cells`` only the files of those."""
    m = manifest(spark, root, version)
    if m is None:
        raise FileNotFoundError(f"no version under {root}")
    schema = T.StructType.fromJson(m["schema"])
    cell = m["cell"]
    base = f"{root.rstrip('/')}/data"
    paths = [f"{base}/v={v}/{cell}={c}" for c, v in sorted(m["cells"].items()) if cells is None or int(c) in set(cells)]
    names = [f.name for f in schema.fields if hashes or f.name not in HASHES]
    if not paths:
        return spark.createDataFrame([], schema).select(*names)
    return spark.read.option("basePath", base).schema(T.StructType([*schema.fields, T.StructField("v", T.IntegerType())])).parquet(*paths).select(*names)


# ---------------------------------------------------------------- writing

def row_hashes(cols: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of the columns; a null is told from a value that moved beside it."""
    parts = [*[F.col(c).isNull() for c in cols], *[F.col(c) for c in cols]]
    return [F.xxhash64(*parts).alias(HASHES[0]), F.xxhash64(F.lit(1), *parts).alias(HASHES[1])]


def _write(rows: DataFrame, root: str, before: dict | None, touched: Sequence[int], cell: str, note: dict) -> int:
    """Files of the touched cells and the manifest that points to them."""
    spark = rows.sparkSession
    n = _next(spark, root)
    rows.write.partitionBy(cell).parquet(f"{root.rstrip('/')}/data/v={n}")
    p, fs = _fs(spark, f"{root.rstrip('/')}/data/v={n}")
    written = [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(p) if s.getPath().getName().startswith(f"{cell}=")]
    gone = set(map(str, touched))
    cells = {c: v for c, v in (before["cells"] if before else {}).items() if c not in gone} | {str(c): n for c in written}
    _commit(spark, root, {"version": n, "cell": cell, "cells": cells, "schema": json.loads(rows.schema.json()),
                          "note": (before["note"] if before else {}) | note})
    return n


def replace_rows(spark: SparkSession, root: str, key: Sequence[str], gone: DataFrame, fresh: DataFrame, cell: str,
                 note: dict | None = None) -> int:
    """The next version: without the keys of ``gone`` (key..., cell: where they
    are now), with the rows of ``fresh`` (which has the cell column).

    Returns the version; without any change the present one (only a new
    ``note`` makes a version then, of no files).
    """
    before = manifest(spark, root)
    gone, fresh = stored(gone.select(*key, cell), "gone"), stored(fresh, "fresh")    # read by the cells and by the write
    touched = sorted(r[0] for r in gone.select(cell).union(fresh.select(cell)).distinct().collect())   # cell numbers
    if not touched and before is not None:
        if not note or {**before["note"], **note} == before["note"]:
            return before["version"]
        n = _next(spark, root)
        _commit(spark, root, before | {"version": n, "note": before["note"] | note})
        return n
    rows = fresh
    if before is not None:
        old = read_version(spark, root, before["version"], touched, hashes=True)
        rows = old.join(gone.select(*key), list(key), "left_anti").select(*old.columns).unionByName(fresh.select(*old.columns))
    return _write(rows, root, before, touched, cell, note or {})


def sync(spark: SparkSession, root: str, source: DataFrame, key: str | Sequence[str], make: Callable[[DataFrame], DataFrame],
         cell: str = "centroid", note: dict | None = None) -> int:
    """Bring the stored table in step with ``source`` and return its version.

    ``make`` turns source rows into stored rows (embedding, cell); it sees
    inserted and updated rows only.  Rows whose keys are not in ``source`` go.
    """
    keys = [key] if isinstance(key, str) else list(key)
    src = source.select("*", *row_hashes([c for c in source.columns if c not in keys]))
    if manifest(spark, root) is None:
        none = source.limit(0).select(*keys, F.lit(0).alias(cell))
        return replace_rows(spark, root, keys, none, make(src), cell, note)
    old = read_version(spark, root, hashes=True).select(*keys, F.col(HASHES[0]).alias("_o1"), F.col(HASHES[1]).alias("_o2"), cell)
    both = old.withColumn("_old", F.lit(True)).join(src.select(*keys, *HASHES).withColumn("_new", F.lit(True)), keys, "full_outer")
    same = F.col("_old") & F.col("_new") & F.col("_o1").eqNullSafe(F.col(HASHES[0])) & F.col("_o2").eqNullSafe(F.col(HASHES[1]))
    diff = stored(both.where(~F.coalesce(same, F.lit(False))).select(*keys, "_old", "_new", cell), "diff")
    todo = src.join(diff.where("_new").select(*keys), keys, "left_semi").select(*src.columns)
    return replace_rows(spark, root, keys, diff.where("_old").select(*keys, cell), make(todo), cell, note)


def apply_changes(spark: SparkSession, root: str, changes: DataFrame, key: str | Sequence[str], make: Callable[[DataFrame], DataFrame],
                  order: Sequence[str], op: str = "op", cell: str = "centroid", note: dict | None = None) -> int:
    """SCH-8 on the stored table: upserts and deletes, the last of a key by
    ``order``; keys it does not name stay.  Other columns are source columns."""
    keys = [key] if isinstance(key, str) else list(key)
    payload = [c for c in changes.columns if c not in (*keys, *order, op)]
    last = stored(changes.groupBy(*keys).agg(F.max_by(F.struct(op, *payload), F.struct(*order)).alias("_w")).select(*keys, "_w.*"), "last")
    ups = last.where(F.col(op) != "delete").select(*keys, *payload)
    fresh = make(ups.select("*", *row_hashes(payload)))
    if manifest(spark, root) is None:
        gone = last.limit(0).select(*keys, F.lit(0).alias(cell))
    else:
        gone = read_version(spark, root).select(*keys, cell).join(last.select(*keys), keys, "left_semi")
    return replace_rows(spark, root, keys, gone, fresh, cell, note)


def drop_versions(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Forget all but the newest ``keep`` versions and delete the files that none of these points to."""
    numbers = versions(spark, root)
    kept, old = numbers[-keep:], numbers[:-keep]
    held = {(int(v), c) for n in kept for c, v in manifest(spark, root, n)["cells"].items()}
    gone = []
    for n in old:
        p, fs = _fs(spark, f"{root.rstrip('/')}/manifest/{n}.json")
        m = manifest(spark, root, n)
        fs.delete(p, False)
        for c, v in m["cells"].items():
            if (int(v), c) not in held:
                q, fs = _fs(spark, f"{root.rstrip('/')}/data/v={v}/{m['cell']}={c}")
                if fs.delete(q, True):
                    gone.append(f"v={v}/{m['cell']}={c}")
    return gone
