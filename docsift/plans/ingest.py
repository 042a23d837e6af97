"""Entry A as incremental streams: files -> raw -> chunks -> embeddings -> index.

Each stage is an append-only stream with its own checkpoint, run with
``availableNow`` so a re-run processes only new files.  Text is extracted
and chunked once (embeddings read the chunk table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.functions.text import clean_text
from docsift.operators.chunking import chunk_key, chunk_sentences_col
from docsift.operators import index as IX
from docsift.operators import versions as VS
from docsift.operators.embedding import embed, hash_vector
from docsift.session import stored
from docsift.sources.files import extract_section_arrays, read_files, read_files_stream, text_sections
from docsift.streaming.publish import publish_stream, read_table_stream


def chunk_files(raw: DataFrame, extractor=text_sections, size: int = 500, overlap: int = 50) -> DataFrame:
    """raw files -> (chunk_id, path, chunk_no, content); row-wise, stream-safe."""
    secs = extract_section_arrays(raw, extractor)
    text = F.array_join(F.transform("sections", lambda s: clean_text(s)), "\n")
    ch = secs.select("path", F.posexplode(chunk_sentences_col(text, size, overlap)).alias("chunk_no", "content"))
    return ch.select(chunk_key("path", "chunk_no", "content").alias("chunk_id"), "path", "chunk_no", "content")


def embed_chunks(chunks: DataFrame, dim: int = 256, model=None) -> DataFrame:
    """Adds ``embedding``: the hash model's (``dim`` finite numbers as it is
    made), or an injected one's, whose vectors are checked where they arrive."""
    if model is not None:
        return embed(chunks, "content", model, dim=dim)
    return chunks.withColumn("embedding", hash_vector(F.col("content"), dim))


def run_ingest(spark: SparkSession, folder: str, raw_table: str, chunk_table: str, emb_table: str,
               pattern: str = "*", suffix: str | None = None, extractor=text_sections,
               size: int = 500, overlap: int = 50, dim: int = 256) -> None:
    """SRC-1 -> SNK-1 (raw) -> SRC-4 -> TXT-1/2/6 -> SNK-1 (chunks) -> EMB-6 -> SNK-1 (embeddings)."""
    publish_stream(read_files_stream(spark, folder, pattern, suffix), table=raw_table)
    publish_stream(chunk_files(read_table_stream(spark, raw_table), extractor, size, overlap), table=chunk_table)
    publish_stream(embed_chunks(read_table_stream(spark, chunk_table), dim), table=emb_table)


def run_index(spark: SparkSession, chunk_table: str, root: str, centroids=None, dim: int = 256, model=None) -> int:
    """SCH-7: bring the versioned index under ``root`` in step with the chunk
    table; only new and changed chunks are embedded, only their cells are
    written.  Cells are those of ``centroids``, or hashes of the key.
    Returns the version."""
    source = spark.table(chunk_table).select("chunk_id", "path", "chunk_no", "content")
    return VS.sync(spark, root, source, "chunk_id", index_rows(centroids, dim, model))


HASH_CELLS = 64


def index_rows(centroids=None, dim: int = 256, model=None, key: str = "chunk_id"):
    """Chunk rows -> index rows (embedding, cell), for ``versions.sync``."""
    def make(rows: DataFrame) -> DataFrame:
        out = embed_chunks(rows, dim, model)
        if centroids is None:
            return out.withColumn("centroid", F.pmod(F.xxhash64(key), F.lit(HASH_CELLS)).cast("int"))
        from docsift.operators.search import assign_cells
        return assign_cells(out, centroids)
    return make


PATHS = 10_000          # changed files read by name up to this many, else by a scan of the folder


def refresh_files(spark: SparkSession, folder: str, root: str, pattern: str = "*", suffix: str | None = None,
                  extractor=text_sections, size: int = 500, overlap: int = 50) -> int:
    """SRC-1 with edits and deletions: the chunks under ``root/chunks`` (a
    versioned table) become those of the files that are there now.

    The files' names, times and lengths are compared with those of the last
    run (``root/files``); only new and changed files are read and extracted,
    chunks of changed and deleted ones go.  Chunks are committed before the
    file list: a run cut off between the two extracts the same files again.
    Returns the version of the chunks.
    """
    cell = F.pmod(F.xxhash64("path"), F.lit(HASH_CELLS)).cast("int").alias("cell")
    files, chunks = f"{root.rstrip('/')}/files", f"{root.rstrip('/')}/chunks"
    scan = read_files(spark, folder, pattern, suffix)
    facts = stored(scan.select("path", "modificationTime", "length"), "files")          # reads no bytes of the files
    if VS.manifest(spark, files) is None:
        todo, stale = facts.select("path"), facts.limit(0).select("path")
    else:
        diff = stored(IX.diff_snapshots(VS.read_version(spark, files).drop("cell"), facts, "path", ["modificationTime", "length"]), "diff")
        todo = diff.where("change_type <> 'delete'").select("path")
        stale = diff.where("change_type <> 'insert'").select("path")
    names = [r.path for r in todo.limit(PATHS + 1).collect()]
    if not names:
        changed = scan.limit(0)
    elif len(names) <= PATHS and not any(set(n) & set("*?[]{}\\") for n in names):
        changed = spark.read.format("binaryFile").load(names)
    else:
        changed = scan.join(todo, "path", "left_semi")
    fresh = chunk_files(changed, extractor, size, overlap).select("*", cell)
    if VS.manifest(spark, chunks) is None:
        gone = spark.createDataFrame([], "chunk_id long, cell int")
    else:
        # a first run cut off after its chunks has no file list: its files count as stale, too
        old = VS.read_version(spark, chunks)
        gone = old.join(stale.union(todo).distinct(), "path", "left_semi").select("chunk_id", "cell")
    version = VS.replace_rows(spark, chunks, ["chunk_id"], gone, fresh, "cell")
    VS.sync(spark, files, facts, "path", lambda rows: rows.select("*", cell), "cell")
    return version
