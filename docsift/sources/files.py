"""File sources (SRC-1..SRC-4, SRC-9..SRC-11, TXT-1)."""

from __future__ import annotations

from typing import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.session import ship_package

BINARY_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])

# Named datasets -> (table prefix, file name pattern).
DATASETS = {
    "docs": ("docs", "*"),
    "finance": ("finance", "{AAPL,TSLA}*"),
}


def files_pattern(symbols: Sequence[str]) -> str:
    """SRC-2/FLT-2: Hadoop glob matching files whose name starts with a symbol."""
    syms = sorted(set(symbols))
    return syms[0] + "*" if len(syms) == 1 else "{" + ",".join(syms) + "}*"


def source_for(name: str) -> tuple[str, str]:
    """SRC-3: (prefix, pattern) of a named dataset; unknown names raise."""
    if name not in DATASETS:
        raise KeyError(f"unknown dataset {name!r}; known: {sorted(DATASETS)}")
    return DATASETS[name]


def read_files(spark: SparkSession, folder: str, pattern: str = "*", suffix: str | None = None) -> DataFrame:
    """Batch binary-file scan of ``folder/pattern`` (optionally ``*.suffix`` only)."""
    r = spark.read.format("binaryFile")
    if suffix:
        r = r.option("pathGlobFilter", f"*.{suffix}")
    return r.load(f"{folder.rstrip('/')}/{pattern}")


def read_files_stream(spark: SparkSession, folder: str, pattern: str = "*", suffix: str | None = None,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC-1: incremental binary-file stream; each new path is read once
    across runs (progress lives in the sink's checkpoint)."""
    r = spark.readStream.schema(BINARY_SCHEMA).format("binaryFile")
    if suffix:
        r = r.option("pathGlobFilter", f"*.{suffix}")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(f"{folder.rstrip('/')}/{pattern}")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """SRC-9: path and length only -- the scan does not read file bytes."""
    return spark.read.format("binaryFile").load(folder).select("path", "length", "modificationTime")


def folder_is_empty(spark: SparkSession, folder: str) -> bool:
    """SRC-9: a missing folder counts as empty."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return True
    return len(fs.listStatus(p)) == 0


def exclude_names(df: DataFrame, needle: str = "NOTICE", path_col: str = "path") -> DataFrame:
    """SRC-10: drop entries whose file name contains ``needle``."""
    name = F.regexp_extract(F.col(path_col), r"([^/]+)$", 1)
    return df.filter(~name.contains(needle))


def session_facts(spark: SparkSession) -> DataFrame:
    """SRC-11: current catalog, database and user."""
    return spark.sql("SELECT current_catalog() AS catalog, current_database() AS database, current_user() AS user")


# ---------------------------------------------------------------- extraction

def text_sections(data: bytes) -> list:
    """Default extractor: UTF-8 text split at blank lines."""
    import re
    txt = data.decode("utf-8", errors="replace")
    return [s for s in re.split(r"\n\s*\n", txt) if s.strip()]


def html_sections(data: bytes) -> list:
    """HTML extractor: text of each heading-led section, tags removed.

    Script and style elements are dropped, the page is cut in front of every
    ``<h1>``..``<h6>``, tags become spaces and ASCII white-space runs one
    space (the same rules as the SQL twin, so the result is checkable).
    """
    import re
    html = data.decode("utf-8", errors="replace")
    html = re.sub(r"(?is)<script\b.*?</script>", " ", html)
    html = re.sub(r"(?is)<style\b.*?</style>", " ", html)
    parts = re.split(r"(?i)(?=<h[1-6])", html)
    out = []
    for p in parts:
        t = re.sub(r"[ \t\n\x0b\f\r]+", " ", re.sub(r"<[^>]*>", " ", p)).strip(" ")
        if t:
            out.append(t)
    return out


SLICE_BYTES = 4 * 1024 * 1024      # file contents that a task turns into Python objects at once (one file at least)


def byte_slices(b: pa.RecordBatch, content_col: str) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows, with contents of about ``SLICE_BYTES`` at most."""
    sizes = pc.fill_null(pc.binary_length(b.column(content_col)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > SLICE_BYTES:
            yield b.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if b.num_rows:
        yield b.slice(start)


def extract_sections(df: DataFrame, extractor: Callable[[bytes], list] = text_sections,
                     path_col: str = "path", content_col: str = "content") -> DataFrame:
    """TXT-1: bytes -> ordered sections ``(path, section_no, section)``.

    One extractor call per file inside ``mapInArrow``; a file that fails to
    extract fails the task.  Spreading the files over tasks is the
    caller's choice (``repartition`` before, when files are few and large).
    """
    ship_package(df.sparkSession)
    schema = T.StructType([T.StructField(path_col, T.StringType()), T.StructField("section_no", T.IntegerType()),
                           T.StructField("section", T.StringType())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            for b in byte_slices(whole, content_col):
                paths, nos, secs = [], [], []
                for p, c in zip(b.column(path_col).to_pylist(), b.column(content_col).to_pylist()):
                    if c is None:
                        continue
                    for i, s in enumerate(extractor(c)):
                        paths.append(p)
                        nos.append(i)
                        secs.append(s)
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(nos, pa.int32()),
                                                  pa.array(secs, pa.string())], schema=pa.schema(
                    [(path_col, pa.string()), ("section_no", pa.int32()), ("section", pa.string())]))

    return df.select(path_col, content_col).mapInArrow(run, schema)


def join_sections(sections: DataFrame, path_col: str = "path", clean=None) -> DataFrame:
    """TXT-3: cleaned sections joined by a line break, in section order.

    Groups by file: a file's sections are bounded by its size.
    """
    from docsift.functions.text import clean_text
    c = clean or clean_text
    st = F.struct(F.col("section_no"), c(F.col("section")).alias("s"))
    return sections.groupBy(path_col).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(st)), lambda x: x["s"]), "\n").alias("text"))


def extract_section_arrays(df: DataFrame, extractor: Callable[[bytes], list] = text_sections,
                           path_col: str = "path", content_col: str = "content") -> DataFrame:
    """TXT-1, streaming-friendly form: ``(path, sections array<string>)``, one
    row per file, so cleaning, joining and chunking stay row-wise (no
    aggregation, append mode works)."""
    ship_package(df.sparkSession)
    schema = T.StructType([T.StructField(path_col, T.StringType()),
                           T.StructField("sections", T.ArrayType(T.StringType()))])
    arrow_schema = pa.schema([(path_col, pa.string()), ("sections", pa.list_(pa.string()))])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            for b in byte_slices(whole, content_col):
                paths = b.column(path_col).to_pylist()
                secs = [None if c is None else list(extractor(c)) for c in b.column(content_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(secs, pa.list_(pa.string()))],
                                                 schema=arrow_schema)

    return df.select(path_col, content_col).mapInArrow(run, schema)


def keep_symbols(df: DataFrame, symbols: Sequence[str], path_col: str = "path") -> DataFrame:
    """FLT-2: keep files whose name starts with one of ``symbols``."""
    import re as _re
    name = F.regexp_extract(F.col(path_col), r"([^/]+)$", 1)
    alt = "|".join(_re.escape(s) for s in sorted(set(symbols)))
    return df.filter(name.rlike(f"^({alt})"))
