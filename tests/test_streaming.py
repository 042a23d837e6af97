import pytest
import os

import pyarrow as pa

from pyspark.sql import functions as F

from docsift.plans import ingest
from docsift.sources import files as SF
from docsift.streaming import publish as P


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_file_stream_is_incremental(spark, scratch_dir):
    src = os.path.join(scratch_dir, "in")
    out = os.path.join(scratch_dir, "raw")
    ck = os.path.join(scratch_dir, "ck")
    write(src, "a.txt", "first file")
    P.publish_stream(SF.read_files_stream(spark, src, suffix="txt"), path=out, checkpoint=ck)
    assert spark.read.parquet(out).count() == 1
    # second run adds nothing
    P.publish_stream(SF.read_files_stream(spark, src, suffix="txt"), path=out, checkpoint=ck)
    assert spark.read.parquet(out).count() == 1
    # a new file adds only its row; other suffixes are ignored
    write(src, "b.txt", "second file")
    write(src, "c.pdf", "not text")
    P.publish_stream(SF.read_files_stream(spark, src, suffix="txt"), path=out, checkpoint=ck)
    paths = sorted(r["path"].rsplit("/", 1)[-1] for r in spark.read.parquet(out).collect())
    assert paths == ["a.txt", "b.txt"]


def test_ingest_pipeline_tables(spark, scratch_dir):
    src = os.path.join(scratch_dir, "docs")
    write(src, "AAPL-1.txt", "Apple makes phones. It sells services.\n\nRevenue grew.")
    write(src, "TSLA-1.txt", "Tesla makes cars.")
    write(src, "MSFT-1.txt", "Not selected.")
    prefix, pattern = SF.source_for("finance")
    db = "ingest_test"
    P.use_namespace(spark, db)
    ingest.run_ingest(spark, src, f"{db}.raw", f"{db}.chunks", f"{db}.emb", pattern=pattern, suffix="txt",
                      size=5, overlap=2, dim=16)
    chunks = spark.table(f"{db}.chunks")
    assert {r["path"].rsplit("/", 1)[-1] for r in chunks.select("path").distinct().collect()} == \
        {"AAPL-1.txt", "TSLA-1.txt"}
    n1 = spark.table(f"{db}.emb").count()
    assert n1 == chunks.count() > 0
    ingest.run_ingest(spark, src, f"{db}.raw", f"{db}.chunks", f"{db}.emb", pattern=pattern, suffix="txt",
                      size=5, overlap=2, dim=16)
    assert spark.table(f"{db}.emb").count() == n1
    assert spark.table(f"{db}.emb").select(F.size("embedding")).distinct().first()[0] == 16
    P.reset_namespace(spark, db)
    assert not P.table_exists(spark, f"{db}.raw")
    spark.catalog.setCurrentDatabase("default")


def test_files_helpers(spark, scratch_dir):
    assert SF.files_pattern(["TSLA", "AAPL"]) == "{AAPL,TSLA}*"
    try:
        SF.source_for("Finance-SecFiles")
        assert False
    except KeyError:
        pass
    assert SF.folder_is_empty(spark, os.path.join(scratch_dir, "missing"))
    write(scratch_dir + "/f", "x-NOTICE.txt", "n")
    write(scratch_dir + "/f", "y.txt", "y")
    lst = SF.list_files(spark, scratch_dir + "/f")
    assert "content" not in lst.columns
    kept = SF.exclude_names(lst).collect()
    assert [r["path"].rsplit("/", 1)[-1] for r in kept] == ["y.txt"]
    assert not SF.folder_is_empty(spark, scratch_dir + "/f")
    assert SF.session_facts(spark).first()["database"] is not None


def test_extract_sections_and_join(spark):
    df = spark.createDataFrame([("p", bytearray(b"line one\nline .two\n\nsecond para"))], "path string, content binary")
    secs = SF.extract_sections(df).orderBy("section_no").collect()
    assert [s["section"] for s in secs] == ["line one\nline .two", "second para"]
    joined = SF.join_sections(SF.extract_sections(df)).first()["text"]
    assert joined == "line oneline.two\nsecond para"
    html = spark.createDataFrame([("h", bytearray(b"<h1>T</h1><p>a</p><script>x</script><h2>U</h2>b"))],
                                 "path string, content binary")
    assert [r["section"] for r in SF.extract_sections(html, SF.html_sections).collect()] == ["T a", "U b"]


def test_table_helpers(spark, scratch_dir):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("chunk_id", T.LongType()), T.StructField("content", T.StringType())])
    P.ensure_table(spark, "t_helpers", schema)
    assert P.table_exists(spark, "t_helpers")
    assert not P.table_exists(spark, "no.such.table.anywhere")
    assert not P.rows_available(spark, "t_helpers", 1, tries=1, wait_s=0)
    try:
        P.require_rows(spark.table("t_helpers"), "empty")
        assert False
    except ValueError:
        pass
    spark.sql("DROP TABLE t_helpers")


def test_metrics_stream_matches_batch_on_closed_windows(spark, scratch_dir):
    from docsift.operators.monitor import metrics_over_time
    from docsift.streaming.monitoring import metrics_stream
    rows = [(f"2024-01-0{d} 01:00:00", "a", float(d)) for d in range(1, 6)]
    src = os.path.join(scratch_dir, "ev")
    spark.createDataFrame(rows, "ts string, event_type string, value double") \
        .withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(src)
    stream = spark.readStream.schema("ts timestamp, event_type string, value double").parquet(src)
    out = os.path.join(scratch_dir, "m")
    P.publish_stream(metrics_stream(stream, "ts", "value", ["event_type"], watermark="1 hour"),
                     path=out, checkpoint=os.path.join(scratch_dir, "mck"))
    got = {r["window_start"]: r["n"] for r in spark.read.parquet(out).collect()}
    batch = {r["window_start"]: r["n"] for r in metrics_over_time(spark.read.parquet(src), "ts", "value",
                                                                   ["event_type"]).collect()}
    assert got and all(batch[k] == v for k, v in got.items())
    assert len(got) < len(batch)   # the last window is still open under the watermark


def test_sitemap(spark):
    xml = ('<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
           '<url><loc>https://a/1</loc></url><url><loc> https://a/2 </loc></url><url><loc>https://a/3</loc></url>'
           '</urlset>')
    df = spark.createDataFrame([(xml,)], "xml string")
    from docsift.sources.web import sitemap_urls
    assert [r["url"] for r in sitemap_urls(df).collect()] == ["https://a/1", "https://a/2", "https://a/3"]
    assert [r["url"] for r in sitemap_urls(df, max_documents=2).collect()] == ["https://a/1", "https://a/2"]


def test_fetch_pages_null_on_failure(spark):
    from docsift.sources.web import fetch_pages
    urls = spark.createDataFrame([("u1",), ("u2",)], "url string")
    got = dict(fetch_pages(urls, lambda us: [("<p>ok</p>" if u == "u1" else None) for u in us]).collect())
    assert got == {"u1": "<p>ok</p>", "u2": None}


def test_keep_symbols(spark):
    df = spark.createDataFrame([("/x/AAPL-2023.pdf",), ("/x/TSLA.pdf",), ("/x/MSFT.pdf",), ("/AAPL/x.pdf",)], "path string")
    assert [r[0] for r in SF.keep_symbols(df, ["TSLA", "AAPL"]).collect()] == ["/x/AAPL-2023.pdf", "/x/TSLA.pdf"]


def test_overwrite_in_place_is_ignored_and_reset_uses_new_root(spark, scratch_dir):
    import time as _t
    src = os.path.join(scratch_dir, "in2")
    write(src, "a.txt", "v1")
    db = "replay_test"
    P.use_namespace(spark, db)
    root = os.path.join(scratch_dir, "ck-root")
    ck = P.checkpoint_for(spark, f"{db}.raw", root)
    P.publish_stream(SF.read_files_stream(spark, src), table=f"{db}.raw", checkpoint=ck)
    assert spark.table(f"{db}.raw").count() == 1
    _t.sleep(1.1)
    write(src, "a.txt", "v2 changed in place")
    P.publish_stream(SF.read_files_stream(spark, src), table=f"{db}.raw", checkpoint=ck)
    assert spark.table(f"{db}.raw").count() == 1           # the file stream does not re-read it
    # dropping the table but keeping the old checkpoint would write nothing;
    # reset_namespace hands out a fresh checkpoint root instead
    new_root = P.reset_namespace(spark, db, root)
    assert new_root != root
    P.use_namespace(spark, db)
    P.publish_stream(SF.read_files_stream(spark, src), table=f"{db}.raw",
                     checkpoint=P.checkpoint_for(spark, f"{db}.raw", new_root))
    rows = spark.table(f"{db}.raw").collect()
    assert len(rows) == 1 and bytes(rows[0]["content"]).startswith(b"v2")
    spark.sql(f"DROP DATABASE {db} CASCADE")
    spark.catalog.setCurrentDatabase("default")


def test_checkpoint_per_target(spark):
    a = P.checkpoint_for(spark, "db.finance_chunks", "/shared")
    b = P.checkpoint_for(spark, "db.docs_chunks", "/shared")
    assert a != b and a.startswith("/shared/")


def test_serve_requests_logs_each_request_once(spark, scratch_dir):
    import json
    from docsift.operators import chat as CH
    from docsift.streaming.serve import read_requests_stream, serve_requests
    docs = spark.createDataFrame([(i, "spark streams data. spark runs sql fast.") for i in range(4)],
                                 "doc_id long, text string")
    chunks = docs.select(F.col("doc_id").alias("chunk_id"), F.concat(F.lit("doc/"), "doc_id").alias("path"),
                         F.col("text").alias("content"))
    lex = CH.corpus_lexicon(docs, min_df=2)
    req = os.path.join(scratch_dir, "req")
    os.makedirs(req)

    def drop(name, rows):
        with open(os.path.join(req, name), "w") as f:
            for r in rows:
                f.write(json.dumps(r) + "\n")

    drop("a.json", [{"request_id": "r1", "messages": [{"role": "user", "content": "does spark run sql"}]},
                    {"request_id": "r2", "messages": [{"role": "user", "content": "why is the sky blue"}]}])
    log = os.path.join(scratch_dir, "log")
    ck = os.path.join(scratch_dir, "serve-ck")
    serve_requests(read_requests_stream(spark, req), chunks, lex, log, ck, k=2, dim=64)
    got = {r["request_id"]: r for r in spark.read.parquet(log).collect()}
    assert got["r1"]["result"] == "spark runs sql fast." and len(got["r1"]["sources"]) == 2
    assert got["r2"]["sources"] == []
    serve_requests(read_requests_stream(spark, req), chunks, lex, log, ck, k=2, dim=64)
    assert spark.read.parquet(log).count() == 2
    drop("b.json", [{"request_id": "r3", "messages": [{"role": "user", "content": "spark sql"},
                                                       {"role": "assistant", "content": "yes"},
                                                       {"role": "user", "content": "does it stream data"}]}])
    serve_requests(read_requests_stream(spark, req), chunks, lex, log, ck, k=2, dim=64)
    rows = spark.read.parquet(log).collect()
    assert sorted(r["request_id"] for r in rows) == ["r1", "r2", "r3"]


def test_qa_tables_and_monitoring(spark, scratch_dir):
    from docsift.operators import chat as CH
    from docsift.operators.monitor import term_counts
    from docsift.plans import qa
    docs = spark.createDataFrame([(i, "spark streams data. spark runs sql fast.") for i in range(4)],
                                 "doc_id long, text string")
    chunks = docs.select(F.col("doc_id").alias("chunk_id"), F.concat(F.lit("doc/"), "doc_id").alias("path"),
                         F.col("text").alias("content"))
    log_path = os.path.join(scratch_dir, "answer_log")
    qs = spark.createDataFrame([(1, "does spark run sql")], "query_id long, question string")
    qa.answer_table(qs, chunks, log_path, k=2, dim=64)
    turns = spark.createDataFrame([(7, 0, "user", "spark streams data?"), (8, 0, "user", "why is the sky blue")],
                                  "conv_id long, turn long, role string, text string")
    qa.chat_table(turns, chunks, CH.corpus_lexicon(docs, min_df=2), log_path, k=2, dim=64)
    log = spark.read.parquet(log_path)
    assert sorted(r["request_id"] for r in log.collect()) == ["conv-7", "conv-8", "q-1"]
    m = qa.monitor_log(log, term_counts(docs), out_path=os.path.join(scratch_dir, "metrics")).collect()
    assert len(m) == 1 and m[0]["n_answers"] == 3 and abs(m[0]["refusal_rate"] - 1 / 3) < 1e-6


def test_a_new_checkpoint_on_a_committed_sink_is_refused(spark, scratch_dir):
    src, out = os.path.join(scratch_dir, "in"), os.path.join(scratch_dir, "out")
    os.makedirs(src)
    write(src, "a.txt", "one")
    P.publish_stream(SF.read_files_stream(spark, src, suffix="txt"), path=out, checkpoint=os.path.join(scratch_dir, "c1"))
    write(src, "b.txt", "two")
    with pytest.raises(ValueError, match="is new"):
        P.publish_stream(SF.read_files_stream(spark, src, suffix="txt"), path=out, checkpoint=os.path.join(scratch_dir, "c2"))
    P.publish_stream(SF.read_files_stream(spark, src, suffix="txt"), path=out, checkpoint=os.path.join(scratch_dir, "c1"))
    assert spark.read.parquet(out).count() == 2


def test_few_bytes_of_files_are_extracted_at_once(spark, monkeypatch):
    """Sections leave a task in slices of whole files, not a batch at a time."""
    monkeypatch.setattr(SF, "SLICE_BYTES", 100)
    rows = [(f"p{i}", None if i == 3 else (f"part {i}" + "x" * (i * 7) + "\n\nend").encode()) for i in range(40)]
    tasks = []

    class Frame:                       # takes the task function instead of running it
        sparkSession = spark

        def select(self, *cols):
            return self

        def mapInArrow(self, run, schema):
            tasks.append(run)
    SF.extract_section_arrays(Frame())
    b = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.binary())], ["path", "content"])
    out = list(tasks[0](iter([b, b.slice(0, 0)])))
    sizes = {p: len(c or b"") for p, c in rows}
    assert len(out) > 10 and all(o.num_rows == 1 or sum(sizes[p] for p in o.column(0).to_pylist()) <= 100 for o in out)
    got = [x for o in out for x in zip(o.column(0).to_pylist(), o.column(1).to_pylist())]
    assert got == [(p, None if c is None else SF.text_sections(c)) for p, c in rows]
