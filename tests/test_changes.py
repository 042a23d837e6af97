import os
import time

from pyspark.sql import functions as F

from docsift.operators import versions as VS
from docsift.plans import ingest, qa
from docsift.streaming import changes as CG

SCHEMA = "chunk_id long, content string"


def make(rows):
    return ingest.index_rows(None, 16)(rows)


def test_following_the_log_equals_the_batch_diff(spark, scratch_dir):
    log, root = f"{scratch_dir}/log", f"{scratch_dir}/index"
    snaps = [spark.createDataFrame(x, SCHEMA) for x in (
        [], [(1, "a"), (2, "b"), (3, None)], [(1, "a"), (2, "bb"), (4, "d")], [(2, "bb"), (4, "dd"), (5, "e"), (3, "c")])]
    ck = f"{scratch_dir}/ck"

    def upto(n):
        got = {r.chunk_id: (r.content, r.embedding) for r in VS.read_version(spark, root).collect()}
        assert got == {r.chunk_id: (r.content, r.embedding) for r in ingest.embed_chunks(snaps[n], 16).collect()}
    CG.append_diff(snaps[0], snaps[1], "chunk_id", log)
    schema = CG.read_log(spark, log).drop("_commit", "_seq").schema
    CG.follow(spark, log, schema, root, "chunk_id", make, checkpoint=ck)
    upto(1)
    assert CG.append_diff(snaps[1], snaps[2], "chunk_id", log) == 2 and CG.append_diff(snaps[2], snaps[3], "chunk_id", log) == 3
    v = CG.follow(spark, log, schema, root, "chunk_id", make, checkpoint=ck)
    upto(3)
    assert CG.follow(spark, log, schema, root, "chunk_id", make, checkpoint=ck) == v                        # nothing new
    assert CG.follow(spark, log, schema, root, "chunk_id", make, checkpoint=f"{scratch_dir}/other") == v    # a replay repeats nothing
    upto(3)
    assert CG.read_log(spark, log, 2).count() == 4 and CG.commits(spark, log) == [1, 2, 3]
    CG.append_changes(spark.createDataFrame([(9, None, "delete")], schema), log)                            # of a key that is not there
    CG.follow(spark, log, schema, root, "chunk_id", make, checkpoint=ck)
    assert VS.manifest(spark, root)["note"] == {"applied": 4}
    upto(3)


def write(folder, name, text):
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def chunk_rows(spark, root):
    return sorted(map(tuple, VS.read_version(spark, f"{root}/chunks").select("path", "chunk_no", "content").collect()))


def test_edited_deleted_and_added_files(spark, scratch_dir):
    folder, root = f"{scratch_dir}/in", f"{scratch_dir}/store"
    os.makedirs(folder)
    for i in range(5):
        write(folder, f"f{i}.txt", f"File {i} is here. It has two sentences.\n\nAnd a section.")

    def extract(data):
        from docsift.sources.files import text_sections
        return text_sections(data)
    assert ingest.refresh_files(spark, folder, root, extractor=extract, size=6, overlap=0) == 0
    first = VS.manifest(spark, f"{root}/chunks")
    assert ingest.refresh_files(spark, folder, root, extractor=extract, size=6, overlap=0) == 0      # as it was
    time.sleep(0.05)
    write(folder, "f1.txt", "Now shorter.")
    os.unlink(os.path.join(folder, "f2.txt"))
    write(folder, "g[1].txt", "A new file. With a strange name.")
    assert ingest.refresh_files(spark, folder, root, extractor=extract, size=6, overlap=0) == 1
    other = f"{scratch_dir}/fresh"
    ingest.refresh_files(spark, folder, other, extractor=extract, size=6, overlap=0)
    assert chunk_rows(spark, root) == chunk_rows(spark, other)
    assert not any("f2.txt" in p for p, *_ in chunk_rows(spark, root)) and any("g[1]" in p for p, *_ in chunk_rows(spark, root))
    kept = [c for c, v in VS.manifest(spark, f"{root}/chunks")["cells"].items() if v == 0 and first["cells"].get(c) == 0]
    assert kept                                                        # cells without a change keep their files


def test_a_table_of_questions_is_logged_once(spark, scratch_dir):
    log = f"{scratch_dir}/answers"
    chunks = spark.createDataFrame([(1, "p", "The red fox runs."), (2, "q", "Blue whales swim.")], "chunk_id long, path string, content string")
    asked = spark.createDataFrame([(1, "red fox"), (2, "whales")], "query_id long, question string")
    for _ in range(2):
        assert qa.answer_table(asked, chunks, log, k=1, dim=64).count() == 2
    more = asked.union(spark.createDataFrame([(3, "fox")], asked.schema))
    assert [r.request_id for r in qa.answer_table(more, chunks, log, k=1, dim=64).collect()] == ["q-3"]
    got = sorted((r.request_id, r.result) for r in spark.read.parquet(log).collect())
    assert got == [("q-1", "The red fox runs."), ("q-2", "Blue whales swim."), ("q-3", "The red fox runs.")]
    assert qa.answer_table(asked.where(F.lit(False)), chunks, log, k=1, dim=64).count() == 0


def test_null_sources_are_cleaned_like_others(spark):
    from docsift.operators import cleanup as CL
    docs = spark.createDataFrame([(i, None if i < 6 else "s", f"head\nbody {i}") for i in range(12)], "doc_id long, source string, text string")
    got = {r.doc_id: (r.source, r.text, r.n_removed) for r in CL.drop_boilerplate_lines(docs, min_docs=3).collect()}
    assert got == {i: (None if i < 6 else "s", f"body {i}", 1) for i in range(12)}


def test_the_lexicon_of_a_corpus_copied_ten_times(spark):
    from docsift.operators import chat as CH
    docs = spark.createDataFrame([(i, f"common {'half' if i % 2 else ''} own{i}") for i in range(40)], "doc_id long, text string")
    ten = docs.crossJoin(spark.range(10).withColumnRenamed("id", "n")).select((F.col("doc_id") + 1000 * F.col("n")).alias("doc_id"), "text")
    a, b = (sorted(r.term for r in CH.corpus_lexicon(d, min_share=0.1).collect()) for d in (docs, ten))
    assert a == b == ["common", "half"]
