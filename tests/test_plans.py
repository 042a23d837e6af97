"""Physical-plan properties that the design relies on at scale."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as ent
from docsift.operators import search as S

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(p: str) -> int:
    return len(re.findall(r"(?<!Broadcast)Exchange (hashpartitioning|RoundRobinPartitioning|rangepartitioning|"
                          r"SinglePartition)", p))


@pytest.mark.parametrize("name", ["clean_text", "token_count", "split_sentences", "split_paragraphs",
                                  "truncate_tokens", "extract_article", "split_headings"])
def test_row_wise_text_queries_do_not_shuffle(spark, name):
    p = plan(ent.queries()[name](spark, SF))
    assert shuffles(p) == 0, p


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(ent.queries()["knn_filtered"](spark, SF))
    assert "PushedFilters: [IsNotNull(label), LessThan(label,5)" in p
    p = plan(ent.queries()["diff_snapshots"](spark, SF))
    assert "Not(EqualTo(lang,es))" in p and "Not(EqualTo(lang,de))" in p
    assert p.count("ReadSchema: struct<doc_id:bigint,text:string,lang:string,source:string>") == 2
    p = plan(ent.queries()["metrics_over_time"](spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in p


def test_exact_search_is_partial_topk_not_pairs(spark):
    p = plan(ent.queries()["knn_exact_cosine"](spark, SF))
    assert "MapInArrow" in p
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_no_query_uses_nested_loop_or_cartesian(spark):
    found = []
    for name, fn in ent.queries().items():
        if name in ("chunk_topics", "chat_relevance_model", "knn_ivf", "ivf_recall", "knn_ivf_exact"):
            continue  # ML fits run jobs while planning; covered elsewhere
        p = plan(fn(spark, SF))
        if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p:
            found.append(name)
    assert found == []


def test_ivf_scan_prunes_cells(spark, scratch_dir):
    rng = np.random.default_rng(0)
    vecs = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=4)]) for i in range(64)],
                                 "chunk_id long, embedding array<float>")
    cen = S.build_ivf(vecs, scratch_dir + "/ivf", n_lists=4)
    index = spark.read.parquet(scratch_dir + "/ivf")
    q = spark.createDataFrame([(0, [1.0, 0.0, 0.0, 0.0])], "query_id long, embedding array<float>")
    p = plan(S.knn_ivf(q, index, cen, k=2, nprobe=1))
    assert re.search(r"PartitionFilters: \[isnotnull\(centroid#\d+\), \(?centroid#\d+ (IN \(\d+\)|= \d+)", p), p


def test_boilerplate_does_not_shuffle_text(spark):
    p = plan(ent.queries()["drop_boilerplate_lines"](spark, SF))
    # the only hash exchanges are on (source, line) counts and per-source sizes, not on doc ids
    assert "hashpartitioning(doc_id" not in p
