"""The corpus pipeline: quality, near duplicates, secrets, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and works on every row that the stage
before it kept.  All but the last return the columns of documents.

* quality: documents the classifier rejects (score below its threshold) go;
  the classifier is trained on the labelled rows of ``documents``;
* near_duplicates: one document of every Jaccard component stays, the one
  with the smallest id;
* secrets: text inside a secret's span is replaced by ``[kind]``;
* mixture: each document is repeated as often as its source's rate says
  (0, 1 or 2 times);
* tokens: ids of every whole text, and digests of ids and decoded text.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from docsift.llm import bpe, jaccard_join, mixing, quality_model, secrets  # noqa: E402
from docsift.llm.common import documents, stage  # noqa: E402
from docsift.session import ship_package  # noqa: E402

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = quality_model.fit(documents(spark, sf_dir, "doc_id", "text"), labels)
    return quality_model.score(docs, model).where(F.col("quality_score") >= quality_model.THRESHOLD).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return jaccard_join.keep_one(docs).select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return secrets.redact(secrets.scan(docs)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return mixing.emit(mixing.mix(docs)).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return bpe.round_trip(docs, bpe.tokenizer_path(), keep=("doc_id", "source"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secret_scan),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: SQL has no boosted trees and no BPE; tests hold each stage against a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows stored before the next."""
    docs = documents(spark, sf_dir)
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{name}")
    return docs
