"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as ent

SF = "/root/testdata/sf0.001"
TABLES = ["events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(norm(r[c]) for c in cols) for r in pdf.to_dict("records")), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ent.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = rows(ent.queries()[name](spark, SF).toPandas())
    exp = rows(con.sql(ent.oracle_sql()[name]).df())
    assert got[0] == exp[0]
    assert got[1] == exp[1]


def test_every_query_runs(spark):
    for name, fn in ent.queries().items():
        fn(spark, SF).schema  # plans without error


def test_entry(spark):
    df = ent.entry(spark)
    assert df.count() > 0
