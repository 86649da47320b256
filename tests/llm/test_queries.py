"""Registered queries against DuckDB, and the pipeline's stages."""

import duckdb
import pytest

import corpus_pipeline
from cartwise.llm import queries, sql

from llm_helpers import SCHEMA

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(sql.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(sql.ORACLE[name]).df()
    got = queries.QUERIES[name](spark, SF).toPandas()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    key = [got[cols].astype(str).sort_values(cols).values.tolist(), want[cols].astype(str).sort_values(cols).values.tolist()]
    assert key[0] == key[1]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    start = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        left = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert left and left <= start
        docs, start = out, left
    assert corpus_pipeline.run(spark, SF).filter("n_tokens > 0").count() > 0
    empty = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
