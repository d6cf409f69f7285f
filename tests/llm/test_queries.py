import os

import duckdb
import pytest
from compare import differences

import corpus_pipeline
from censusloom.llm import oracle, queries


@pytest.fixture(scope="module")
def views(sf_dir):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        path = f"{sf_dir}/{table}.parquet"
        con.execute(f"create view {table} as select * from '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


@pytest.mark.parametrize("name", list(oracle.oracle_sql()))
def test_query_against_sql(spark, sf_dir, views, name):
    assert differences(queries.queries()[name](spark, sf_dir), views, oracle.oracle_sql()[name]) == []


def test_every_operator_has_its_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.queries()) == list(range(1, 14))
    assert [stage.__name__ for _, stage in corpus_pipeline.STAGES][0] == "quality_classifier" and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", ["op1_quality", "op3_simhash", "op6_byte_bpe", "op7_sharding", "op8_token_counts", "op9_language"])
def test_a_row_for_every_document(spark, sf_dir, name):
    rows = queries.queries()[name](spark, sf_dir).select("doc_id")
    assert rows.count() == rows.distinct().count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
