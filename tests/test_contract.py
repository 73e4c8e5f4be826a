"""Every registered query against its SQL, and the shape of the plans that matter."""

import re

import duckdb
import pytest

import __spark_entry__ as contract
from articlelake.plans import oracle
from articlelake.plans.queries import QUERIES
from articlelake.sources.testdata import table
from check import TABLES, canonical
from tests.plans import exchanged

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert QUERIES.keys() == oracle.oracle_sql().keys()
    assert QUERIES.items() <= contract.queries().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, database, name):
    ours = contract.queries()[name](spark, SF).toPandas()
    theirs = database.execute(contract.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) > 0 and canonical(ours) == canonical(theirs)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def plan(spark, name):
    df = contract.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_query_crosses_tables(spark, name):
    if name.startswith(("batch_l", "batch_r", "embed_resumed", "embed_sample", "stage_", "stale_", "landed", "run_all", "failed", "incremental", "compaction", "spanning")):
        pytest.skip("reads back what it wrote")
    found = plan(spark, name)
    assert "CartesianProduct" not in found and "NestedLoopJoin" not in found


@pytest.mark.parametrize("name", ["rag_chunks_words", "embed_local", "unique_chunk_ids"])
def test_articles_are_chunked_once(spark, name):
    found = plan(spark, name)
    assert found.count("reverse(slice(") == 1  # the overlap search of one fold


@pytest.mark.parametrize(
    "name", ["flat_topics", "topic_quarter_rollup", "exclusion_accounting", "topic_vocabulary",
             "flatten_conservation"]
)
def test_text_is_not_read_where_it_is_not_used(spark, name):
    assert not re.search(r"ReadSchema: struct<[^>]*\btext:", plan(spark, name))


def test_no_exchange_carries_a_text_of_what_is_pending(spark):
    carried = exchanged(contract.queries()["embed_resume_pending"](spark, SF))
    assert not any("retrieval_text" in columns for columns in carried)


def test_json_is_decoded_once_per_column(spark):
    assert plan(spark, "clean_base").count("from_json(") == 2


def test_tables_are_read_in_place(spark):
    assert table(spark, SF, "documents").inputFiles()[0].endswith("documents.parquet")
