"""Every registered query against its SQL statement, over whole tables."""

import re

import pytest
from oracle_check import connect, run_spark, run_sql

import __spark_entry__ as spark_entry

QUERIES = spark_entry.queries()
SQL = spark_entry.oracle_sql()
APPROXIMATE = {"vector_ivf_topk"}  # measured against the exact hits in test_ivf.py
TRAINING = {n for n in QUERIES if n == "pipeline" or re.match(r"op\d+_", n)}  # tested in a folder of their own


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


def test_every_query_has_a_statement():
    assert set(QUERIES) - set(SQL) <= TRAINING | APPROXIMATE
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, sf_dir, name):
    assert run_spark(QUERIES[name](spark, sf_dir)) == run_sql(duck, SQL[name])


def test_entry_has_rows(spark):
    hits = spark_entry.entry(spark)
    assert hits.columns == ["item_id", "chunk_id", "score", "rank"]
    assert hits.count() == 160
