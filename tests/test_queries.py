"""Every registered query against its SQL, on the smallest data."""

from __future__ import annotations

from pathlib import Path

import pytest
from check_oracle import compare, connect

import __spark_entry__ as entry
from gleanspark.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test data not there")


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_contract(spark):
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["source", "pricing", "items"]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, connection, name):
    same, note = compare(spark, connection, name, SF)
    assert same, note


@pytest.mark.parametrize("name", ["search_hits_whole", "wp_posts_whole"])
def test_whole_answers_hold_every_document(spark, name):
    assert entry.queries()[name](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
