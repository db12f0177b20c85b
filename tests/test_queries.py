"""Every registered query against its reference SQL."""

import pytest

import __spark_entry__ as entry
from tools.check import compare, connect
from workload import load_all
from workload.registry import QUERIES, REFERENCE_SQL as REFERENCES

load_all()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_reference():
    assert set(QUERIES) == set(REFERENCES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, REFERENCES[name]) == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "title", "license", "download_date", "relevance_score"]
    assert df.count() > 0
