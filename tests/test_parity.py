"""Every query with SQL agrees with it, value by value."""

import pytest

import __spark_entry__ as entry

from .parity import compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(name, spark, sf_dir, con):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []


def test_entry_answers_the_headline_question(spark):
    row = entry.entry(spark).first()
    assert tuple(row) == (1000, 567, 56.7, 165, 402, 267, 166, 61183.0, 69.0)
