"""Every registered query against its SQL on the smallest tables."""

import pytest
from parity import difference, duckdb_tables

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def db(sf_dir):
    return duckdb_tables(sf_dir)


@pytest.mark.parametrize("name", list(entry.QUERIES))
def test_query(spark, sf_dir, db, name):
    frame = entry.queries()[name](spark, sf_dir)
    rows = [tuple(r) for r in frame.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
    else:
        assert difference(rows, frame.columns, db, sql) is None


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() == 61


@pytest.mark.parametrize("name", ["unseen_articles", "news_feed_articles"])
def test_copies_are_told_without_sorting(spark, sf_dir, name):
    plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
