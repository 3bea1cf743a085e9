"""Every registered query with a SQL form against DuckDB on the same files."""

import compare
import pytest

import __spark_entry__ as entry_module

QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return compare.duck(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, connection, name):
    assert compare.difference(QUERIES[name](spark, sf_dir), connection, ORACLES[name]) is None


def test_entry_gives_the_farm_summary(spark):
    summary = entry_module.entry(spark)
    rows = summary.collect()
    assert [r.date for r in rows] == sorted((r.date for r in rows), reverse=True)
    assert {r.sensor_status for r in rows} == {"HEALTHY", "WARNING"}
