"""The text queries with a SQL form against DuckDB."""

import compare
import pytest

from fieldspark.llm.oracles import oracle_sql
from fieldspark.llm.queries import registered


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    assert compare.difference(registered()[name](spark, sf_dir), compare.duck(sf_dir), oracle_sql()[name]) is None


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in registered()) == list(range(1, 14))
