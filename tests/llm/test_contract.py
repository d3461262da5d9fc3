"""The llm queries that SQL can state, and what the driver's contract lists."""

import pytest

import __spark_entry__ as contract
from chorus.llm import queries
from check import compare, database


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, sf_dir, name):
    assert compare(spark, database(sf_dir), sf_dir, name, queries.SQL[name]) is None


def test_one_query_per_operator():
    numbers = sorted(int(name.split("_")[0][2:]) for name in contract.queries() if name.startswith("op"))
    assert numbers == list(range(1, 11)) and "pipeline" in contract.queries()
    assert set(queries.SQL) <= set(contract.oracle_sql())
