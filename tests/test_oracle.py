"""Every registered query against its DuckDB statement, over the whole tables."""

import pytest

from checks.compare import check
from checks.registry import ORACLE, QUERIES


@pytest.mark.parametrize("name", list(QUERIES))
def test_agrees_with_duckdb(spark, duck, sf_dir, name):
    problem, rows = check(spark, duck, sf_dir, name, QUERIES[name], ORACLE.get(name))
    assert problem is None
    assert rows > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
