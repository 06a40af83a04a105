"""The queries that SQL can express, against DuckDB on the same tables."""
from __future__ import annotations

import pytest

import oracle_check
from cargoline.llm.queries import ORACLE_SQL, QUERIES
from test_brute_force import SF_DIR


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    con = oracle_check.duck_connection(SF_DIR)
    assert oracle_check.compare(spark, SF_DIR, con, name, QUERIES[name], ORACLE_SQL[name]) == "OK"
