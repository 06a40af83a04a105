"""Every registered query equals its independent DuckDB SQL on the driver's
smallest tables (row count, column names and every value)."""
from __future__ import annotations

import os

import pytest

import oracle_check
from cargoline.plans.oracle import oracle_sql
from cargoline.plans.registry import queries

SF_DIR = os.environ.get("CARGOLINE_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF_DIR):
        pytest.skip(f"no test data at {SF_DIR}")
    return oracle_check.duck_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, duck, name):
    status = oracle_check.compare(spark, SF_DIR, duck, name, queries()[name], oracle_sql()[name])
    assert status == "OK"
