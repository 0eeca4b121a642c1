"""Every registered query with an oracle equals its DuckDB SQL (sf0.001)."""

import pytest

from tools.oracle_check import compare, duck
from ludora.plans.catalog import QUERIES

from .conftest import SF_SMALL

NAMES = sorted(n for n, (_, sql) in QUERIES.items() if sql is not None)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    fn, sql = QUERIES[name]
    r = compare(spark, con, name, fn, sql, SF_SMALL, verbose=True)
    assert r["status"] == "match", r
