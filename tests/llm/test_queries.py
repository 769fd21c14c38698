"""Registered queries of the training-data operators against their DuckDB twins."""

import pytest
from oracle_harness import compare, duck

from sitelens.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_matches_oracle(spark, con, name):
    s, d, *_ = compare(spark, SF, name, Q.QUERIES[name], Q.ORACLES[name], con)
    assert s == d
