"""Every registered query against its DuckDB twin (driver-style compare)."""

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
ORACLES = E.oracle_sql()
NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    fn = E.queries()[name]
    if name not in ORACLES:
        df = fn(spark, SF)
        assert df.count() >= 0
        return
    s, d, *_ = compare(spark, SF, name, fn, ORACLES[name], con)
    assert s[1] == d[1], "column names differ"
    assert s[0] == d[0], "row counts differ"
    assert s[2] == d[2], "values differ"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["entity", "rank", "url", "text", "relevance_score"]
