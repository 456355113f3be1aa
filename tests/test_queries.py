"""Every registered query: the smoke entry, and each query against its
DuckDB oracle at sf0.01 (rows-only queries must run and return rows)."""

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck

from conftest import SF01

QUERIES = E.queries()
ORACLES = E.oracle_sql()


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["state", "num_cases", "mean_score", "median_score", "variance_score"]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in ORACLES:
        r = compare(spark, con, name, QUERIES[name], ORACLES[name], SF01)
        assert r["ok"], r["problems"]
    else:
        assert QUERIES[name](spark, SF01).count() > 0
