"""Every registered query against its DuckDB twin on the smallest tables."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, ns, nd, _, detail = compare(spark, SF_SMALL, name, E.queries()[name], E.oracle_sql()[name], con)
    assert ok, detail


def test_every_query_runs(spark):
    for name, fn in E.queries().items():
        if name not in E.oracle_sql():
            assert fn(spark, SF_SMALL).count() >= 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
