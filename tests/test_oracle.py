"""Every registered query against its DuckDB oracle (the driver's gate), at
sf0.001 so the suite stays fast; tests/oracle_harness.py runs sf0.01."""

import os

import pytest

import __spark_entry__ as E
from vintagelake.plans import catalog
from oracle_harness import compare, duck_connect, duck_rows, spark_rows

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF)


def test_every_query_has_an_oracle():
    assert set(catalog.ORACLE) == set(catalog.QUERIES)
    assert set(E.queries()) >= set(catalog.QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark_rows(E.queries()[name](spark, SF)), duck_rows(con, E.oracle_sql()[name]))
    assert res["ok"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["vintage", "mob", "horizon", "n_accounts", "n_30", "n_90", "rate_30"]
    assert df.count() > 0
