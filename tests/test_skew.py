"""Registered panel queries with the hot-key salting forced on (a low
threshold makes the accounts merged onto successor 0 hot) still match
their DuckDB oracles."""

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck_connect, duck_rows, spark_rows
from vintagelake.operators import panel

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def salted(spark):
    spark.conf.set(panel.CONF_HOT_KEY_ROWS, "20")
    spark.conf.set(panel.CONF_SALT_BUCKETS, "4")
    yield spark
    spark.conf.unset(panel.CONF_HOT_KEY_ROWS)
    spark.conf.unset(panel.CONF_SALT_BUCKETS)


@pytest.mark.parametrize("name", ["vintage_delinquency", "vintage_panel", "initial_state", "dispositions_mart",
                                  "dispositions_net_mart", "cohort_mart_applications"])
def test_salted_queries_match_oracle(salted, name):
    con = duck_connect(SF)
    res = compare(spark_rows(E.queries()[name](salted, SF)), duck_rows(con, E.oracle_sql()[name]))
    assert res["ok"], res


def test_fact_ladders_are_not_left_to_the_interpreter(spark):
    """HotSpot interprets a method beyond 8,000 bytes: building a fact keeps its session from running one."""
    from vintagelake.session import CONF_METHOD_LIMIT, compiled_ladders
    kept = spark.conf.get(CONF_METHOD_LIMIT)
    try:
        spark.conf.unset(CONF_METHOD_LIMIT)
        E.queries()["dispositions_net_mart"](spark, SF)
        assert int(spark.conf.get(CONF_METHOD_LIMIT)) <= 8000
        spark.conf.set(CONF_METHOD_LIMIT, "20000")   # the session's own limit stays
        compiled_ladders(spark)
        assert spark.conf.get(CONF_METHOD_LIMIT) == "20000"
    finally:
        spark.conf.set(CONF_METHOD_LIMIT, kept)
