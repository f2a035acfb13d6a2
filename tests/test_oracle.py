"""Every registered query against its reference SQL, on whole tables."""

import pytest
from oracle_compare import connect, differences

from voltseries.catalog.oracle import oracle_sql
from voltseries.catalog.queries import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, engine, name):
    assert differences(queries()[name](spark, FOLDER), engine, oracle_sql()[name]) == []


def test_results_do_not_depend_on_the_session_zone(spark, engine):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("mart_asset_performance_daily", "stg_weather", "net_load", "time_spine"):
            assert differences(queries()[name](spark, FOLDER), engine, oracle_sql()[name]) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
