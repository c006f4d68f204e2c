"""Every registered query against its SQL equivalent, on whole tables."""

import pytest
from oracle import connect, differences

from __spark_entry__ import entry
from geolink.catalog import queries
from geolink.catalog_sql import oracle_sql

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, con, name):
    assert differences(queries()[name](spark, FOLDER), con, oracle_sql()[name]) == []


def test_entry_runs(spark):
    df = entry(spark)
    assert len(df.columns) == 54 and df.count() > 0
