"""Every query against its SQL; streams included."""

from __future__ import annotations

import pytest
from compare import differences, duckdb_tables

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SF_DIR
from eventlake.plans.oracle import ORACLE
from eventlake.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    return duckdb_tables(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries())
    assert set(ORACLE) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["event_date", "country_name", "platform", "distinct_users"]
    assert df.count() > 0


@pytest.mark.parametrize("name", list(ORACLE))
def test_matches_sql(spark, duck, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) is None
