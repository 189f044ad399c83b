"""Every registered query against its SQL form on the small tables."""

import pytest

import __spark_entry__ as entry_module
from checks import ORACLES, QUERIES
from checks.compare import check, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_flagship(spark):
    rows = entry_module.entry(spark).collect()
    assert {r["name"] for r in rows} == {"ring", "earring", "bracelet"}


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, con, name):
    ok, note = check(spark, sf, name, QUERIES[name], ORACLES.get(name), con)
    assert ok, note
