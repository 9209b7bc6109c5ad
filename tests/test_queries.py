"""Every registered query against its SQL counterpart on the smallest given tables."""

import pytest

import __spark_entry__ as entry_points
from check import compare, open_database
from obslake.queries.oracles import ORACLES
from obslake.queries.registry import QUERIES

NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def database(sf_dir):
    return open_database(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, database, sf_dir, name):
    _, verdict = compare(spark, database, sf_dir, name)
    assert verdict.startswith("ok"), verdict


def test_every_query_has_sql():
    assert set(ORACLES) == set(NAMES)
    assert set(NAMES) <= set(entry_points.queries())


def test_flagship(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["company_id", "observation_date", "arr_usd", "arr_observation_id"]
    assert df.count() > 100
