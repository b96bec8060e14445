"""Every registered query against its SQL twin on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from clickweir.catalog import ORACLES, QUERIES
from verify import compare, connect

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def db(sf):
    return connect(sf)


@pytest.mark.parametrize("key", KEYS)
def test_matches_twin(spark, db, sf, key):
    ok, detail = compare(spark, db, sf, key, QUERIES[key], ORACLES.get(key))
    assert ok is not False, detail


def test_entry_is_not_empty(spark):
    assert entry(spark).count() > 0


def test_all_have_a_twin():
    assert set(KEYS) == set(ORACLES)


def test_entry_registers_them_all():
    assert set(KEYS) <= set(queries()) and set(ORACLES) <= set(oracle_sql())
