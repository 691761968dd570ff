"""Every bound query against its SQL twin on the driver's tables."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as entry
from bindings import registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_matches_sql(spark, con, name):
    difference = oracle.compare(spark, con, SF_DIR, entry.queries()[name], entry.oracle_sql()[name])
    assert difference is None, difference


def test_every_query_of_the_model_has_sql():
    assert set(registry.QUERIES) == set(registry.SQL)


def test_entry_gives_rows(spark):
    assert entry.entry(spark).take(1)
