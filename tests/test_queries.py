"""Every registered query beside its SQL twin, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.comparison import connect, differences
from wayframe.plans.catalog import COVERS, QUERIES, TWINS

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not found")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@needs_tables
@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_its_twin(spark, con, name):
    found = differences(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name])
    assert found == []


@needs_tables
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(TWINS)))
def test_query_without_a_twin_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


@needs_tables
def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_names_what_it_covers():
    assert set(COVERS) == set(QUERIES) <= set(entry.queries())
    assert set(TWINS) <= set(QUERIES) and set(TWINS) <= set(entry.oracle_sql()) <= set(entry.queries())
