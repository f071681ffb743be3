"""Every registered query against its SQL counterpart."""

import pytest
from compare import compare, connect
from conftest import SMALL

import __spark_entry__ as entry
from lexigrid.plans import registry


@pytest.fixture(scope="module")
def db():
    return connect(SMALL)


@pytest.fixture(scope="module")
def sql(spark):
    return entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(registry.registered()))
def test_query(spark, db, sql, name):
    df = entry.queries()[name](spark, SMALL)
    assert compare(df, db, sql[name]) is None


def test_every_oracle_has_a_query(sql):
    assert set(sql) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
