"""Every registered query beside its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle import connect, differences, duck_rows, spark_rows

QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="module")
def oracles(spark):
    return entry.oracle_sql()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, con, oracles, name):
    got = spark_rows(QUERIES[name](spark, sf_dir))
    assert got[1]
    if name in oracles:
        assert differences(got, duck_rows(con, oracles[name])) is None


def test_every_sql_belongs_to_a_query(oracles):
    assert set(oracles) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["word", "count"]
