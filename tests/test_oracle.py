"""Every registered query against its SQL on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
import check_oracle

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return check_oracle.duck(SF_DIR)


# queries of the optional subpackage have tests of their own
NAMES = [n for n, f in entry.queries().items() if f.__module__ == entry.__name__]


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, db, name):
    assert check_oracle.compare(spark, db, name, SF_DIR) is None


def test_entry(spark):
    assert len(entry.entry(spark).columns) == 11
