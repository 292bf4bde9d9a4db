"""Every registered query against its SQL on the smallest tables, whatever the order of partitions."""

import pytest

import __spark_entry__ as spark_entry
import catalogue
from tools import check

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, con, name):
    ok, text = check.compare(spark, con, FOLDER, name)
    assert ok, text


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES)
    assert set(catalogue.QUERIES) <= set(spark_entry.queries())


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
