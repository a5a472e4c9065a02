"""Every registered query against its SQL on the smallest tables."""

import pytest

from registry import ORACLES, QUERIES, load
from registry.check import difference, duck, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"
load()


@pytest.fixture(scope="module")
def tables():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, tables, name):
    assert difference(spark_rows(QUERIES[name](spark, SF)), duck_rows(tables, ORACLES[name])) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    import __spark_entry__ as entry

    row = entry.entry(spark).first()
    assert row.srt.startswith("1\n00:00:00,000 --> ") and set(entry.queries()) >= set(entry.oracle_sql())
