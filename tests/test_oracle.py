"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
from check_oracle import compare, database

SF = "/root/testdata/sf0.001"
CON = database(SF)


@pytest.mark.parametrize("name", list(entry_point.queries()))
def test_query_matches_sql(spark, name):
    assert compare(spark, CON, name, SF) == ""


def test_sql_belongs_to_queries():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry_has_rows(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["word", "freq"] and not df.isEmpty()
