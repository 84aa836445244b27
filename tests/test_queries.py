"""Every registered query gives the rows of its SQL."""

import pytest

import __spark_entry__ as entry_module
from oracle import differences

QUERIES = entry_module.queries()
SQL = entry_module.oracle_sql()


#: Queries of the text operators have tests of their own.
TEXT = set(entry_module._llm_queries())


def test_every_query_has_sql():
    assert set(SQL) - TEXT == set(QUERIES) - TEXT


@pytest.mark.parametrize("name", sorted(set(SQL) - TEXT))
def test_query_equals_sql(spark, sf, name):
    frame = QUERIES[name](spark, sf)
    assert differences(frame, sf, SQL[name]) is None


def test_entry_gives_rows(spark):
    frame = entry_module.entry(spark)
    assert len(frame.columns) == 19
    assert frame.limit(1).count() == 1
