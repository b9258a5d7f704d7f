"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from check_queries import compare

SF = "/root/testdata/sf0.01"


# the corpus operators have tests of their own
OWN = sorted(entry.queries().keys() - entry._corpus().keys())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, name):
    result = compare(spark, SF, name)
    assert result["ok"], result["note"]
    assert result["rows"] > 0


def test_every_query_has_sql():
    assert set(OWN) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "alert_type"
    assert df.count() == 30
