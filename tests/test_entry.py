import pytest

import __spark_entry__ as entry
import check

SF_DIR = "/root/testdata/sf0.001"


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["dt", "hostname", "KB"]
    assert df.count() == 24


def test_every_query_has_its_sql():
    without = entry.queries().keys() - entry.oracle_sql().keys()
    # the optional folder's queries that SQL can't express have tests of their own
    assert all(name == "pipeline" or name.startswith("op") for name in without)
    assert entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_query_equals_sql(spark, name):
    ((_, _, count, found),) = check.differences(spark, SF_DIR, [name])
    assert found is None
    assert count > 0
