"""Every registered terrain and road query against its SQL twin."""

import pytest
from compare import rows

from hillframe import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    got = catalog.QUERIES[name](spark, sf_dir).toPandas()
    want = duck.execute(catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_query_is_registered():
    import __spark_entry__ as entry

    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
