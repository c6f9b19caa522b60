"""Every registered query gives the rows of its SQL counterpart."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
REGISTERED = {n: f for n, f in entry.queries().items() if n in entry.QUERIES}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name,fn", list(REGISTERED.items()), ids=list(REGISTERED))
def test_matches_sql(spark, con, name, fn):
    if name not in SQL:
        assert fn(spark, SF).take(1)
        return
    assert compare(spark, con, name, fn, SQL[name], SF) in (None, "EMPTY")


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["sku", "warehouse", "location_id", "inventory_item_id", "available", "synced", "action", "payload"]
    assert df.take(1)


def test_every_query_has_sql():
    assert set(SQL) >= set(entry.QUERIES)
