"""Registered queries on tables where one order and one item each own a third of all lines."""

import os
import shutil

import duckdb
import pytest

import __spark_entry__ as entry
from cartloom.operators import skew
from tests.oracle import compare, connect

SOURCE = "/root/testdata/sf0.001"
@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    for f in os.listdir(SOURCE):
        if f != "lineitem.parquet":
            shutil.copy(f"{SOURCE}/{f}", folder)
    duckdb.sql(
        "COPY (SELECT CASE WHEN hash(l_extendedprice) % 3 = 0 THEN 3 ELSE l_orderkey END AS l_orderkey, "
        "CASE WHEN hash(l_extendedprice) % 3 = 1 THEN 7 ELSE l_partkey END AS l_partkey, * EXCLUDE (l_orderkey, l_partkey) "
        f"FROM '{SOURCE}/lineitem.parquet') TO '{folder}/lineitem.parquet'"
    )
    return folder


@pytest.fixture(autouse=True)
def many_salts(monkeypatch):
    defaults = skew.lookup_hot.__defaults__
    monkeypatch.setattr(skew.lookup_hot, "__defaults__", tuple(300 if v == skew.ROWS_PER_SALT else v for v in defaults))


@pytest.mark.parametrize(
    "name",
    ["number_lines", "order_docs", "line_discounts", "minor_unit_order_docs", "price_gap_discounts", "sales_lines", "quantity_payload", "latest_price", "freight_lines",
     "party_docs", "profile_party_docs", "marketplace_party_docs", "contains_join"],
)
def test_same_rows_as_sql(spark, skewed, name):
    assert compare(spark, connect(skewed), name, entry.queries()[name], entry.oracle_sql()[name], skewed) is None


def test_an_order_of_many_parts_has_one_freight_and_one_party(spark, skewed):
    of_three = lambda name: [r for r in entry.queries()[name](spark, skewed).collect() if r["order_id"].split("-")[0] == "#3"]
    assert len(of_three("order_docs")) > 8
    assert sorted(r["price"] for r in of_three("freight_lines")) == [9000.0, 14000.0]
    assert len(of_three("party_docs")) <= 1
