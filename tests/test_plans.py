"""What the plans of registered queries must and must not hold."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
HEAVY = [
    "available_stock", "catalogue_stock", "stock_sync", "union_modes", "resolve_location", "contains_join", "minor_unit_order_docs",
    "sales_lines", "eligible_split", "product_docs", "densify_grid", "join_either_stock",
]


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def unbounded_in_one_task(text):
    """What one task receives, but for merged aggregates (one row a task) and the edges of ranges (one row a range)."""
    lines = text.splitlines()
    below = [lines[i + 1] for i, line in enumerate(lines) if "SinglePartition" in line]
    return [b for b in below if "partial_" not in b and "AS __r#" not in b]


@pytest.mark.parametrize("name", [*HEAVY, "number_lines", "to_batches", "quantity_payload"])
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython"):
        assert bad not in text, (name, bad)
    assert not unbounded_in_one_task(text), name


@pytest.mark.parametrize("name", ["dedupe_latest", "latest_price", "lookup_first", "latest_valid"])
def test_top_row_per_key_is_cut_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert text.index("WindowGroupLimit") != text.rindex("WindowGroupLimit")


@pytest.mark.parametrize(
    "name,filters,columns",
    [
        ("price_as_of", "EqualTo(l_returnflag,A)", "l_partkey"), ("top_transactions", "GreaterThan(ts", "event_id"),
        ("except_union", "LessThan(l_shipdate", "l_partkey"), ("not_exists_anti", "GreaterThan(o_totalprice", "o_custkey"),
    ],
)
def test_filters_and_columns_reach_the_scan(spark, name, filters, columns):
    text = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert filters in text and columns in text
    scans = [line for line in text.splitlines() if "ReadSchema" in line]
    assert scans and not any("l_tax" in s for s in scans)


def test_order_documents_are_built_without_a_shuffle(spark):
    from cartloom.config import OrderConfig
    from cartloom.plans.orders import build_order_docs
    from tests.test_hazards import now, order, parsed

    text = build_order_docs(parsed(spark, [order("#1")]), OrderConfig(), now())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and text.count("from_json") == 1
