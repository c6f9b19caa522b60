"""Rules of available stock, lossless upserts and keys that never collide."""

from decimal import Decimal

from pyspark.sql import functions as F

from cartloom.functions import text as tx
from cartloom.operators import merge as mg
from cartloom.operators import relational as rl
from cartloom.plans import stock as st
from cartloom.session import tune
from cartloom.sources.schemas import ORDER_A, only

D = Decimal


def available(spark, levels, barcodes):
    ext = spark.createDataFrame([(1, 9, "A"), (2, 9, "A"), (3, 9, "A")], "ext_rowid long, item_rowid long, main_barcode string")
    stock = spark.createDataFrame(levels, "ext_rowid long, warehouse_rowid long, on_hand decimal(18,6), committed decimal(18,6), pos decimal(18,6)")
    wh = spark.createDataFrame([(1, "W1"), (2, "W2")], "warehouse_rowid long, warehouse_id string")
    bars = spark.createDataFrame(barcodes, "barcode string, ext_rowid long, warehouse_rowid long")
    return st.available_stock(ext, stock, wh, st.BARCODE, barcodes=bars)


def test_equal_quantities_of_one_sku_add_up(spark):
    rows = available(spark, [(e, 1, D(7), D(0), D(0)) for e in (1, 2, 3)], [("x", 1, 1), ("y", 1, 1)])
    assert [tuple(r) for r in st.total_stock(rows).collect()] == [("A", "W1", 21)]


def test_equal_stock_rows_of_one_extension_add_up(spark):
    bars = [("x", 1, 1), ("y", 1, 2), ("z", 2, 2)]
    for second, total in ((D(7), 14), (D(8), 15)):
        rows = available(spark, [(1, 1, D(7), D(0), D(0)), (1, 1, second, D(0), D(0)), (2, None, D(2), D(0), D(0))], bars)
        assert sorted(map(tuple, st.total_stock(rows).collect())) == [("A", "W1", total), ("A", "W2", 2)]


def test_whole_units_are_cut_before_subtracting_and_a_gap_means_none(spark):
    rows = available(spark, [(1, 1, D("10.5"), D("0.7"), D(0)), (2, 1, D(5), None, D(0))], [("x", 1, 1)])
    assert sorted((r.ext_rowid, r.available) for r in rows.collect()) == [(1, 10), (2, 0)]


def test_a_quantity_is_credited_to_one_warehouse(spark):
    rows = available(spark, [(1, 1, D(4), D(0), D(0)), (2, None, D(3), D(0), D(0))], [("x", 1, 2), ("y", 2, 2)])
    assert sorted(map(tuple, st.total_stock(rows).collect())) == [("A", "W1", 4), ("A", "W2", 3)]


def test_missing_quantities_are_rejected_not_lost(spark):
    target = spark.createDataFrame([(1, 5, 0)], "k int, q int, ts int")
    batch = spark.createDataFrame([(1, None, 1), (2, -1, 1), (3, 4, 1)], "k int, q int, ts int")
    state, rejects = mg.upsert_snapshot(target, batch, ["k"], "q", "ts")
    assert sorted(map(tuple, state.collect())) == [(1, 5, 0), (3, 4, 1)]
    assert sorted((r.k, r.reject_reason) for r in rejects.collect()) == [(1, "missing quantity"), (2, "negative quantity")]


def test_long_keys_stay_whole(spark):
    got = spark.createDataFrame([(7,), (100000001,), (200000001,)], "k long").select(tx.pad_left(F.col("k"), 8).alias("p")).collect()
    assert [r.p for r in got] == ["00000007", "100000001", "200000001"]


def test_either_key_meets_each_pair_once(spark):
    left = spark.createDataFrame([(1, 5, 5), (2, 5, 6), (3, None, 6), (4, None, None)], "id int, a int, b int")
    right = spark.createDataFrame([(5, "x"), (6, "y")], "k int, v string")
    got = rl.join_either(left, right, ["a", "b"], "k").select("id", "v").collect()
    assert sorted(map(tuple, got)) == [(1, "x"), (2, "x"), (2, "y"), (3, "y")]


def test_schema_parts_and_settings(spark):
    assert only(ORDER_A, "currency", "name") == "name string, currency string"
    assert "line_items" not in only(ORDER_A, "customer") and only(ORDER_A, "customer").count("<") == 2
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        tune(spark)
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")
