"""What moves and what is written when orders become documents, and the rows that must stay as they were."""

import json
import os
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cartloom.config import MarketplaceConfig, MinorUnitOrderConfig, PartyConfig
from cartloom.operators import skew
from cartloom.plans import orders as od
from cartloom.plans.places import resolve_location
from cartloom.queries.registry import SCHEMAS, order_texts
from cartloom.sources.schemas import ORDER_B, ORDER_C
from cartloom.sources.tables import store_documents
from tests.oracle import compare
from tests.test_hazards import master, now, parsed, profile

DAY = datetime(2024, 1, 2)


def line(order, n, part, price=10.0, discount=0.1, tax=0.08, flag="A"):
    return (order, part, 1, n, 2.0, price, discount, tax, flag, "F", DAY)


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    """Order 10 has most lines, many of them twice; order 13 none; some lines and orders have no key."""
    folder = str(tmp_path_factory.mktemp("shop"))
    many = [line(10, i % 150, i % 9, 5.0 + i % 4, flag="ARN"[i % 3]) for i in range(450)]
    few = [line(k, n, k + n, 20.0 * n, 0.05 * n, 0.07) for k in (1, 2, 3, 11, 12, 14, 15, 16) for n in (3, 1, 2)]
    tables = {
        "region": [(1, "ASIA"), (2, "AMERICA")], "nation": [(3, "N3", 1), (4, "N4", 2), (0, "N0", 2)],
        "customer": [(k, f"c{k}", (3, 4, 0)[k % 3], 0.0, "m") for k in range(1, 9)], "supplier": [(1, "s", 3, 0.0)],
        "part": [(k, "p", "b", "t", 1, 1.0) for k in range(1, 20)],
        "orders": [(k, k % 8 + 1, "FPO"[k % 3], 0.0, DAY, "5-LOW") for k in (1, 2, 3, 10, 11, 12, 13, 14, 15, 16)],
        "lineitem": many + few + few[:4],
        "events": [(i, DAY + timedelta(minutes=i), i % 17, ("click", "view", "purchase", "signup")[i % 4], 15.0 + i % 11, "{}") for i in range(60)],
    }
    for name, rows in tables.items():
        spark.createDataFrame(rows, SCHEMAS[name]).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def con(shop):
    con = duckdb.connect()
    for f in os.listdir(shop):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{shop}/{f}/*.parquet')")
    return con


@pytest.fixture
def without_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def steps(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


@pytest.mark.parametrize(
    "name,most", [("order_docs", 20), ("order_docs", 0), ("party_docs_client_type", 20), ("minor_unit_order_docs", 20), ("marketplace_order_docs", 20)]
)
def test_same_rows_as_sql_with_an_order_too_long_for_a_task(spark, shop, con, monkeypatch, name, most):
    monkeypatch.setattr(skew.hot_table, "__defaults__", (most, *skew.hot_table.__defaults__[1:]))
    assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], shop) is None


def test_the_hot_bucket_is_told_from_the_others(spark):
    facts = spark.range(900).select(F.when(F.col("id") < 400, F.lit(1)).when(F.col("id") < 600, F.lit(None)).otherwise(F.col("id")).alias("k"))
    told = lambda most: {r.k: r.h for r in facts.distinct().select("k", skew.is_hot(skew.hot_table(facts, ["k"], most), ["k"]).alias("h")).collect()}
    assert [k for k, h in told(300).items() if h] == [1]
    # An even share of the partitions, not the setting, is what counts in a large table.
    assert {k for k, h in told(0).items() if h} == {1, None}
    assert not any(told(400).values())


def below(node, above=()):
    """Every step of a plan with the steps above it and what it hands on, without the plans of its subqueries."""
    text, output = node.simpleString(200), node.output()
    yield text, above, {output.apply(i).name(): output.apply(i).dataType().simpleString() for i in range(output.size())}
    children = node.children()
    for i in range(children.size()):
        yield from below(children.apply(i), (*above, text))


def planned(df):
    return [*below(df._jdf.queryExecution().executedPlan().initialPlan())]


def test_lines_of_an_order_move_once(spark, shop, without_broadcasts):
    found = planned(order_texts(spark, shop))
    made = next(above for text, above, _ in found if "ObjectHashAggregate" in text and "collect_list" in text)
    assert "Exchange" not in "".join(made[max(i for i, text in enumerate(made) if "Join" in text) :])
    read = next(above for text, above, _ in found if "FileScan" in text and "l_linenumber" in text)
    assert sum("Exchange" in text for text in read[len(made) :]) == 1
    assert not any("l_shipdate" in text for text, _, _ in found)


def test_orders_stay_where_they_are_when_their_places_are_few(spark):
    orders = spark.createDataFrame([("a", "C", "S", "T"), ("b", "C", "S", None)], "order_id string, country string, state string, city string")
    known = spark.createDataFrame([("C", "S", "T", "1", "2", "3")], "country_name string, state_name string, city_name string, country_id string, state_id string, city_id string")
    out = resolve_location(orders, known, "country", "state", "city", PartyConfig().defaults)
    assert not any("Exchange hashpartitioning" in step for step in steps(out))
    assert sorted((r.order_id, r.country_id, r.location_rule) for r in out.collect()) == [("a", "1", 5), ("b", "169", None)]


def test_stored_documents_are_packed(spark, tmp_path):
    texts = spark.createDataFrame([(1, '{"a": 1}'), (2, "{")], "id long, document string")
    read = store_documents(texts, "document", str(tmp_path / "stored"))
    assert {r.id: r.s for r in read.select("id", F.to_json("stored").alias("s")).collect()} == {1: '{"a":1}', 2: None}
    parts = [f for f in os.listdir(tmp_path / "stored") if f.startswith("part-")]
    assert parts and all(".zstd." in f for f in parts)


def moved(found, by):
    """Columns of the widest shuffle by a column."""
    return max((output for text, _, output in found if text.startswith(f"Exchange hashpartitioning({by}#")), key=len)


def test_minor_unit_lines_move_with_codes_and_numbers_and_return_flat(spark, without_broadcasts):
    items = [
        {"id": "1", "uniqueId": "u1", "ean": None, "refId": "E1", "quantity": 2, "price": 10000, "sellingPrice": 5000},
        {"id": "2", "uniqueId": "u2", "ean": "E2", "refId": "E1", "quantity": "x", "price": "bad", "sellingPrice": 1},
        {"id": "3", "uniqueId": "u3", "ean": None, "refId": None, "quantity": 1, "price": 300, "sellingPrice": None},
    ]
    built = od.build_minor_unit_order_docs(parsed(spark, [profile("MLC1", items=items)], ORDER_B), master(spark), MinorUnitOrderConfig(), now())
    doc = json.loads(built.first()["json"])
    assert [tuple(m[f"f431_{f}"] for f in ("nro_registro", "codigo_barras", "id_unidad_medida", "cant_pedida_base", "precio_unitario")) for m in doc["Movimientos"]] == [
        (1, None, "UND", "1", 3), (2, None, "PAR", "2", 100), (3, "E2", "UND", "x", None), (4, "", "UND", "1", 500)]
    assert [(t["F431_NRO_REGISTRO"], t["F433_TASA"]) for t in doc["Impuestos"]] == [(2, 0), (3, 19)]
    assert [(d["f431_nro_registro"], d["f432_vlr_uni"]) for d in doc["Descuento"]] == [(2, 50)]
    found = planned(built)
    lines = moved(found, "code")
    assert {k: v for k, v in lines.items() if k != "head"} == {
        "order_id": "string", "exempt": "boolean", "line_no": "int", "code": "string", "has_ean": "boolean", "quantity": "string", "price": "double", "selling_price": "double"}
    assert "f430_id_fecha" not in lines["head"] and lines["head"].count("party") == 1
    assert "rows" not in moved(found, "order_id") and "line_no" in moved(found, "order_id")


def test_marketplace_lines_move_with_references_and_numbers_and_return_flat(spark, without_broadcasts):
    item = lambda i, code, **over: {"count": 2, "gross": 119, "ProductVersion": {"_id": i, "code": code, "Product": {"name": "hp ink"}}, "CheckoutItemDiscounts": [{"discount": 10}], **over}
    texts = [{"origin": "mercadolibre", "Warehouse": {"name": "FULL"}, "CheckoutLinks": [{"externalOrderNumber": "2000055"}], "Client": {"taxId": "9", "fullName": None},
              "CheckoutItems": [item("c", "A-1"), item("b", None, count="x"), item("a", "B", CheckoutItemDiscounts=[{"discount": "?"}])]}]
    items = spark.createDataFrame([("A#1", "KIT ")], "reference string, unit string")
    rates = spark.createDataFrame([("A#1", 19)], "reference string, rate int")
    built = od.build_marketplace_order_docs(parsed(spark, texts, ORDER_C), items, rates, MarketplaceConfig(), now())
    doc = json.loads(built.first()["json"])
    fields = ("nro_registro", "referencia_item", "id_bodega", "id_unidad_medida", "cant_pedida_base", "precio_unitario")
    assert [tuple(m.get(f"f431_{f}") for f in fields) for m in doc["MovtoPedidosComercial"]] == [
        (1, "B", "04", "UND", 2, 119.0), (2, None, "04", "UND", None, 119.0), (3, "A#1", "04", "KIT", 2, 95.8)]
    head = doc["Pedidos"][0]
    assert (head["f430_id_tercero_fact"], head["f430_id_tercero_rem"], head["f419_contacto"], head["f430_referencia"]) == ("9", "9", "", "55")
    found = planned(built)
    lines = moved(found, "reference")
    assert {k: v for k, v in lines.items() if k != "head"} == {
        "order_id": "string", "warehouse": "string", "line_no": "int", "reference": "string", "quantity": "int", "gross": "decimal(18,2)", "discount": "decimal(18,2)"}
    assert "f430_id_fecha" not in lines["head"] and lines["head"].count("party") == 1
    assert "rows" not in moved(found, "order_id") and "line_no" in moved(found, "order_id")
