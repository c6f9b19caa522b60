"""Whole jobs: configured order and party documents, and the polled queue."""

import json

from pyspark.sql import functions as F

from cartloom.config import CurrencyRule, MarketplaceConfig, OrderConfig, PartyConfig
from cartloom.plans import orders as od
from cartloom.plans import parties as pt
from cartloom.sources.schemas import DOCUMENT_SCHEMA, ORDER_A, ORDER_C
from cartloom.sources.tables import parse_documents
from cartloom.streaming.queue_feed import drain, follow_queue
from tests.test_hazards import now, order, parsed, places


def test_order_options(spark):
    doc = order("#1", updated_at="2023-12-31T23:00:00-05:00", shipping_lines=[
        {"price": "10000.00", "is_removed": False}, {"price": "1.00", "is_removed": False}])
    doc["line_items"][0]["sku"] = "0077"
    cfg = OrderConfig(
        sections=("Pedidos", "MovtoPedidoscomercial", "Descuentos"), day_from="updated", drop_leading_zero=True,
        freight_by_price={"10000.00": ("0002692", "Flete local")},
    )
    out = json.loads(od.build_order_docs(parsed(spark, [doc]), cfg, now()).first()["json"])
    head, lines = out["Pedidos"][0], out["MovtoPedidoscomercial"]
    assert (head["f430_id_fecha"], head["f430_fecha_entrega"]) == ("20231231", "20240101")
    assert [line["f431_codigo_barras"] for line in lines] == ["A", "077", "", ""]
    assert [(line["f431_referencia_item"], line["f431_notas"]) for line in lines[2:]] == [("0002692", "Flete local"), ("", "")]


def test_result_contract(spark):
    df = od.build_order_docs(parsed(spark, [order("#1")]), OrderConfig(), now())
    assert [f"{f.name} {f.dataType.simpleString()}" for f in df.schema] == DOCUMENT_SCHEMA.split(", ")


def test_foreign_orders_take_the_foreign_attributes(spark):
    cfg = PartyConfig(by_currency=CurrencyRule())
    docs = parsed(spark, [order("#1", currency="usd"), order("#2", currency="COP")])
    out = {r.idOrden: json.loads(r.json) for r in pt.build_party_docs(docs, places(spark), cfg).collect()}
    assert [(out[k]["Clientes"][0]["F201_ID_TIPO_CLI"], out[k]["Clientes"][0]["F201_ID_LISTA_PRECIO"],
             out[k]["ImptosyReten"][0]["F_ID_VALOR_TERCERO"]) for k in ("#1", "#2")] == [("EXT", "002", "0"), ("NAC", "001", "1")]


def market(spark, **over):
    doc = {
        "orderId": "M1", "origin": "mercadolibre", "Warehouse": {"name": "FULL"}, "CheckoutLinks": [{"externalOrderNumber": "2000055"}],
        "Client": {"taxId": "9001234567", "fullName": "Big & Co", "name": "big & co", "phoneNumber": "+57 3#0", "BillingAddresses": [
            {"city": "VILLA", "state": "tolima", "country": "co"}]},
        "CheckoutItems": [{"count": 2, "gross": 119, "ProductVersion": {"_id": "b", "code": "A-1", "Product": {"name": "hp ink"}},
                           "CheckoutItemDiscounts": [{"discount": 10}]},
                          {"count": 1, "gross": 50, "ProductVersion": {"_id": "a", "code": "B", "Product": {"name": "x"}}}],
    }
    return parsed(spark, [{**doc, **over}], ORDER_C)


def test_marketplace_order(spark):
    items = spark.createDataFrame([("A#1", "KIT ")], "reference string, unit string")
    rates = spark.createDataFrame([("A#1", 19)], "reference string, rate int")
    doc = json.loads(od.build_marketplace_order_docs(market(spark), items, rates, MarketplaceConfig(), now()).first()["json"])
    lines = [(m["f431_nro_registro"], m["f431_referencia_item"], m["f431_id_unidad_medida"], m["f431_precio_unitario"]) for m in doc["MovtoPedidosComercial"]]
    assert lines == [(1, "B", "UND", 50.0), (2, "A#1", "KIT", 95.8)]
    assert doc["Pedidos"][0]["f430_referencia"] == "55" and doc["Pedidos"][0]["f430_notas"].endswith("Venta: 2000055   Bodega: FULL")


def test_marketplace_party(spark):
    doc = json.loads(pt.build_marketplace_party_docs(market(spark), places(spark), MarketplaceConfig(), now()).first()["json"])
    party = doc["Terceros"][0]
    assert (party["F200_ID"], party["F200_ID_TIPO_IDENT"], party["F200_RAZON_SOCIAL"], party["F200_NOMBRES"]) == ("900123456", "N", "BIG  CO", "")
    assert party["F015_ID_DEPTO"] == "73" and party["F015_TELEFONO"] == "30"
    assert doc["CriteriosClientes"][0]["F207_ID_CRITERIO_MAYOR"] == "101" and doc["EntidadTercero"][0]["f753_id_maestro_detalle"] == "48"


def test_polled_queue_writes_every_order_once(spark, tmp_path):
    schema = "order_id string, state int, attempts int, document string"

    def arrive(names):
        data = [(n, 2, a, json.dumps(order(n))) for n, a in names]
        spark.createDataFrame(data, schema).write.mode("append").parquet(str(tmp_path / "in"))

    def build(batch):
        docs = parse_documents(batch, "document", ORDER_A).where("reject_reason is null")
        return od.build_order_docs(docs, OrderConfig(), now())

    progress, out = str(tmp_path / "progress"), str(tmp_path / "out")

    def run():
        drain(follow_queue(spark, str(tmp_path / "in"), schema, 2, 3), build, out, progress).awaitTermination(120)
        return sorted(r.idOrden for r in spark.read.parquet(out).select(F.col("idOrden")).collect())

    arrive([("#1", 0), ("#2", 4)])
    assert run() == ["#1"]
    arrive([("#3", 3)])
    assert run() == ["#1", "#3"]
    assert run() == ["#1", "#3"]
