"""Label requests: gates, escaping, both layouts."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cartloom.config import LABEL_EMPTY, LABEL_FIELDS, LabelConfig
from cartloom.functions.text import xml_text
from cartloom.plans.labels import label_requests

ORDERS = "order_id string, state int, attempts int, endpoint string, delivery string, party_id string, name string, address string, city string, phone string"


def made(spark, cfg=LabelConfig()):
    rest = ("900", 'Ana & <Co> "x"', "Calle 1", "05001000", "+573001")
    rows = [
        ("v1", 7, 0, None, "Contra-entrega", *rest), ("v2", 7, 3, "party", "Contra-entrega", *rest), ("v3", 7, 4, None, "Contra-entrega", *rest),
        ("v4", 7, 0, "labels", "Contra-entrega", *rest), ("v5", 3, 0, None, "Contra-entrega", *rest), ("v6", 7, 1, "labels", "Otro", *rest),
        ("v7", 7, 0, None, "Contra-entrega", *rest),
    ]
    invoices = spark.createDataFrame([(i, f"pedido v{i} tienda", f"FE-{i}") for i in range(1, 7)], "invoice_id long, notes string, invoice_number string")
    return label_requests(spark.createDataFrame(rows, ORDERS), invoices, {"id_cliente": "1", "nombre_remitente": "A & B"}, cfg)


@pytest.mark.parametrize("layout", ["plain", "typed"])
def test_gates(spark, layout):
    requests, skipped = made(spark, LabelConfig(layout=layout))
    assert sorted(r["order_id"] for r in requests.collect()) == ["v1", "v2"]
    assert [(r["order_id"], r["state"], r["attempts"]) for r in skipped.collect()] == [("v6", 8, 0)]


def test_layouts_are_well_formed_and_hold_the_same_values(spark):
    import xml.etree.ElementTree as ET

    told = {}
    for layout in ("plain", "typed"):
        requests, _ = made(spark, replace(LabelConfig(layout=layout), content="a <b> & c", declared_value=5))
        root = ET.fromstring(requests.where("order_id = 'v1'").first()["request"])
        body = root.find(".//p")
        told[layout] = {e.tag: (e.text or "") for e in body if e.tag in LABEL_FIELDS}
        if layout == "typed":
            kinds = {e.tag: e.attrib["{http://www.w3.org/2001/XMLSchema-instance}type"] for e in body if e.tag in LABEL_FIELDS}
            assert kinds == {k: f"xsd:{v}" for k, v in LABEL_FIELDS.items()} and [e.tag for e in body][-len(LABEL_EMPTY):] == list(LABEL_EMPTY)
    assert told["plain"] == told["typed"] and told["plain"]["nombre_destinatario"] == 'Ana & <Co> "x"'
    assert told["plain"]["contenido"] == "a <b> & c" and told["plain"]["valor_declarado"] == "5"


def test_xml_text(spark):
    df = spark.createDataFrame([("a&b<c>\x01\n",), (None,)], "t string")
    assert [r[0] for r in df.select(xml_text(F.col("t"))).collect()] == ["a&amp;b&lt;c&gt;\n", ""]
