"""Decisions on doubtful behaviour, each on a few rows."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartloom.config import LocationDefaults, MinorUnitOrderConfig, OrderConfig, PartyConfig, TaxRow
from cartloom.functions import codes as cd
from cartloom.functions import text as tx
from cartloom.operators import merge as mg
from cartloom.operators import relational as rl
from cartloom.operators import temporal as tp
from cartloom.plans import orders as od
from cartloom.plans import parties as pt
from cartloom.plans import places as pl
from cartloom.plans import push as ps
from cartloom.plans import queue as qu
from cartloom.plans import stock as st
from cartloom.sources.schemas import ORDER_A, ORDER_B
from cartloom.sources.tables import parse_documents, read_source, successful_payments, write_documents

def now():
    return F.lit("2024-02-01 10:30:00").cast("timestamp")



def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def parsed(spark, docs, schema=ORDER_A):
    data = [(d.get("name") or d.get("orderId"), json.dumps(d)) for d in docs]
    return parse_documents(spark.createDataFrame(data, "order_id string, document string"), "document", schema)


def order(name, **over):
    place = {"name": "Ana Ruiz", "first_name": "Ana", "last_name": "Ruiz Paz", "company": "123", "address1": "A 1",
             "address2": None, "phone": "+57300", "country": "Colombia", "province": "Cundinamarca", "city": "Zipa"}
    base = {
        "name": name, "id": name, "customer": {"email": "a@example.com", "created_at": "2023-05-06T10:00:00-05:00", "default_address": place},
        "billing_address": {**place, "company": "900123456-7"}, "shipping_address": place,
        "line_items": [{"id": "9", "sku": "B", "quantity": 2, "price": "10.00", "discount_allocations": [{"amount": "3.00"}, {"amount": "1.00"}]},
                       {"id": "10", "sku": "A", "quantity": 1, "price": "5.00", "discount_allocations": []}],
        "shipping_lines": [{"price": "8.00", "is_removed": False, "discount_allocations": []}],
        "discount_applications": [{"type": "manual", "value": "1", "target_type": "line_item", "value_type": "fixed"}],
        "payment_gateway_names": ["gift_card", "Wompi"],
    }
    return {**base, **over}


# --- documents ---------------------------------------------------------------


def test_unreadable_documents_are_marked_not_fatal(spark):
    data = [("a", '{"name": "x"}'), ("b", '{"name": '), ("c", None), ("d", "")]
    out = parse_documents(spark.createDataFrame(data, "order_id string, document string"), "document", "name string")
    got = {r.order_id: r.reject_reason for r in out.collect()}
    assert got["a"] is None and got["b"] == "unreadable document" and got["c"] == "unreadable document"


def test_null_arrays_give_a_header_and_empty_sections(spark):
    bare = order("#1", line_items=None, shipping_lines=None, discount_applications=None, payment_gateway_names=None)
    doc = json.loads(od.build_order_docs(parsed(spark, [bare]), OrderConfig(), now()).first()["json"])
    assert len(doc["Pedidos"]) == 1 and doc["Movto_Pedidos_comercial"] == [] and doc["Descuentos"] == []


def sections(spark, *docs, cfg=None):
    out = od.build_order_docs(parsed(spark, docs), cfg or OrderConfig(discount_type="decimal(18,4)"), now())
    return {r.idOrden: json.loads(r.json) for r in out.collect()}


def test_lines_are_numbered_by_id_as_text_and_freight_is_zero(spark):
    doc = sections(spark, order("#1"))["#1"]
    assert [(m["f431_nro_registro"], m["f431_codigo_barras"]) for m in doc["Movto_Pedidos_comercial"]] == [(1, "A"), (2, "B"), (0, "")]


@pytest.mark.parametrize(
    "lines,n",
    [
        ([], 0), ([{"price": "0.00", "is_removed": False}], 0), ([{"price": "0", "is_removed": False}], 0),
        ([{"price": "8.00", "is_removed": True}], 0), ([{"price": "8.00", "is_removed": False}], 1),
        ([{"price": "8.00", "is_removed": False, "discount_allocations": [{"amount": "1"}]}], 0),
        # One discounted shipping line takes the freight off the whole order.
        ([{"price": "8.00", "is_removed": False}, {"price": "9.00", "is_removed": False, "discount_allocations": [{"amount": "1"}]}], 0),
    ],
)
def test_freight_rule(spark, lines, n):
    doc = sections(spark, order("#1", shipping_lines=lines))["#1"]
    assert sum(m["f431_nro_registro"] == 0 for m in doc["Movto_Pedidos_comercial"]) == n


def test_two_discounts_of_one_line_stay_two_rows(spark):
    doc = sections(spark, order("#1"))["#1"]
    assert [(d["f431_nro_registro"], d["f432_vlr_uni"]) for d in doc["Descuentos"]] == [(2, 1.5), (2, 0.5)]


def test_discounts_need_a_line_item_target_and_a_positive_rest(spark):
    whole = order("#2", discount_applications=[{"target_type": "shipping_line"}])
    free = order("#3")
    free["line_items"][0]["discount_allocations"] = [{"amount": "20.00"}]
    zero = order("#4")
    zero["line_items"][0]["quantity"] = 0
    got = sections(spark, whole, free, zero)
    assert got["#2"]["Descuentos"] == got["#3"]["Descuentos"] == got["#4"]["Descuentos"] == []


def test_money_quotient_keeps_four_places_half_up(spark):
    got = spark.range(1).select(cd.unit_share(F.lit("1.00"), F.lit("3")), cd.unit_share(F.lit("0.0005"), F.lit("10")), cd.unit_share(F.lit("1"), F.lit("0"))).first()
    assert tuple(got) == (Decimal("0.3333"), Decimal("0.0001"), None)


def test_payment_is_the_best_priority_unless_last_is_asked(spark):
    docs = [order("#1"), order("#2", payment_gateway_names=["unknown"]), order("#3", payment_gateway_names=["gift_card", "Addi Payment", "Sistecredito"])]
    g = F.col("doc.payment_gateway_names")
    out = parsed(spark, docs).select(
        "order_id", od.pick_payment(g, OrderConfig())["code"], od.pick_payment(g, OrderConfig(payment_pick="last"))["code"], od.last_gateway(g)
    )
    assert rows(out, "order_id") == [("#1", "C009", "C006", "Wompi"), ("#2", None, None, "unknown"), ("#3", "C005", "C006", "Sistecredito")]


def test_values_never_leak_from_one_order_to_the_next(spark):
    second = order("#2", payment_gateway_names=["unknown"], billing_address={"company": " "}, customer={"default_address": {"company": None}})
    got = sections(spark, order("#1"), second)
    assert got["#1"]["Pedidos"][0]["f430_id_tercero_fact"] == "900123456-7"
    assert got["#2"]["Pedidos"][0]["f430_id_tercero_fact"] == "22222222"
    assert got["#2"]["Pedidos"][0]["f430_id_tipo_cli_fact"] == ""
    assert len(got["#2"]["Pedidos"]) == 1


# --- minor units -------------------------------------------------------------


def profile(oid, benefits=(), **over):
    base = {
        "orderId": oid, "sequence": "5", "clientProfileData": {"document": "1", "firstName": "Jo & Co", "lastName": "Paz", "phone": "+571", "email": "x@example.com"},
        "shippingData": {"address": {"street": "s", "postalCode": "05001"}, "logisticsInfo": [{"deliveryCompany": "Other", "selectedSla": "A", "slas": [
            {"id": "A", "deliveryChannel": "pickup-in-point", "pickupStoreInfo": {"friendlyName": "Shop 1"}}]}]},
        "items": [{"id": "1", "uniqueId": "u1", "ean": "E2", "quantity": 1, "price": 11900, "sellingPrice": 5950},
                  {"id": "2", "uniqueId": "u2", "ean": "E1", "quantity": 1, "price": 10000, "sellingPrice": 10000}],
        "totals": [{"id": "Items", "value": 3}, {"id": "Shipping", "value": 50000}], "sellers": [{"name": "Main"}],
        "paymentData": {"transactions": [{"payments": [{"id": "p", "paymentSystemName": "Card"}]}]},
        "ratesAndBenefitsData": {"rateAndBenefitsIdentifiers": [{"name": b} for b in benefits]},
    }
    return {**base, **over}


def master(spark):
    return spark.createDataFrame([("E2", "UND", "0001"), ("E1", "PAR", "0002")], "barcode string, unit string, tax_group string")


def minor(spark, *docs):
    out = od.build_minor_unit_order_docs(parsed(spark, docs, ORDER_B), master(spark), MinorUnitOrderConfig(), now())
    return {r.idOrden: json.loads(r.json) for r in out.collect()}


def test_minor_unit_document(spark):
    doc = minor(spark, profile("MLC1"))["MLC1"]
    assert [(m["f431_nro_registro"], m["f431_codigo_barras"], m["f431_precio_unitario"], m["f431_id_motivo"]) for m in doc["Movimientos"]] == [
        (1, "E1", 100, "25"), (2, "E2", 100, "25"), (3, "", 500, "25")]
    assert [t["F433_TASA"] for t in doc["Impuestos"]] == [0, 19]
    assert [(d["f431_nro_registro"], d["f432_vlr_uni"]) for d in doc["Descuento"]] == [(2, 50)]
    head = doc["Pedidos"][0]
    assert head["f430_num_docto_referencia"] == "01 5" and head["f419_contacto"] == "JO Y CO PAZ"
    assert head["f430_notas"] == "OrderId: MLC1 Secuencia: 5 Metodo Pago: Card Tienda: Shop 1"


def test_exempt_region_has_no_tax_rows_and_its_own_discount(spark):
    doc = minor(spark, profile("v1", ["Impuesto en San Andres"]))["v1"]
    assert doc["Impuestos"] == [] and [d["f432_vlr_uni"] for d in doc["Descuento"]] == [41]


def test_an_order_without_items_keeps_its_header(spark):
    doc = minor(spark, profile("v2", items=None), profile("v3", items=[]))
    for d in doc.values():
        assert len(d["Pedidos"]) == 1 and [m["f431_nro_registro"] for m in d["Movimientos"]] == [1]


def test_near_equal_minor_prices_give_the_full_price(spark):
    got = spark.range(1).select(cd.exempt_discount(F.lit(10000.0), F.lit(9999.5), F.lit(False), F.lit(False))).first()[0]
    assert got == 100


# --- parties -----------------------------------------------------------------


def places(spark):
    data = [
        ("Colombia", "Bogotá D.C.", "Bogotá, D.C.", "169", "11", "001"), ("Colombia", "Cundinamarca", "Zipa", "169", "25", "899"),
        ("Colombia", "Bolívar", "Cartagena de Indias", "169", "13", "001"), ("Colombia", "Caldas", "Villa", "169", "17", "873"),
        ("Colombia", "Caldas", "Villa María", "169", "17", "874"), ("México", "Ciudad de México", "Ciudad de México", "493", "09", "010"),
        ("Colombia", "Tolima", "Villa", "169", "73", "001"),
    ]
    return spark.createDataFrame(data, "country_name string, state_name string, city_name string, country_id string, state_id string, city_id string")


@pytest.mark.parametrize(
    "asked,want",
    [
        (("COLOMBIA", "Cundinamarca", "Bogotá"), ("11", "001", 1)), (("colombia", "Bogota", "BOGOTÁ D.C"), ("11", "001", 1)),
        (("Colombia", "Cundinamarca", "ZIPA"), ("25", "899", 2)), (("Colombia", "Bolivar", "cartagena"), ("13", "001", 3)),
        (("mexico", "ciudad de méxico", "CDMX"), ("09", "010", 4)), (("Colombia", "caldas", "villa"), ("17", "873", 5)),
        (("Colombia", "Caldas", "la villa maria centro"), ("17", "873", 6)), (("Colombia", "Caldas", "nowhere"), ("05", "001", None)),
        (("Peru", "Caldas", "villa"), ("05", "001", None)), ((None, None, None), ("05", "001", None)),
        (("Colombia", None, "villa"), ("05", "001", None)),
    ],
)
def test_place_rules(spark, asked, want):
    df = spark.createDataFrame([asked, asked], "c string, s string, t string")
    out = pl.resolve_location(df, places(spark), "c", "s", "t", LocationDefaults())
    got = [(r.state_id, r.city_id, r.location_rule) for r in out.collect()]
    assert got == [want, want]


def test_party_documents(spark):
    no_id = order("#2")
    no_id["billing_address"] = {**no_id["billing_address"], "company": " "}
    no_id["customer"]["default_address"] = {**no_id["customer"]["default_address"], "company": None}
    cfg = PartyConfig(taxes=(TaxRow("46"), TaxRow("47", "5")))
    out = {r.idOrden: json.loads(r.json) for r in pt.build_party_docs(parsed(spark, [order("#1"), no_id]), places(spark), cfg).collect()}
    assert set(out) == {"#1"}
    party = out["#1"]["Terceros"][0]
    assert party["F200_ID"] == "9001234567" and party["F200_ID_TIPO_IDENT"] == "N" and party["F200_IND_TIPO_TERCERO"] == "2"
    assert (party["F200_APELLIDO1"], party["F200_APELLIDO2"]) == ("RUIZ", "PAZ")
    assert party["F015_ID_CIUDAD"] == "899" and party["F015_TELEFONO"] == "300" and party["F200_FECHA_NACIMIENTO"] == "20230506"
    assert party["F015_DIRECCION2"] == "" and list(party)[0] == "F200_ID" and len(party) == 20
    assert [t["F_ID_CLASE"] for t in out["#1"]["ImptosyReten"]] == ["1", "5"] and out["#1"]["EntDinamicaTercero"] == []


def test_profile_company_uses_its_real_path_for_the_activity(spark):
    firm = profile("v1")
    firm["clientProfileData"] = {"document": "", "corporateDocument": "800", "firstName": "A", "lastName": "De La Cruz"}
    out = pt.build_profile_party_docs(parsed(spark, [firm, profile("v2")], ORDER_B), MinorUnitOrderConfig(), (), (), now())
    docs = {r.idOrden: json.loads(r.json)["Terceros"][0] for r in out.collect()}
    assert docs["v1"]["F200_ID_CIIU"] == "9999" and docs["v1"]["F200_ID"] == "800" and docs["v1"]["F200_APELLIDO2"] == "LA CRUZ"
    assert docs["v2"]["F200_ID_CIIU"] == "0081" and docs["v1"]["F015_EMAIL"] == "SINCORREO@EXAMPLE.COM"


def test_identity_policy(spark):
    df = spark.createDataFrame([("NIT 900-1", "5"), ("none", "C 77"), (None, "x")], "b string, c string")
    out = df.select(qu.party_id(F.col("b"), F.col("c")), qu.party_id(F.col("b"), F.col("c"), "222"))
    assert rows(out) == [("900-1", "900-1"), ("77", "77"), (None, "222")]


# --- queue -------------------------------------------------------------------


def test_orders_without_id_are_retried_or_passed_never_looped(spark):
    q = spark.createDataFrame([(1, 1, 0), (2, 1, 3)], "id int, state int, attempts int")
    outcome = F.when(F.col("id") == 1, F.lit("no_id")).otherwise(F.lit("parked"))
    assert rows(qu.step(q, outcome), "id") == [(1, 1, 1), (2, 1, 99)]
    assert rows(qu.step(q, outcome, True), "id") == [(1, 2, 0), (2, 1, 99)]


def test_queue_gate_takes_the_limit_as_an_option(spark):
    q = spark.createDataFrame([(3, 1, 3), (1, 1, 4), (2, 1, 0), (4, 2, 0)], "id int, state int, attempts int")
    assert [r[0] for r in rows(qu.pending(q, 1, 3, 1))] == [2]
    assert [r[0] for r in rows(qu.pending(q, 1, 3), "id")] == [2, 3]


def test_every_pending_order_is_processed(spark):
    docs = [order(f"#{i}") for i in range(7)]
    assert od.build_order_docs(parsed(spark, docs), OrderConfig(), now()).count() == 7


def test_errors_can_fall_in_two_categories_and_the_rest_is_other(spark):
    logs = spark.createDataFrame(
        [(1, "x FALTA el nombre del contacto; Movto Inventario: Item sin cantidad disponible"), (2, "some Error"), (3, "fine"), (4, None)],
        "id int, log string",
    )
    out = qu.triage_errors(logs, "log").select("id", "category")
    assert sorted(rows(out)) == [(1, "missing_contact"), (1, "no_stock"), (2, "other")]


# --- merges ------------------------------------------------------------------


def test_merge_is_idempotent_and_compares_nulls(spark):
    target = spark.createDataFrame([(1, 5, True), (2, None, True), (3, 7, True)], "k int, v int, synced boolean")
    source = spark.createDataFrame([(1, 6), (2, None), (4, 1)], "k int, v int")
    change = {"synced": F.lit(False)}
    once = mg.merge_changed(target, source, ["k"], ["v"], change)
    assert rows(once, "k") == [(1, 6, False, "update"), (2, None, True, "keep"), (3, 7, True, "keep"), (4, 1, False, "insert")]
    again = mg.merge_changed(once.drop("action"), source, ["k"], ["v"], change)
    assert {r.action for r in again.collect()} == {"keep"}
    assert rows(mg.merge_stats(once)) == [(4, 1, 1)]


def test_merge_source_copies_are_reduced_first(spark):
    target = spark.createDataFrame([(1, 5)], "k int, v int")
    source = spark.createDataFrame([(1, 9), (1, 6), (1, 7)], "k int, v int")
    assert rows(mg.merge_changed(target, source, ["k"], ["v"], {})) == [(1, 6, "update")]


def test_snapshot_write_never_replaces(spark, tmp_path):
    df = spark.range(3)
    mg.write_snapshot(df, str(tmp_path / "s"))
    with pytest.raises(Exception, match="(?i)exist"):
        mg.write_snapshot(df, str(tmp_path / "s"))
    write_documents(df, str(tmp_path / "d"))
    back = read_source(spark, str(tmp_path / "d"), ["id"], F.col("id") > 0, fmt="json", schema="id bigint")
    assert rows(back, "id") == [(1,), (2,)]


# --- the rest ----------------------------------------------------------------


def test_source_guard(spark):
    with pytest.raises(rl.EmptySource, match="no warehouse"):
        rl.require_rows(spark.range(0), "no warehouse")
    assert rl.require_rows(spark.range(1), "x").count() == 1


def test_catalogue_by_sku_alone_fans_out_and_by_warehouse_does_not(spark):
    catalogue = spark.createDataFrame([(1, "S", 10), (1, "S", 11), (None, "S", 10)], "inventory_item_id bigint, sku string, location_id bigint")
    wh = spark.createDataFrame([(10, "A"), (11, "B")], "location_id bigint, warehouse string")
    stock = spark.createDataFrame([("S", "A", 4), ("S", "B", 0), ("S", "C", 9)], "sku string, warehouse string, available int")
    assert [(r.warehouse, r.available) for r in st.catalogue_stock(catalogue, wh, stock, "A").orderBy("warehouse").collect()] == [("A", 4), ("B", 0)]
    assert st.catalogue_stock(catalogue, wh, stock, "A", match_warehouse=False).count() == 6


def test_latest_ties_stay_and_as_of_respects_the_cut(spark):
    p = spark.createDataFrame([(1, 1, 5.0), (1, 2, 6.0), (1, 2, 7.0), (1, 3, 8.0), (2, 1, 0.5)], "k int, t int, price double")
    assert sorted(r.price for r in tp.latest_by_max(p, ["k"], "t").collect()) == [0.5, 8.0]
    assert sorted(r.price for r in tp.price_as_of(p, ["k"], "t", F.lit(2), "price").collect()) == [6.0, 7.0]


def test_extension_and_item_ids_do_not_share_a_key(spark):
    p = spark.createDataFrame([(5, None, 1, 1.0), (None, 5, 2, 2.0)], "item bigint, ext bigint, t int, price double")
    assert tp.latest_price(p, "ext", "item", "t", ["price"]).count() == 2


def test_duplicates_keep_the_smallest_id(spark):
    q = spark.createDataFrame([(3, "#1", 1), (1, "#1", 1), (2, "#2", 1), (4, "#1", 2)], "id int, order_id string, state int")
    assert rows(tp.tag_duplicates(q, "order_id", "id").select("id", "order_id", "state"), "id") == [
        (1, "#1", 1), (2, "#2", 1), (3, "#1-1", 3), (4, "#1-1", 3)]


def test_contains_join_equals_brute_force(spark):
    texts = ["order v12 paid", "v1", "", "ññv12ññ v123", "nothing", "v12v12", None]
    needles = ["v12", "v1", "v123", "ñv", "zz"]
    a = spark.createDataFrame(list(enumerate(texts)), "id int, txt string")
    b = spark.createDataFrame([(n,) for n in needles], "needle string")
    got = sorted((r.id, r.needle) for r in rl.contains_join(a, b, "txt", "id", "needle").collect())
    assert got == sorted((i, n) for i, t in enumerate(texts) if t for n in needles if n in t)


def test_contains_join_across_windows(spark):
    import random

    rng = random.Random(5)
    texts = ["".join(rng.choice("abñ😀 ") for _ in range(n)) for n in (5, 191, 192, 193, 400, 3000)] + ["x" * 1000, None, ""]
    needles = [texts[k][at : at + n] for k in range(1, 6) for at, n in ((0, 3), (150, 41), (len(texts[k]) - 9, 9))]
    needles += [texts[4][10:330], "xx", "x", "", None, "a.b", "(", texts[5][100:104], texts[5][100:104]]
    a = spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(texts)], "id int, txt string, side int")
    b = spark.createDataFrame([(n, k % 2, k) for k, n in enumerate(needles)], "needle string, side int, k int")
    got = sorted((r.id, r.k) for r in rl.contains_join(a, b.drop("side"), "txt", "id", "needle").collect())
    assert got == sorted((i, k) for i, t in enumerate(texts) for k, n in enumerate(needles) if t and n and n in t)
    got = sorted((r.id, r.k) for r in rl.contains_join(a, b, "txt", "id", "needle", on=("side",), bits=64).collect())
    assert got == sorted((i, k) for i, t in enumerate(texts) for k, n in enumerate(needles) if t and n and n in t and i % 2 == k % 2)
    assert rl.contains_join(a, b.drop("side").limit(0), "txt", "id", "needle").collect() == []


def test_ambiguous_places(spark):
    p = places(spark).select(tx.fold(F.col("city_name")).alias("city"), tx.fold(F.col("state_name")).alias("state"), *pl.CODES)
    asked = spark.createDataFrame([("villa", "tolima"), ("villa", "nowhere"), ("zipa", "nowhere"), ("lost", "zipa"), (None, None)], "city string, state string")
    out = rl.lookup_by_ambiguity(asked, p, "city", "state", pl.CODES)
    assert sorted(str(r.state_id) for r in out.collect()) == ["25", "25", "73", "None", "None"]


def test_eligible_and_skipped_make_up_the_input(spark):
    pending = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 1)], "inventory_item_id int, location_id int")
    checks = spark.createDataFrame(
        [(1, 1, 1, True, None), (1, 1, 2, False, None), (1, 2, 1, True, None), (2, 1, 1, True, "err")],
        "inventory_item_id int, location_id int, checked_at int, stocked boolean, error string",
    )
    ok, skipped = ps.eligible_split(pending, checks)
    assert rows(ok) == [(1, 2)] and ok.count() + skipped.count() == 4


def test_first_successful_payment(spark):
    tx_rows = [("1", 2, "B", "success"), ("1", 1, "A", "failure"), ("1", 3, "C", "success"), ("2", 1, "D", "pending")]
    df = spark.createDataFrame([(o, n, json.dumps({"gateway": g, "status": s})) for o, n, g, s in tx_rows], "order_id string, n int, document string")
    assert rows(successful_payments(df, ["n"])) == [("1", "B")]


@pytest.mark.parametrize(
    "number,origin,want",
    [("2000123", "mercadolibre", "123"), ("2000123", "shop", "2000123"), ("2000012345678901", "mercadolibre", "2345678901"),
     ("000", "mercadolibre", "000"), ("12", "mercadolibre", "2"), (None, "mercadolibre", None)],
)
def test_external_reference(spark, number, origin, want):
    df = spark.createDataFrame([(number, origin)], "n string, o string")
    assert df.select(tx.external_reference(F.col("n"), F.col("o"), 10, ["mercadolibre"])).first()[0] == want


@pytest.mark.parametrize("name,first,rest", [("Ruiz", "Ruiz", ""), ("De la Cruz", "De", "la Cruz"), (" Paz  Gil ", "Paz", "Gil"), ("", "", "")])
def test_surnames(spark, name, first, rest):
    df = spark.createDataFrame([(name,)], "n string")
    assert tuple(df.select(tx.first_surname(F.col("n")), tx.other_surnames(F.col("n"))).first()) == (first, rest)


def test_instants_use_their_offset(spark):
    df = spark.createDataFrame([("2025-11-26T15:00:00-05:00",), ("bad",)], "t string")
    got = [r[0] for r in df.select(F.date_format(tx.iso_instant(F.col("t")), "HH:mm")).collect()]
    assert got == ["20:00", None]


def test_bare_decimals_round_to_whole_numbers(spark):
    doc = sections(spark, order("#1"), cfg=OrderConfig())["#1"]
    assert [d["f432_vlr_uni"] for d in doc["Descuentos"]] == [2, 1]
    assert datetime.strptime(doc["Pedidos"][0]["f430_id_fecha"], "%Y%m%d") == datetime(2024, 2, 1)
