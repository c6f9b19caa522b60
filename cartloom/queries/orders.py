"""Order document queries in the three shop dialects."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartloom.config import MarketplaceConfig, MinorUnitOrderConfig, OrderConfig
from cartloom.functions import codes as cd
from cartloom.plans import orders as od
from cartloom.queries.documents import DOCS_SQL, ITEMS_SQL, parsed_orders
from cartloom.queries.registry import (
    CENTS_SQL, LINES_SQL, NATIONS_SQL, PEOPLE_SQL, PRICE_CENTS_SQL, QTY_SQL, order_name, query, run_ts,
    table, text, unit_price, with_customer, with_lines, with_person,
)
from cartloom.sources.schemas import ORDER_B, ORDER_C, only
from cartloom.sources.tables import parse_documents

CFG = OrderConfig(price_type="decimal(18,2)", discount_type="decimal(18,4)")
PAYMENT_SQL = """
CASE o_orderpriority WHEN '1-URGENT' THEN 'C009' WHEN '2-HIGH' THEN 'C004' WHEN '3-MEDIUM' THEN 'C008' WHEN '5-LOW' THEN 'C006' END
"""
# Unit discount in ten-thousandths, half up.
UNIT_SQL = "((amount * 100 * 2 + q) // (2 * q))"


@query(f"""
WITH {DOCS_SQL}
SELECT order_name AS order_id, {PAYMENT_SQL} AS code, CASE o_orderpriority WHEN '1-URGENT' THEN 'Wompi' WHEN '2-HIGH' THEN 'Addi Payment'
       WHEN '3-MEDIUM' THEN 'Mercado Pago Checkout Pro' WHEN '5-LOW' THEN 'gift_card' END AS value,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'C006' WHEN '2-HIGH' THEN 'C004' WHEN '3-MEDIUM' THEN 'C006' WHEN '5-LOW' THEN 'C006' END AS last_code FROM docs
""")
def pick_payment(spark, sf):
    gateways = F.col("doc.payment_gateway_names")
    first, last = od.pick_payment(gateways, CFG), od.pick_payment(gateways, OrderConfig(payment_pick="last"))
    return parsed_orders(spark, sf).select(
        "order_id", first["code"].alias("code"), first["value"].alias("value"), last["code"].alias("last_code")
    )


@query(f"""
WITH {DOCS_SQL}
SELECT order_name AS order_id, f.price, CAST(0 AS INTEGER) AS line_no FROM docs
JOIN (VALUES (3, 14000.0::DOUBLE), (3, 9000.0::DOUBLE)) AS f(rest, price) ON o_orderkey % 5 = rest AND part = 1
""")
def freight_lines(spark, sf):
    rows = parsed_orders(spark, sf).select("order_id", F.explode(od.freight_lines(F.col("doc"), CFG, run_ts())).alias("l"))
    return rows.select("order_id", F.col("l.f431_precio_unitario").cast("double").alias("price"), F.col("l.f431_nro_registro").alias("line_no"))


@query(f"""
WITH {DOCS_SQL}, {ITEMS_SQL}
SELECT order_name AS order_id, CAST(line_no AS INTEGER) AS line_no, {UNIT_SQL} / 10000.0 AS unit_discount
FROM allocs WHERE o_orderkey % 3 = 0 AND {UNIT_SQL} > 0 AND price_cents * q - amount > 0
""")
def line_discounts(spark, sf):
    rows = parsed_orders(spark, sf, "line_items", "discount_applications").select("order_id", F.explode(od.line_discounts(F.col("doc"), CFG)).alias("d"))
    return rows.select("order_id", F.col("d.f431_nro_registro").alias("line_no"), F.col("d.f432_vlr_uni").cast("double").alias("unit_discount"))


ORDER_DOC = (
    "Pedidos array<struct<f430_id_fecha:string,f430_id_tercero_fact:string,f430_fecha_entrega:string,f430_referencia:string,"
    "f430_num_docto_referencia:string,f430_id_tipo_cli_fact:string>>, "
    "Movto_Pedidos_comercial array<struct<f431_nro_registro:int,f431_referencia_item:string,f431_codigo_barras:string,"
    "f431_cant_pedida_base:decimal(18,0),f431_precio_unitario:decimal(18,2),f431_notas:string>>, "
    "Descuentos array<struct<f431_nro_registro:int,f432_vlr_uni:decimal(18,4)>>"
)


@query(f"""
WITH nations AS ({NATIONS_SQL}), people AS ({PEOPLE_SQL}), {DOCS_SQL}, {ITEMS_SQL},
l AS (SELECT order_name, count(*) AS n, SUM(q) AS q, SUM(price_cents) AS cents FROM items GROUP BY 1),
d AS (SELECT order_name, count(*) AS n, SUM({UNIT_SQL}) AS units FROM allocs WHERE o_orderkey % 3 = 0 AND {UNIT_SQL} > 0 AND price_cents * q - amount > 0 GROUP BY 1)
SELECT order_name AS order_id, '20240201' AS day, '20240202' AS delivery,
       COALESCE(NULLIF(trim(COALESCE(billing_company, company)), ''), '22222222') AS party, left(order_name, 10) AS reference,
       COALESCE({PAYMENT_SQL}, '') AS payment, CAST(COALESCE(l.n, 0) + CASE WHEN o_orderkey % 5 = 3 AND part = 1 THEN 2 ELSE 0 END AS INTEGER) AS lines,
       CAST(COALESCE(l.q, 0) + CASE WHEN o_orderkey % 5 = 3 AND part = 1 THEN 2 ELSE 0 END AS BIGINT) AS quantity,
       (COALESCE(l.cents, 0) + CASE WHEN o_orderkey % 5 = 3 AND part = 1 THEN 2300000 ELSE 0 END) / 100.0 AS prices,
       CAST(COALESCE(d.n, 0) AS INTEGER) AS discounts, COALESCE(d.units, 0) / 10000.0 AS unit_discounts
FROM docs LEFT JOIN people ON o_custkey = c_custkey LEFT JOIN l USING (order_name) LEFT JOIN d USING (order_name)
""")
def order_docs(spark, sf):
    """Order documents for the integrator, read back section by section."""
    built = od.build_order_docs(parsed_orders(spark, sf), CFG, run_ts())
    doc = built.select("idOrden", F.from_json("json", ORDER_DOC).alias("d"))
    lines, disc, head = F.col("d.Movto_Pedidos_comercial"), F.col("d.Descuentos"), F.get("d.Pedidos", F.lit(0))

    def total(c, f, kind):
        return F.aggregate(c, F.lit(0).cast(kind), lambda s, x: (s + x[f]).cast(kind))

    return doc.select(
        F.col("idOrden").alias("order_id"), head["f430_id_fecha"].alias("day"), head["f430_fecha_entrega"].alias("delivery"),
        head["f430_id_tercero_fact"].alias("party"), head["f430_referencia"].alias("reference"), head["f430_id_tipo_cli_fact"].alias("payment"),
        F.size(lines).alias("lines"), total(lines, "f431_cant_pedida_base", "decimal(18,0)").cast("bigint").alias("quantity"),
        total(lines, "f431_precio_unitario", "decimal(28,2)").cast("double").alias("prices"),
        F.size(disc).alias("discounts"), total(disc, "f432_vlr_uni", "decimal(28,4)").cast("double").alias("unit_discounts"),
    )


@query(f"""
WITH l AS (SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, {PRICE_CENTS_SQL} AS cents, {CENTS_SQL} AS ext FROM lineitem),
p AS (SELECT 'P' || p_partkey AS sku, p_partkey, CAST(ROUND(p_retailprice * 100) AS BIGINT) AS list_cents FROM part)
SELECT l_orderkey, l_linenumber, sku, cents / 100.0 AS price, list_cents / 100.0 AS list_price, (list_cents - cents) / 100.0 AS gap
FROM l JOIN p ON l_partkey = p_partkey WHERE list_cents > cents
""")
def price_gap_discounts(spark, sf):
    lines = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity").select(
        "l_orderkey", "l_linenumber", F.concat(F.lit("P"), text("l_partkey")).alias("sku"), unit_price().alias("price")
    )
    prices = table(spark, sf, "part", "p_partkey", "p_retailprice").select(
        F.concat(F.lit("P"), text("p_partkey")).alias("sku"), F.col("p_retailprice").cast("decimal(18,2)").alias("price")
    )
    rows = od.price_gap_discounts(lines, prices)
    return rows.select("l_orderkey", "l_linenumber", "sku", *[F.col(c).cast("double").alias(c) for c in ("price", "list_price", "gap")])


@query(f"""
WITH t AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, {CENTS_SQL} AS cents, {QTY_SQL} AS q, CAST(ROUND(l_discount * 100) AS BIGINT) AS pct,
                  CASE WHEN l_partkey % 2 = 0 THEN 19 WHEN l_partkey % 3 = 0 THEN 5 ELSE 0 END AS rate FROM lineitem),
u AS (SELECT *, (2 * ((cents * pct * 2 + 100) // 200) + q) // (2 * q) AS unit FROM t)
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
       ((cents - unit) * 100 * 2 + (100 + rate)) // (2 * (100 + rate)) / 100.0 AS net FROM u
""")
def net_price(spark, sf):
    """Line value less one unit's discount, without tax."""
    ext = F.col("l_extendedprice").cast("decimal(18,2)")
    discount = (ext * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(18,2)")
    rate = F.when(F.col("l_partkey") % 2 == 0, 19).when(F.col("l_partkey") % 3 == 0, 5).otherwise(0)
    lines = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice", "l_discount", "l_quantity")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
        cd.net_unit_price(ext, discount, F.col("l_quantity").cast("int"), rate).cast("double").alias("net"),
    )


@query("""
WITH t AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, CAST(ROUND(l_extendedprice * 100) AS DOUBLE) AS p,
                  CAST(ROUND(l_extendedprice * 100) AS DOUBLE) - CAST(ROUND(l_discount * 100) AS DOUBLE) * 50000.0 AS s,
                  l_partkey % 2 = 0 AS taxed, l_suppkey % 4 = 0 AS exempt FROM lineitem)
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, CAST(CASE
  WHEN exempt THEN CASE WHEN round(p / 1.19::DOUBLE / 100.0::DOUBLE) = round(s / 100.0::DOUBLE) THEN 0
       WHEN taxed THEN round((p - s) / 100.0::DOUBLE - p / 1.19::DOUBLE / 100.0::DOUBLE * 0.19::DOUBLE)
       ELSE round((p - s) / 100.0::DOUBLE - p / 100.0::DOUBLE * 0.19::DOUBLE) END
  WHEN abs(p - s) < 1 THEN round(p / 100.0::DOUBLE)
  WHEN taxed THEN round((p - s) / 1.19::DOUBLE / 100.0::DOUBLE) ELSE round((p - s) / 100.0::DOUBLE) END AS INTEGER) AS discount,
  CAST(CASE WHEN taxed THEN round(p / 1.19::DOUBLE / 100.0::DOUBLE) ELSE round(p / 100.0::DOUBLE) END AS INTEGER) AS price FROM t
""")
def exempt_discount(spark, sf):
    """Discounts in minor units, with and without the regional exemption."""
    p = F.round(F.col("l_extendedprice") * 100)
    s = p - F.round(F.col("l_discount") * 100) * 50000.0
    taxed, exempt = F.col("l_partkey") % 2 == 0, F.col("l_suppkey") % 4 == 0
    lines = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice", "l_discount")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", cd.exempt_discount(p, s, taxed, exempt).alias("discount"),
        cd.whole_from_minor(p, taxed).alias("price"),
    )


@query("""
WITH g AS (SELECT DISTINCT p_type AS tax_group, 'IV0' || (length(p_type) % 4) AS tax_key FROM part WHERE length(p_type) % 3 <> 2),
k AS (SELECT * FROM (VALUES ('IV00', 0), ('IV01', 5), ('IV02', 19), ('IV03', 8)) AS v(tax_key, rate))
SELECT 'R' || p_partkey AS reference, tax_key, rate FROM part JOIN g ON tax_group = p_type JOIN k USING (tax_key)
""")
def item_tax_rates(spark, sf):
    part = table(spark, sf, "part", "p_partkey", "p_type")
    items = part.select(F.lit(1).alias("company_id"), F.concat(F.lit("R"), text("p_partkey"), F.lit("  ")).alias("reference"), F.col("p_type").alias("tax_group"))
    size = F.length("p_type")
    groups = part.select(
        F.lit(1).alias("company_id"), F.col("p_type").alias("tax_group"), F.concat(F.lit("IV0"), text(size % 4)).alias("tax_key"),
        F.when(size % 3 != 2, 3).otherwise(1).alias("indicator"),
    ).distinct()
    keys = spark.createDataFrame([(1, "IV00", 0), (1, "IV01", 5), (1, "IV02", 19), (1, "IV03", 8)], "company_id int, tax_key string, rate int")
    return od.item_tax_rates(items, groups, keys).select("reference", "tax_key", "rate")


# --- minor-unit dialect ------------------------------------------------------


def profile_texts(spark, sf):
    """Queue of profile-dialect documents: prices in minor units, logistics, benefits."""
    key = F.col("o_orderkey")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    item = F.struct(
        text("line_id").alias("id"), F.concat(F.lit("U"), text("line_id")).alias("uniqueId"), F.concat(F.lit("E"), text("l_partkey")).alias("ean"),
        F.concat(F.lit("R"), text("l_partkey")).alias("refId"), text(F.col("l_quantity").cast("int")).alias("quantity"),
        text(cents).alias("price"), text(cents - F.round(F.col("l_discount") * 100).cast("bigint") * 50000).alias("sellingPrice"),
    )
    orders = with_customer(table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderpriority"), spark, sf, "inner")
    rows = with_person(with_lines(orders, spark, sf, item, "items", "l_discount", "inner"), spark, sf)
    prefix = F.when(key % 4 == 0, F.lit("MLC")).when(key % 4 == 1, F.lit("GVL")).otherwise(F.lit("v"))
    company = F.when(F.col("o_custkey") % 4 == 0, F.concat(F.lit("9"), F.lpad(text("o_custkey"), 9, "0")))
    sla = F.struct(
        F.lit("S1").alias("id"), F.when(key % 3 == 0, F.lit("pickup-in-point")).otherwise(F.lit("delivery")).alias("deliveryChannel"),
        F.struct(F.concat(F.lit("Tienda "), text(key % 9)).alias("friendlyName")).alias("pickupStoreInfo"),
    )
    logistics = F.struct(
        F.when(key % 2 == 0, F.lit("Coordinadora")).otherwise(F.lit("Contra-entrega")).alias("deliveryCompany"), F.lit("S1").alias("selectedSla"),
        F.array(sla).alias("slas"),
    )
    body = F.struct(
        F.concat(prefix, text(key)).alias("orderId"), text(key).alias("sequence"), F.lit("web").alias("origin"),
        F.struct(
            F.when(company.isNull(), F.lpad(text("o_custkey"), 8, "1")).alias("document"), company.alias("corporateDocument"),
            F.when(F.col("o_custkey") % 3 == 0, F.lit("cedulaCOL")).when(F.col("o_custkey") % 3 == 1, F.lit("pasaporte")).alias("documentType"),
            F.col("first_name").alias("firstName"), F.col("last_name").alias("lastName"), "phone", "email",
        ).alias("clientProfileData"),
        F.struct(
            F.struct(F.col("address1").alias("street"), F.col("address2").alias("complement"), F.lit("Centro").alias("neighborhood"),
                     F.lpad(text("o_custkey"), 5, "0").alias("postalCode")).alias("address"),
            F.array(logistics).alias("logisticsInfo"),
        ).alias("shippingData"),
        F.col("items"), F.array(F.struct(F.lit("Shipping").alias("id"), text(F.when(F.col("part") == 1, (key % 3) * 500000).otherwise(0)).alias("value"))).alias("totals"),
        F.array(F.struct(F.lit("Main seller").alias("name"))).alias("sellers"),
        F.struct(
            F.array(F.struct(F.array(F.struct(F.concat(F.lit("pay"), text(key)).alias("id"), F.col("o_orderpriority").alias("paymentSystemName"))).alias("payments"))).alias("transactions")
        ).alias("paymentData"),
        F.struct(
            F.when(key % 6 == 0, F.array(F.struct(F.lit("Impuesto en San Andres").alias("name")))).otherwise(F.array().cast("array<struct<name:string>>")).alias("rateAndBenefitsIdentifiers")
        ).alias("ratesAndBenefitsData"),
    )
    return rows.select(order_name(key, F.col("part")).alias("order_id"), "o_orderkey", "o_custkey", "part", F.to_json(body).alias("document"))


def profile_orders(spark, sf):
    return parse_documents(profile_texts(spark, sf), "document", ORDER_B).where("reject_reason is null")


def item_master(spark, sf):
    k = F.col("p_partkey")
    return table(spark, sf, "part", "p_partkey").where(k % 5 != 0).select(
        F.concat(F.lit("E"), text(k)).alias("barcode"), F.when(k % 3 == 0, F.lit("PAR")).otherwise(F.lit("UND")).alias("unit"),
        F.when(k % 2 == 0, F.lit("0001")).otherwise(F.lit("0002")).alias("tax_group"),
    )


@query(f"""
WITH {DOCS_SQL}
SELECT d.order_name AS order_id, 'OrderId: ' || p || o_orderkey || ' Secuencia: ' || o_orderkey || ' Metodo Pago: ' || o_orderpriority || ' Tienda: ' ||
       CASE WHEN o_orderkey % 2 = 0 THEN CASE p WHEN 'MLC' THEN 'Mercado Libre' WHEN 'GVL' THEN 'AGAVAL' ELSE 'Main seller' END
            WHEN o_orderkey % 3 = 0 THEN 'Tienda ' || (o_orderkey % 9) ELSE 'Contra-entrega' END AS notes
FROM (SELECT *, CASE o_orderkey % 4 WHEN 0 THEN 'MLC' WHEN 1 THEN 'GVL' ELSE 'v' END AS p FROM docs) d WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
""")
def order_notes(spark, sf):
    return profile_orders(spark, sf).select("order_id", od.order_notes(F.col("doc"), MinorUnitOrderConfig()).alias("notes"))


MINOR_SQL = f"""
lines AS ({LINES_SQL}), m AS (
  SELECT '#' || l_orderkey || CASE WHEN part > 1 THEN '-' || part ELSE '' END AS order_id, l_orderkey, part, 'E' || l_partkey AS barcode, q,
         row_number() OVER (PARTITION BY l_orderkey, part ORDER BY 'E' || l_partkey, CAST(line_id AS VARCHAR)) AS line_no,
         CAST(cents AS DOUBLE) AS p, CAST(cents - disc_pct * 50000 AS DOUBLE) AS s, l_partkey % 5 <> 0 AS known,
         l_partkey % 5 <> 0 AND l_partkey % 2 = 0 AS taxed, l_orderkey % 6 = 0 AS exempt,
         CASE WHEN l_partkey % 5 <> 0 AND l_partkey % 3 = 0 THEN 'PAR' ELSE 'UND' END AS unit FROM lines),
priced AS (SELECT *, CAST(CASE WHEN taxed THEN round(p / 1.19::DOUBLE / 100.0::DOUBLE) ELSE round(p / 100.0::DOUBLE) END AS INTEGER) AS unit_price,
  CASE WHEN known AND NOT exempt THEN CASE WHEN taxed THEN 19 ELSE 0 END END AS tax_rate,
  CASE WHEN s <> 0 AND p - s <> 0 THEN CAST(CASE
    WHEN exempt THEN CASE WHEN round(p / 1.19::DOUBLE / 100.0::DOUBLE) = round(s / 100.0::DOUBLE) THEN 0
         WHEN taxed THEN round((p - s) / 100.0::DOUBLE - p / 1.19::DOUBLE / 100.0::DOUBLE * 0.19::DOUBLE) ELSE round((p - s) / 100.0::DOUBLE - p / 100.0::DOUBLE * 0.19::DOUBLE) END
    WHEN abs(p - s) < 1 THEN round(p / 100.0::DOUBLE) WHEN taxed THEN round((p - s) / 1.19::DOUBLE / 100.0::DOUBLE) ELSE round((p - s) / 100.0::DOUBLE) END AS INTEGER) END AS unit_discount FROM m)
"""


@query(f"""
WITH {MINOR_SQL} SELECT order_id, CAST(line_no AS INTEGER) AS line_no, barcode, unit, CAST(q AS VARCHAR) AS quantity, unit_price, tax_rate, unit_discount FROM priced
""")
def minor_unit_lines(spark, sf):
    return od.minor_unit_lines(profile_orders(spark, sf), item_master(spark, sf))


MINOR_DOC = (
    "Pedidos array<struct<f430_id_tercero_fact:string,f430_num_docto_referencia:string>>, "
    "Movimientos array<struct<f431_nro_registro:int,f431_precio_unitario:int,f431_id_motivo:string>>, "
    "Impuestos array<struct<F433_TASA:int>>, Descuento array<struct<f432_vlr_uni:int>>"
)


@query(f"""
WITH {MINOR_SQL}
SELECT order_id, MIN(CASE WHEN o_custkey % 4 = 0 THEN '9' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') ELSE lpad(CAST(o_custkey AS VARCHAR), 8, '1') END) AS party,
       MIN('01 ' || l_orderkey) AS reference, MIN(CASE l_orderkey % 4 WHEN 0 THEN '25' WHEN 1 THEN '26' ELSE '13' END) AS reason,
       CAST(count(*) + MIN(CASE WHEN l_orderkey % 3 > 0 AND part = 1 THEN 1 ELSE 0 END) AS INTEGER) AS lines,
       CAST(SUM(unit_price) + MIN(CASE WHEN part = 1 THEN (l_orderkey % 3) * 5000 ELSE 0 END) AS BIGINT) AS prices, CAST(count(tax_rate) AS INTEGER) AS taxes,
       CAST(count(*) FILTER (unit_discount > 0) AS INTEGER) AS discounts, CAST(COALESCE(SUM(unit_discount) FILTER (unit_discount > 0), 0) AS BIGINT) AS discount_sum
FROM priced JOIN orders ON l_orderkey = o_orderkey GROUP BY order_id
""")
def minor_unit_order_docs(spark, sf):
    built = od.build_minor_unit_order_docs(profile_orders(spark, sf), item_master(spark, sf), MinorUnitOrderConfig(), run_ts())
    doc = built.select("idOrden", F.from_json("json", MINOR_DOC).alias("d"))
    head, lines, disc = F.get("d.Pedidos", F.lit(0)), F.col("d.Movimientos"), F.col("d.Descuento")

    def total(c, f):
        return F.aggregate(c, F.lit(0).cast("bigint"), lambda s, x: s + x[f])

    return doc.select(
        F.col("idOrden").alias("order_id"), head["f430_id_tercero_fact"].alias("party"), head["f430_num_docto_referencia"].alias("reference"),
        F.get(lines, F.lit(0))["f431_id_motivo"].alias("reason"), F.size(lines).alias("lines"), total(lines, "f431_precio_unitario").alias("prices"),
        F.size("d.Impuestos").alias("taxes"), F.size(disc).alias("discounts"), total(disc, "f432_vlr_uni").alias("discount_sum"),
    )


# --- marketplace dialect -----------------------------------------------------


def marketplace_orders(spark, sf, *fields):
    """Parsed marketplace documents: checkout items, warehouse name, external number."""
    key = F.col("o_orderkey")
    kind = F.when(F.col("l_partkey") % 3 == 0, F.lit("Laptop HP")).when(F.col("l_partkey") % 3 == 1, F.lit("apple phone")).otherwise(F.lit("Other"))
    ext = F.col("l_extendedprice").cast("decimal(18,2)")
    item = F.struct(
        text(F.col("l_quantity").cast("int")).alias("count"), text(ext).alias("gross"),
        F.struct(
            text("line_id").alias("_id"), F.concat(F.lit("P-"), text("l_partkey")).alias("code"), F.struct(kind.alias("name")).alias("Product")
        ).alias("ProductVersion"),
        F.when(F.col("l_discount") > 0, F.array(F.struct(text((ext * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(18,2)")).alias("discount"))))
        .otherwise(F.array().cast("array<struct<discount:string>>")).alias("CheckoutItemDiscounts"),
    )
    orders = with_customer(table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"), spark, sf, "inner")
    rows = with_person(with_lines(orders, spark, sf, item, "CheckoutItems", "l_discount", "inner"), spark, sf)
    body = F.struct(
        F.when(key % 2 == 0, F.lit("mercadolibre")).otherwise(F.lit("other")).alias("origin"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("createdAt"),
        F.struct(F.when(F.col("o_orderstatus") == "F", F.lit("FULL")).when(F.col("o_orderstatus") == "P", F.lit("Bodega Bogota")).otherwise(F.lit("unknown")).alias("name")).alias("Warehouse"),
        F.array(F.struct(F.concat(F.lit("2000"), text(key * 7919 + 123456789), text("o_custkey")).alias("externalOrderNumber"))).alias("CheckoutLinks"),
        F.struct(
            F.col("company").alias("taxId"), F.col("name").alias("fullName"), F.col("email"), F.col("phone").alias("phoneNumber"),
            F.array(F.struct(F.col("city"), F.col("province").alias("state"), F.col("country"))).alias("BillingAddresses"),
        ).alias("Client"),
        F.col("CheckoutItems"),
    )
    texts = rows.select(order_name(key, F.col("part")).alias("order_id"), "o_orderkey", "o_custkey", "part", F.to_json(body).alias("document"))
    return parse_documents(texts, "document", only(ORDER_C, *fields) if fields else ORDER_C).where("reject_reason is null")


@query(f"""
WITH lines AS ({LINES_SQL}),
t AS (SELECT '#' || l_orderkey || CASE WHEN part > 1 THEN '-' || part ELSE '' END AS order_id, l_orderkey, l_partkey, cents, q, disc_pct,
             row_number() OVER (PARTITION BY l_orderkey, part ORDER BY CAST(line_id AS VARCHAR)) AS line_no,
             CASE WHEN l_partkey % 7 = 0 THEN 0 WHEN l_partkey % 2 = 0 THEN 19 ELSE 5 END AS rate FROM lines),
u AS (SELECT *, (2 * ((cents * disc_pct * 2 + 100) // 200) + q) // (2 * q) AS unit FROM t)
SELECT order_id, CAST(line_no AS INTEGER) AS line_no, 'P' || CASE l_partkey % 3 WHEN 0 THEN '#' WHEN 1 THEN '/' ELSE '-' END || l_partkey AS reference,
       CASE o_orderstatus WHEN 'F' THEN '04' WHEN 'P' THEN '02' ELSE '01' END AS warehouse, CASE WHEN l_partkey % 4 = 0 THEN 'KIT' ELSE 'UND' END AS unit,
       CAST(q AS INTEGER) AS quantity, ((cents - unit) * 100 * 2 + (100 + rate)) // (2 * (100 + rate)) / 100.0 AS net_price
FROM u JOIN orders ON l_orderkey = o_orderkey
""")
def marketplace_lines(spark, sf):
    rows = od.marketplace_lines(marketplace_orders(spark, sf), *_marketplace_master(spark, sf))
    return rows.withColumn("net_price", F.col("net_price").cast("double"))


def _marketplace_master(spark, sf):
    """Units and tax rates per item reference."""
    k = F.col("p_partkey")
    mark = F.when(k % 3 == 0, F.lit("#")).when(k % 3 == 1, F.lit("/")).otherwise(F.lit("-"))
    part = table(spark, sf, "part", "p_partkey").select(F.concat(F.lit("P"), mark, text(k)).alias("reference"), "p_partkey")
    items = part.where(k % 4 == 0).withColumn("unit", F.lit("KIT "))
    rates = part.where(k % 7 != 0).withColumn("rate", F.when(k % 2 == 0, 19).otherwise(5))
    return items, rates


MARKETPLACE_DOC = (
    "Pedidos array<struct<f430_id_tercero_fact:string,f430_num_docto_referencia:string,f430_notas:string,f419_contacto:string>>, "
    "MovtoPedidosComercial array<struct<f431_nro_registro:int,f431_referencia_item:string,f431_cant_pedida_base:int,f431_precio_unitario:decimal(18,2)>>"
)


@query(f"""
WITH nations AS ({NATIONS_SQL}), people AS ({PEOPLE_SQL}), lines AS ({LINES_SQL}),
t AS (SELECT '#' || l_orderkey || CASE WHEN part > 1 THEN '-' || part ELSE '' END AS order_id, l_orderkey, cents, q, disc_pct,
             CASE WHEN l_partkey % 7 = 0 THEN 0 WHEN l_partkey % 2 = 0 THEN 19 ELSE 5 END AS rate FROM lines),
u AS (SELECT *, ((cents - (2 * ((cents * disc_pct * 2 + 100) // 200) + q) // (2 * q)) * 100 * 2 + (100 + rate)) // (2 * (100 + rate)) AS net FROM t),
g AS (SELECT order_id, l_orderkey, count(*) AS n, SUM(q) AS q, SUM(net) AS net FROM u GROUP BY 1, 2),
e AS (SELECT g.*, o_orderstatus, people.*, '2000' || (o_orderkey * 7919 + 123456789) || o_custkey AS ext, o_orderkey % 2 = 0 AS ml FROM g JOIN orders ON l_orderkey = o_orderkey JOIN people ON o_custkey = c_custkey),
b AS (SELECT *, CASE WHEN ml THEN regexp_extract(ext, '^.[^1-9]*([1-9].*)$', 1) ELSE ext END AS bare FROM e)
SELECT order_id, company AS party, CASE WHEN length(bare) > 15 THEN right(bare, 15) ELSE bare END AS reference,
       'Orden: ' || order_id || '   Pedido de: ' || CASE WHEN ml THEN 'mercadolibre' ELSE 'other' END || '   Venta: ' || ext || '   Bodega: ' ||
       CASE o_orderstatus WHEN 'F' THEN 'FULL' WHEN 'P' THEN 'Bodega Bogota' ELSE 'unknown' END AS notes,
       left(upper(name), 50) AS contact, CAST(n AS INTEGER) AS lines, CAST(q AS BIGINT) AS quantity, net / 100.0 AS prices FROM b
""")
def marketplace_order_docs(spark, sf):
    built = od.build_marketplace_order_docs(marketplace_orders(spark, sf), *_marketplace_master(spark, sf), MarketplaceConfig(), run_ts())
    doc = built.select("idOrden", F.from_json("json", MARKETPLACE_DOC).alias("d"))
    head, lines = F.get("d.Pedidos", F.lit(0)), F.col("d.MovtoPedidosComercial")

    def total(f, kind):
        return F.aggregate(lines, F.lit(0).cast(kind), lambda s, x: (s + x[f]).cast(kind))

    return doc.select(
        F.col("idOrden").alias("order_id"), head["f430_id_tercero_fact"].alias("party"), head["f430_num_docto_referencia"].alias("reference"),
        head["f430_notas"].alias("notes"), head["f419_contacto"].alias("contact"), F.size(lines).alias("lines"),
        total("f431_cant_pedida_base", "bigint").alias("quantity"), total("f431_precio_unitario", "decimal(28,2)").cast("double").alias("prices"),
    )


@query(f"""
WITH {DOCS_SQL}, e AS (SELECT order_name, o_orderkey, '2000' || (o_orderkey * 7919 + 123456789) || o_custkey AS ext FROM docs WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
b AS (SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN regexp_extract(ext, '^.[^1-9]*([1-9].*)$', 1) ELSE ext END AS bare FROM e)
SELECT order_name AS order_id, CASE WHEN length(bare) > 10 THEN right(bare, 10) ELSE bare END AS reference FROM b
""")
def marketplace_reference(spark, sf):
    return marketplace_orders(spark, sf).select("order_id", od.marketplace_reference(F.col("doc"), 10).alias("reference"))


@query("""
WITH erp AS (SELECT '01 ' || o_orderkey AS reference, o_orderkey FROM orders WHERE o_orderstatus <> 'P'),
g AS (SELECT l_orderkey, 'T' || MIN(l_suppkey) AS tracking FROM lineitem GROUP BY 1),
b AS (SELECT o.o_orderkey, tracking, o_orderpriority FROM orders o JOIN erp USING (o_orderkey) LEFT JOIN g ON l_orderkey = o.o_orderkey)
SELECT o_orderkey AS order_id, '147' AS centre, 'EPV' AS doc_type, o_orderkey + 1 AS doc_number, attribute,
       CASE attribute WHEN 'Market_Place' THEN o_orderpriority WHEN 'Transportadora' THEN 'Coordinadora' WHEN 'Nro_Guia' THEN COALESCE(tracking, '')
            ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'pay' || o_orderkey ELSE '' END END AS value
FROM b CROSS JOIN (SELECT unnest(['Market_Place', 'Transportadora', 'Nro_Guia', 'Pasarela']) AS attribute)
""")
def order_attributes(spark, sf):
    """Four attribute rows per order from one join."""
    key = F.col("o_orderkey")
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus")
    queue = orders.select(
        key.alias("order_id"), F.concat(F.lit("01 "), text(key)).alias("reference"), F.col("o_orderpriority").alias("origin"),
        F.when(key % 2 == 0, F.concat(F.lit("pay"), text(key))).alias("gateway"),
    )
    erp = orders.where("o_orderstatus <> 'P'").select(
        F.concat(F.lit("01 "), text(key)).alias("reference"), F.lit("147").alias("centre"), F.lit("EPV").alias("doc_type"), (key + 1).alias("doc_number")
    )
    guides = table(spark, sf, "lineitem", "l_orderkey", "l_suppkey").groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.concat(F.lit("T"), text(F.min("l_suppkey"))).alias("tracking")
    )
    return od.order_attributes(queue, erp, guides, "Coordinadora")


@query("""
SELECT o_orderkey, s.section, s.value FROM orders CROSS JOIN (VALUES ('46', '1'), ('47', '1'), ('47', '5')) AS s(section, value)
WHERE NOT (o_orderkey % 6 = 0 AND s.section = '46')
""")
def explode_literal_rows(spark, sf):
    """Constant tax rows per order, one kind left out for exempt orders."""
    from cartloom.config import TaxRow
    from cartloom.plans.parties import tax_rows

    taxes = (TaxRow("46", "1", "1", True), TaxRow("47", "1"), TaxRow("47", "5"))
    rows = tax_rows(text("o_orderkey"), "001", taxes, F.col("o_orderkey") % 6 == 0)
    return table(spark, sf, "orders", "o_orderkey").select("o_orderkey", F.explode(rows).alias("t")).select(
        "o_orderkey", F.col("t.F_TIPO_REG").alias("section"), F.col("t.F_ID_CLASE").alias("value")
    )
