"""Queries that write and read shop order documents."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cartloom.config import CLIENT_TYPES
from cartloom.functions.codes import map_code
from cartloom.plans import orders as od
from cartloom.queries.registry import (
    LINES_SQL, NATIONS_SQL, PARTS_SQL, PEOPLE_SQL, order_texts, query, table, text,
)
from cartloom.sources.schemas import ORDER_A, only
from cartloom.session import checkpoint_folder
from cartloom.sources.tables import from_stored, parse_documents, store_documents, stored_value, successful_payments


def parsed_orders(spark, sf, *fields):
    """Readable order documents, one row each, with the named fields or all."""
    schema = only(ORDER_A, *fields) if fields else ORDER_A
    return parse_documents(order_texts(spark, sf), "document", schema).where("reject_reason is null")


def stored_texts(spark, sf):
    """First parts of all order documents, parsed once into a VARIANT column and stored."""
    first = order_texts(spark, sf).where("part = 1").select("order_id", "o_orderkey", "document")
    return store_documents(first, "document", f"{checkpoint_folder(spark)}/documents-{uuid.uuid4().hex}")


def stored_orders(spark, sf, *fields):
    """Readable first parts of the orders from their stored form, with the named fields."""
    return from_stored(stored_texts(spark, sf), only(ORDER_A, *fields)).where("reject_reason is null")


DOCS_SQL = f"lines AS ({LINES_SQL}), docs AS ({PARTS_SQL})"
ITEMS_SQL = """
items AS (
  SELECT order_name, o_orderkey, d.part, CAST(line_id AS VARCHAR) AS line_id, 'P' || l_partkey AS sku, q, price_cents,
         CASE WHEN disc_pct > 0 THEN (cents * disc_pct * 2 + 100) // 200 END AS a1,
         CASE WHEN tax_pct >= 7 THEN (cents * 2 + 100) // 200 END AS a2,
         row_number() OVER (PARTITION BY order_name ORDER BY CAST(line_id AS VARCHAR)) AS line_no
  FROM docs d JOIN lines l ON l_orderkey = o_orderkey AND l.part = d.part),
allocs AS (SELECT *, a1 AS amount FROM items WHERE a1 IS NOT NULL UNION ALL SELECT *, a2 FROM items WHERE a2 IS NOT NULL)
"""


@query(f"""
WITH {DOCS_SQL}, {ITEMS_SQL}
SELECT order_name AS order_id, line_id, sku, CAST(q AS INTEGER) AS quantity, price_cents / 100.0 AS price,
       CAST((a1 IS NOT NULL)::INTEGER + (a2 IS NOT NULL)::INTEGER AS INTEGER) AS discounts FROM items
""")
def explode_items(spark, sf):
    """Line items read back from the document text equal the base lines."""
    return od.explode_items(parsed_orders(spark, sf, "line_items")).select(
        "order_id", "line_id", "sku", F.col("quantity").cast("int").alias("quantity"), F.col("price").cast("double").alias("price"),
        F.size("discount_allocations").alias("discounts"),
    )


@query(f"""
WITH {DOCS_SQL}, {ITEMS_SQL}
SELECT order_name AS order_id, line_id, amount / 100.0 AS amount FROM allocs
""")
def explode_discounts(spark, sf):
    rows = od.explode_discounts(od.explode_items(parsed_orders(spark, sf, "line_items")))
    return rows.select("order_id", "line_id", F.col("amount").cast("double").alias("amount"))


@query(f"""
WITH {DOCS_SQL}
SELECT order_name AS order_id, CASE WHEN o_orderkey % 4 = 1 THEN 'unreadable document' END AS reject_reason,
       CASE WHEN o_orderkey % 4 <> 1 THEN '#' || o_orderkey || CASE WHEN part > 1 THEN '-' || part ELSE '' END END AS name FROM docs
""")
def reject_documents(spark, sf):
    """Every fourth document is cut in half: it is marked, the job goes on."""
    rows = order_texts(spark, sf)
    broken = rows.withColumn(
        "document", F.when(F.col("o_orderkey") % 4 == 1, F.substring("document", 1, 150)).otherwise(F.col("document"))
    )
    out = parse_documents(broken, "document", "name string, id string, order_number string, created_at string")
    return out.select("order_id", "reject_reason", F.when(F.col("reject_reason").isNull(), F.col("doc.name")).alias("name"))


PAID_SQL = """
t AS (SELECT event_id, user_id, event_type, CASE WHEN value > 20 THEN 'success' ELSE 'failure' END AS status FROM events),
f AS (SELECT user_id, CASE event_type WHEN 'click' THEN 'Wompi' WHEN 'view' THEN 'cash' WHEN 'purchase' THEN 'Addi Payment' WHEN 'signup' THEN 'gift_card' ELSE 'card' END AS gateway,
             row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM t WHERE status = 'success')
"""
CLIENT_TYPE_SQL = "COALESCE(CASE gateway WHEN 'Wompi' THEN 'C009' WHEN 'Addi Payment' THEN 'C004' WHEN 'gift_card' THEN 'C006' WHEN 'cash' THEN 'C001' END, 'C001')"


def payment_documents(spark, sf):
    """Payment transactions, one JSON document each."""
    names = {"click": "Wompi", "view": "cash", "purchase": "Addi Payment", "signup": "gift_card"}
    return table(spark, sf, "events", "event_id", "user_id", "event_type", "value").select(
        text("user_id").alias("order_id"), "event_id",
        F.to_json(
            F.struct(
                map_code(F.col("event_type"), names, "card").alias("gateway"),
                F.when(F.col("value") > 20, F.lit("success")).otherwise(F.lit("failure")).alias("status"),
            )
        ).alias("document"),
    )


@query(f"""
WITH {PAID_SQL}
SELECT CAST(c_custkey AS VARCHAR) AS order_id, {CLIENT_TYPE_SQL} AS client_type FROM customer LEFT JOIN f ON user_id = c_custkey AND rn = 1
""")
def client_type(spark, sf):
    """Client type of each order from its first successful transaction."""
    orders = table(spark, sf, "customer", "c_custkey").select(text("c_custkey").alias("order_id"))
    paid = orders.join(successful_payments(payment_documents(spark, sf), ["event_id"]), "order_id", "left")
    return paid.select("order_id", map_code(F.col("gateway"), CLIENT_TYPES, "C001").alias("client_type"))


@query(f"""
WITH nations AS ({NATIONS_SQL}), people AS ({PEOPLE_SQL})
SELECT '#' || o_orderkey AS order_id, CASE o_orderkey % 3 WHEN 1 THEN billing_company ELSE company END AS company, city
FROM orders LEFT JOIN people ON o_custkey = c_custkey
""")
def stored_paths(spark, sf):
    """Values of stored documents by paths that each row chooses: its address section is known only at run time."""
    section = F.when(F.col("o_orderkey") % 3 == 0, F.lit("$.customer.default_address")).when(
        F.col("o_orderkey") % 3 == 1, F.lit("$.billing_address")
    ).otherwise(F.lit("$.shipping_address"))
    value = lambda name: stored_value("stored", F.concat(section, F.lit(f".{name}"))).alias(name)
    return stored_texts(spark, sf).select("order_id", value("company"), value("city"))
