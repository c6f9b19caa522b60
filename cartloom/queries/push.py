"""Delivery queries: eligibility, batches, payloads, run summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartloom.operators import merge as mg
from cartloom.operators import temporal as tp
from cartloom.plans import push as ps
from cartloom.queries.registry import query, run_ts, table

BATCH = 250


@query("""
SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1 AND value > 10
""")
def latest_valid(spark, sf):
    rows = table(spark, sf, "events", "user_id", "event_type", "event_id", "value", "ts")
    return tp.latest_valid(rows, ["user_id", "event_type"], "ts", ["event_id"], F.col("value") > 10).drop("ts")


def _pending(spark, sf):
    lines = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    state = lines.select(
        F.col("l_partkey").alias("inventory_item_id"), F.col("l_suppkey").alias("location_id"), F.col("l_quantity").cast("int").alias("available"),
        "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("warehouse"), (F.col("l_returnflag") == "R").alias("synced"),
    )
    s = F.col("s_suppkey")
    shops = table(spark, sf, "supplier", "s_suppkey").select(
        s.alias("warehouse"), (s % 4 != 0).alias("is_active"), (s % 5 != 0).alias("is_active_shop")
    )
    return ps.pending_stock(state, shops)


def _checks(spark, sf):
    return table(spark, sf, "lineitem", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus").groupBy(
        F.col("l_partkey").alias("inventory_item_id"), F.col("l_suppkey").alias("location_id"), F.col("l_shipdate").alias("checked_at")
    ).agg(F.bool_and(F.col("l_linestatus") == "F").alias("stocked"), F.min(F.when(F.col("l_returnflag") == "A", F.lit("not found"))).alias("error"))


PUSH_SQL = """
pending AS (SELECT l_partkey AS inventory_item_id, l_suppkey AS location_id, CAST(l_quantity AS INTEGER) AS available, l_orderkey, l_linenumber
            FROM lineitem WHERE l_returnflag <> 'R' AND l_suppkey % 4 <> 0 AND l_suppkey % 5 <> 0),
checks AS (SELECT l_partkey AS i, l_suppkey AS l, l_shipdate, bool_and(l_linestatus = 'F') AS stocked, MIN(CASE WHEN l_returnflag = 'A' THEN 'not found' END) AS error
           FROM lineitem GROUP BY 1, 2, 3),
good AS (SELECT i, l FROM (SELECT *, row_number() OVER (PARTITION BY i, l ORDER BY l_shipdate DESC) AS rn FROM checks) WHERE rn = 1 AND stocked AND error IS NULL),
split AS (SELECT p.*, EXISTS (SELECT 1 FROM good WHERE i = inventory_item_id AND l = location_id) AS ok FROM pending p)
"""


@query(f"WITH {PUSH_SQL} SELECT inventory_item_id, location_id, available, l_orderkey, l_linenumber, ok FROM split")
def eligible_split(spark, sf):
    flagged = ps.flag_eligible(_pending(spark, sf), _checks(spark, sf))
    return flagged.select("inventory_item_id", "location_id", "available", "l_orderkey", "l_linenumber", "ok")


BATCH_ORDER = ["l_orderkey", "l_linenumber", "inventory_item_id", "location_id", "available"]


def _batches(spark, sf):
    ok, _ = ps.eligible_split(_pending(spark, sf), _checks(spark, sf))
    return ps.to_batches(ok.select(*BATCH_ORDER), BATCH, BATCH_ORDER)


@query(f"""
WITH {PUSH_SQL}, n AS (SELECT *, row_number() OVER (ORDER BY {', '.join(BATCH_ORDER)}) - 1 AS rn FROM split WHERE ok)
SELECT l_orderkey, l_linenumber, inventory_item_id, location_id, available, rn // {BATCH} AS batch, CAST(rn % {BATCH} AS INTEGER) AS position FROM n
""")
def to_batches(spark, sf):
    return _batches(spark, sf)


@query(f"""
WITH {PUSH_SQL}, n AS (SELECT *, row_number() OVER (ORDER BY {', '.join(BATCH_ORDER)}) - 1 AS rn FROM split WHERE ok)
SELECT rn // {BATCH} AS batch, CAST(count(*) AS INTEGER) AS items, '{{"input":{{"name":"available","reason":"correction","ignoreCompareQuantity":true,"quantities":[' ||
       string_agg('{{"inventoryItemId":"{ps.ITEM_PREFIX}' || inventory_item_id || '","locationId":"{ps.LOCATION_PREFIX}' || location_id || '","quantity":' || available || '}}', ',' ORDER BY rn)
       || ']}}}}' AS payload FROM n GROUP BY 1
""")
def quantity_payload(spark, sf):
    return ps.quantity_payload(_batches(spark, sf))


@query("""
SELECT o_orderkey, (o_orderstatus = 'F' OR d.k IS NOT NULL) AS synced,
       CASE WHEN d.k IS NOT NULL THEN '2024-02-01 10:30' WHEN o_orderstatus = 'F' THEN '2024-01-01 00:00' END AS synced_at
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_quantity > 45) d ON d.k = o_orderkey
""")
def mark_synced(spark, sf):
    done = F.col("o_orderstatus") == "F"
    target = table(spark, sf, "orders", "o_orderkey", "o_orderstatus").select(
        "o_orderkey", done.alias("synced"), F.when(done, F.lit("2024-01-01").cast("timestamp")).alias("synced_at")
    )
    delivered = table(spark, sf, "lineitem", "l_orderkey", "l_quantity", where=F.col("l_quantity") > 45).select(F.col("l_orderkey").alias("o_orderkey"))
    out = mg.mark_synced(target, delivered, "o_orderkey", run_ts())
    return out.withColumn("synced_at", F.date_format("synced_at", "yyyy-MM-dd HH:mm"))


@query("""
SELECT event_type, count(*) AS entries, count(*) FILTER (value > 5) AS succeeded, count(*) FILTER (NOT value > 5) AS failed, bool_or(NOT value > 5) AS any_failure
FROM events GROUP BY 1
""")
def run_summary(spark, sf):
    return ps.run_summary(_log(spark, sf), ["event_type"])


def _log(spark, sf):
    events = table(spark, sf, "events", "event_id", "event_type", "props", "ts", "value")
    line = F.concat("event_type", F.lit(" "), "props")
    return ps.run_log(events, line, F.col("ts"), F.col("ts"), F.col("value") > 5, keep=["event_id", "event_type"])


@query("""
SELECT event_id, event_type || ' ' || regexp_replace(props, '["''.{}\r\n]', ' ', 'g') AS description, value > 5 AS success FROM events
""")
def run_log(spark, sf):
    return _log(spark, sf).select("event_id", "description", "success")
