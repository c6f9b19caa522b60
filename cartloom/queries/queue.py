"""Work queue queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartloom.functions.text import iso_instant
from cartloom.operators import merge as mg
from cartloom.plans import queue as qu
from cartloom.queries.registry import query, table, text

QUEUE_SQL = """
q AS (SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 ELSE 3 END AS state, CAST(o_orderkey % 6 AS INTEGER) AS attempts FROM orders)
"""


def _queue(spark, sf):
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders", "o_orderkey", "o_orderstatus").select(
        F.col("o_orderkey").alias("id"), F.when(status == "O", 1).when(status == "P", 2).otherwise(3).alias("state"),
        (F.col("o_orderkey") % 6).cast("int").alias("attempts"),
    )


@query(f"WITH {QUEUE_SQL} SELECT * FROM q WHERE state = 1 AND attempts <= 3 ORDER BY id LIMIT 25")
def pending_queue(spark, sf):
    return qu.pending(_queue(spark, sf), 1, 3, 25)


@query(f"""
WITH {QUEUE_SQL}
SELECT id, CAST(CASE WHEN id % 5 IN (0, 1) THEN state + 1 ELSE state END AS INTEGER) AS state,
       CAST(CASE WHEN id % 5 IN (0, 1) THEN 0 WHEN id % 5 = 2 THEN 99 ELSE attempts + 1 END AS INTEGER) AS attempts FROM q
""")
def queue_step(spark, sf):
    k = F.col("id") % 5
    outcome = F.when(k == 0, F.lit("ok")).when(k == 1, F.lit("no_id")).when(k == 2, F.lit("parked")).otherwise(F.lit("failed"))
    return qu.step(_queue(spark, sf), outcome, pass_without_id=True)


@query(f"""
WITH {QUEUE_SQL}, e AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linestatus = 'F')
SELECT id, CAST(CASE WHEN l_orderkey IS NOT NULL AND state = 3 AND attempts <= 3 THEN 4 ELSE state END AS INTEGER) AS state,
       CAST(CASE WHEN l_orderkey IS NOT NULL AND state = 3 AND attempts <= 3 THEN 0 ELSE attempts END AS INTEGER) AS attempts
FROM q LEFT JOIN e ON l_orderkey = id
""")
def reconcile_created(spark, sf):
    erp = table(spark, sf, "lineitem", "l_orderkey", "l_linestatus", where=F.col("l_linestatus") == "F")
    return qu.reconcile_created(_queue(spark, sf), erp, "id", "l_orderkey", 3, 3)


@query(f"""
WITH {QUEUE_SQL}, d AS (SELECT l_orderkey, 'doc ' || count(*) AS json FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT id, CASE WHEN json IS NOT NULL THEN 2 ELSE state END AS state, CASE WHEN json IS NOT NULL THEN 0 ELSE attempts END AS attempts,
       CASE WHEN json IS NOT NULL THEN json WHEN id % 3 = 0 THEN 'old' END AS out_document,
       CASE WHEN json IS NOT NULL THEN 'party' END AS endpoint FROM q LEFT JOIN d ON l_orderkey = id
""")
def attach_document(spark, sf):
    queue = _queue(spark, sf).withColumn("out_document", F.when(F.col("id") % 3 == 0, F.lit("old"))).withColumn("endpoint", F.lit(None).cast("string"))
    docs = table(spark, sf, "lineitem", "l_orderkey", "l_returnflag", where=F.col("l_returnflag") == "R").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.concat(F.lit("doc "), text(F.count(F.lit(1)))).alias("json")
    )
    return qu.attach_document(queue, docs, "id", "party", 2)


@query("""
WITH a AS (SELECT user_id AS item, event_type AS place, CAST(floor(value) AS INTEGER) - 5 AS available, ts FROM events),
t AS (SELECT item, place, MAX(available) AS available, MIN(ts) AS ts FROM a WHERE ts < TIMESTAMP '2024-01-03' AND available >= 0 GROUP BY 1, 2),
b AS (SELECT * FROM a WHERE ts >= TIMESTAMP '2024-01-03'),
n AS (SELECT item, place, available, ts FROM (SELECT *, row_number() OVER (PARTITION BY item, place ORDER BY ts DESC, available DESC) AS rn FROM b WHERE available >= 0) WHERE rn = 1)
SELECT 'state' AS kind, COALESCE(n.item, t.item) AS item, COALESCE(n.place, t.place) AS place, COALESCE(n.available, t.available) AS available, strftime(COALESCE(n.ts, t.ts), '%Y-%m-%d %H:%M:%S') AS ts
FROM t FULL JOIN n ON t.item = n.item AND t.place = n.place
UNION ALL SELECT 'reject', item, place, available, strftime(ts, '%Y-%m-%d %H:%M:%S') FROM b WHERE available < 0
""")
def upsert_snapshot_rejects(spark, sf):
    rows = table(spark, sf, "events", "user_id", "event_type", "value", "ts").select(
        F.col("user_id").alias("item"), F.col("event_type").alias("place"), (F.floor("value").cast("int") - 5).alias("available"), "ts"
    )
    cut = F.lit("2024-01-03").cast("timestamp_ntz")
    target = rows.where((F.col("ts") < cut) & (F.col("available") >= 0)).groupBy("item", "place").agg(
        F.max("available").alias("available"), F.min("ts").alias("ts")
    )
    state, rejects = mg.upsert_snapshot(target, rows.where(F.col("ts") >= cut), ["item", "place"], "available", "ts")
    cols = ["item", "place", "available", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts")]
    return state.select(F.lit("state").alias("kind"), *cols).union(rejects.select(F.lit("reject").alias("kind"), *cols))


@query("""
SELECT p_partkey, CAST(COALESCE(q, p_size) AS INTEGER) AS quantity FROM part
LEFT JOIN (SELECT l_partkey, CAST(MAX(l_quantity) AS INTEGER) AS q FROM lineitem WHERE l_returnflag = 'N' AND l_shipdate > TIMESTAMP '2001-01-01' GROUP BY 1) ON l_partkey = p_partkey
""")
def copy_quantity(spark, sf):
    snapshot = table(
        spark, sf, "lineitem", "l_partkey", "l_quantity", "l_returnflag", "l_shipdate",
        where=(F.col("l_returnflag") == "N") & (F.col("l_shipdate") > F.lit("2001-01-01").cast("timestamp_ntz")),
    ).groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max("l_quantity").cast("int").alias("available"))
    products = table(spark, sf, "part", "p_partkey", "p_size").withColumnRenamed("p_size", "quantity")
    return mg.copy_quantity(products, snapshot, "p_partkey", "available", "quantity")


@query("""
WITH l AS (SELECT doc_id, lower(rtrim(text)) AS t FROM documents),
h AS (SELECT doc_id, contains(t, 'the ') AS a, contains(t, 'email') AS b, contains(t, 'license') AS c, contains(t, 'error') AS e FROM l)
SELECT doc_id, 'english' AS category FROM h WHERE a UNION ALL SELECT doc_id, 'mail' FROM h WHERE b UNION ALL SELECT doc_id, 'license' FROM h WHERE c
UNION ALL SELECT doc_id, 'other' FROM h WHERE e AND NOT a AND NOT b AND NOT c
""")
def triage_logs(spark, sf):
    rules = {"english": "the ", "mail": "email", "license": "license"}
    return qu.triage_errors(table(spark, sf, "documents", "doc_id", "text"), "text", rules).select("doc_id", "category")


@query("""
SELECT o_orderkey AS id, strftime(o_orderdate, '%Y%m%d') AS created FROM orders
WHERE (o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' AND o_orderpriority IN ('1-URGENT', '2-HIGH')) OR o_orderdate >= TIMESTAMP '1998-01-01'
""")
def due_window(spark, sf):
    rows = table(spark, sf, "orders", "o_orderkey", "o_orderdate", "o_orderpriority")
    start, switch = (F.lit(d).cast("timestamp_ntz") for d in ("1996-01-01", "1998-01-01"))
    due = qu.due_window(rows, "o_orderdate", start, switch, F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return due.select(F.col("o_orderkey").alias("id"), F.date_format("o_orderdate", "yyyyMMdd").alias("created"))


@query(f"""
WITH {QUEUE_SQL}
SELECT id, CASE WHEN state = 2 AND attempts = 0 AND o_orderdate < TIMESTAMP '1997-06-01' AND id % 7 <> 0 THEN 5 ELSE state END AS state
FROM q JOIN orders ON id = o_orderkey
""")
def expire_old(spark, sf):
    """Creation texts carry an offset; unreadable ones leave their order in the queue."""
    key = F.col("o_orderkey")
    rows = table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderdate").select(
        key.alias("id"), F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "P", 2).otherwise(3).alias("state"),
        (key % 6).cast("int").alias("attempts"),
        F.when(key % 7 != 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'-00:00'")).otherwise(F.lit("soon")).alias("created"),
    )
    out = qu.expire_old(rows, iso_instant(F.col("created")), F.lit("1997-06-01").cast("timestamp"), 2, 5)
    return out.select("id", "state")
