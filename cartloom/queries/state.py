"""State tables in buckets: three-part-key merge, change detection by digests, rounds of the work queue, sinks."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from cartloom.operators import relational as rl
from cartloom.operators import state as bs
from cartloom.plans import rounds as rd
from cartloom.queries.registry import query, table, text
from cartloom.session import checkpoint_folder
from cartloom.sources.tables import read_queue, write_documents

CUT = "1998-07-01"


def new_folder(spark) -> str:
    return f"{checkpoint_folder(spark)}/state-{uuid.uuid4().hex}"


def _levels(spark, sf, before: bool):
    cut = F.lit(CUT).cast("timestamp_ntz")
    lines = table(
        spark, sf, "lineitem", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity", "l_shipdate",
        where=(F.col("l_shipdate") < cut) if before else (F.col("l_shipdate") >= cut),
    )
    return lines.groupBy(
        F.col("l_partkey").alias("item"), F.col("l_suppkey").alias("warehouse"), F.col("l_returnflag").alias("policy")
    ).agg(F.sum("l_quantity").cast("bigint").alias("available"))


@query(f"""
WITH levels AS (
  SELECT l_partkey AS item, l_suppkey AS warehouse, l_returnflag AS policy, l_shipdate < TIMESTAMP '{CUT}' AS old, CAST(SUM(l_quantity) AS BIGINT) AS available
  FROM lineitem GROUP BY 1, 2, 3, 4),
s AS (SELECT * FROM levels WHERE old), n AS (SELECT * FROM levels WHERE NOT old)
SELECT COALESCE(s.item, n.item) AS item, COALESCE(s.warehouse, n.warehouse) AS warehouse, COALESCE(s.policy, n.policy) AS policy,
       COALESCE(n.available, s.available) AS available, n.item IS NULL OR (s.item IS NOT NULL AND s.available = n.available) AS synced
FROM s FULL JOIN n ON s.item = n.item AND s.warehouse = n.warehouse AND s.policy = n.policy
""")
def merge_bucketed(spark, sf):
    """Quantities by item, warehouse and policy, upserted into a state of which only changed buckets are written."""
    folder = new_folder(spark)
    bs.create_state(_levels(spark, sf, True).withColumn("synced", F.lit(True)), folder, ["item", "warehouse", "policy"])
    bs.merge_bucketed(spark, folder, _levels(spark, sf, False), ["available"], {"synced": F.lit(False)})
    return bs.read_state(spark, folder)


def _prices(spark, sf):
    return table(spark, sf, "orders", "o_orderkey", "o_totalprice", "o_orderstatus").select(
        F.col("o_orderkey").alias("order_id"), F.round("o_totalprice").cast("bigint").alias("value"), F.col("o_orderstatus").alias("status")
    )


@query("""
WITH a AS (SELECT o_orderkey AS order_id, CAST(ROUND(o_totalprice) AS BIGINT) AS value, o_orderstatus AS status FROM orders),
b AS (SELECT CASE WHEN order_id % 977 = 0 THEN -order_id ELSE order_id END AS order_id, value + CASE WHEN order_id % 887 = 0 THEN 1 ELSE 0 END AS value,
             CASE WHEN order_id % 829 <> 0 THEN status END AS status FROM a)
SELECT COALESCE(a.order_id, b.order_id) AS order_id, CASE WHEN a.order_id IS NULL THEN 'insert' WHEN b.order_id IS NULL THEN 'delete' ELSE 'update' END AS action,
       a.value AS old_value, a.status AS old_status, b.value AS new_value, b.status AS new_status
FROM a FULL JOIN b ON a.order_id = b.order_id
WHERE a.order_id IS NULL OR b.order_id IS NULL OR a.value <> b.value OR a.status IS DISTINCT FROM b.status
""")
def changed_by_digest(spark, sf):
    """What differs between a stored state and a full picture of it; buckets with equal digests are not opened."""
    folder = new_folder(spark)
    orders = _prices(spark, sf)
    bs.create_state(orders, folder, ["order_id"])
    k = F.col("order_id")
    told = orders.select(
        F.when(k % 977 == 0, -k).otherwise(k).alias("order_id"), (F.col("value") + F.when(k % 887 == 0, 1).otherwise(0)).alias("value"),
        F.when(k % 829 != 0, F.col("status")).alias("status"),
    )
    return bs.changed_by_digest(spark, folder, told)


@query(f"""
WITH levels AS (
  SELECT l_partkey AS item, l_suppkey AS warehouse, l_returnflag AS policy, l_shipdate < TIMESTAMP '{CUT}' AS old, CAST(SUM(l_quantity) AS BIGINT) AS available
  FROM lineitem GROUP BY 1, 2, 3, 4),
s AS (SELECT * FROM levels WHERE old), n AS (SELECT * FROM levels WHERE NOT old)
SELECT 'stock of three-part keys' AS description, true AS success, count(*) FILTER (WHERE s.item IS NULL) AS new_rows,
       count(*) FILTER (WHERE s.available <> n.available) AS updated_rows, CAST(0 AS BIGINT) AS rejected_rows
FROM n LEFT JOIN s ON s.item = n.item AND s.warehouse = n.warehouse AND s.policy = n.policy
""")
def merge_run_log(spark, sf):
    """The run log of a merge: its counts come from the write itself."""
    folder = new_folder(spark)
    bs.create_state(_levels(spark, sf, True).withColumn("synced", F.lit(True)), folder, ["item", "warehouse", "policy"])
    stats = bs.merge_bucketed(spark, folder, _levels(spark, sf, False), ["available"], {"synced": F.lit(False)})
    rd.log_merge(spark, f"{folder}-log", "stock of three-part keys", datetime(2024, 2, 1, 10), datetime(2024, 2, 1, 11), stats)
    return rd.read_log(spark, f"{folder}-log").select("description", "success", "new_rows", "updated_rows", "rejected_rows")


def queue_rows(spark, sf):
    status, k = F.col("o_orderstatus"), F.col("o_orderkey")
    none = F.lit(None).cast("string")
    return table(spark, sf, "orders", "o_orderkey", "o_orderstatus").select(
        k.alias("id"), F.when(status == "O", 1).when(status == "P", 2).otherwise(3).cast("int").alias("state"), (k % 6).cast("int").alias("attempts"),
        F.concat(F.lit("order "), text(k)).alias("document"), none.alias("out_document"), none.alias("endpoint"), none.alias("reason"),
    )


def returned_docs(spark, sf):
    """Builder of a document of an order's returned lines; an order without any is rejected."""
    lines = table(spark, sf, "lineitem", "l_orderkey", "l_extendedprice", "l_returnflag").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.count_if(F.col("l_returnflag") == "R").alias("lines"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.round(F.col("l_extendedprice") * 100).cast("bigint")).otherwise(0)).alias("cents"),
    )

    def build(due):
        body = F.to_json(F.struct("id", "lines", "cents"))
        return due.select("id").join(lines, "id").select(
            "id", F.when(F.col("lines") > 0, body).alias("json"), F.when(F.col("lines") == 0, F.lit("nothing returned")).alias("reason")
        )

    return build


@query("""
WITH q AS (SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 ELSE 3 END AS state, CAST(o_orderkey % 6 AS INTEGER) AS attempts FROM orders),
l AS (SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'R') AS lines,
             CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(ROUND(l_extendedprice * 100) AS BIGINT) ELSE 0 END) AS BIGINT) AS cents FROM lineitem GROUP BY 1),
r AS (SELECT q.*, state = 1 AND attempts <= 3 AS due, CASE WHEN lines > 0 THEN '{"id":' || id || ',"lines":' || lines || ',"cents":' || cents || '}' END AS json,
             CASE WHEN lines = 0 THEN 'nothing returned' ELSE 'no document' END AS why FROM q LEFT JOIN l ON l_orderkey = id),
n AS (SELECT id, CAST(CASE WHEN due AND json IS NOT NULL THEN state + 1 ELSE state END AS INTEGER) AS state,
             CAST(CASE WHEN due AND json IS NOT NULL THEN 0 WHEN due THEN attempts + 1 ELSE attempts END AS INTEGER) AS attempts,
             CASE WHEN due THEN json END AS detail, CASE WHEN due AND json IS NULL THEN why END AS why, due FROM r)
SELECT 'queue' AS kind, id, state, attempts, CASE WHEN detail IS NOT NULL THEN 'party' END AS endpoint, COALESCE(detail, why) AS detail FROM n
UNION ALL SELECT 'document', id, NULL, NULL, 'party', detail FROM n WHERE detail IS NOT NULL
UNION ALL SELECT 'reject', id, state, attempts, NULL, why FROM n WHERE due AND detail IS NULL
""")
def queue_round(spark, sf):
    """A round of the queue, run twice under one batch name: queue, documents and rejects afterwards."""
    folder = new_folder(spark)
    bs.create_state(queue_rows(spark, sf), folder, ["id"])
    for _ in range(2):
        done = rd.queue_round(spark, folder, "round-1", returned_docs(spark, sf), 1, 3, "party")
    no_int, no_text = F.lit(None).cast("int"), F.lit(None).cast("string")
    queue = bs.read_state(spark, folder).select(
        F.lit("queue").alias("kind"), "id", "state", "attempts", "endpoint", F.coalesce("out_document", "reason").alias("detail")
    )
    documents = done.documents.select(F.lit("document"), "id", no_int, no_int, "endpoint", "json")
    rejects = done.rejects.select(F.lit("reject"), "id", "state", "attempts", no_text, "reason")
    return queue.union(documents).union(rejects)


@query("""
SELECT o_orderkey AS id, o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d') AS created FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 6 <= 3
""")
def queue_scan(spark, sf):
    """The local queue as it lies there, gated by state and attempts."""
    rows = read_queue(spark, f"{sf}/orders.parquet").where((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 6 <= 3))
    return rows.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("created")
    )


@query("""
SELECT l_partkey AS item, l_suppkey AS warehouse, CAST(SUM(l_quantity) AS BIGINT) AS available FROM lineitem
WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey % 2 = 0) GROUP BY 1, 2
""")
def guarded_stock(spark, sf):
    """Stock of the configured warehouses; the job stops before any work where none is configured."""
    configured = table(spark, sf, "supplier", "s_suppkey", "s_nationkey", where=F.col("s_nationkey") % 2 == 0)
    warehouses = rl.require_rows(configured.select(F.col("s_suppkey").alias("warehouse")), "no warehouse is configured")
    lines = table(spark, sf, "lineitem", "l_partkey", "l_suppkey", "l_quantity").select(
        F.col("l_partkey").alias("item"), F.col("l_suppkey").alias("warehouse"), "l_quantity"
    )
    kept = rl.semi_filter(lines, warehouses, "warehouse")
    return kept.groupBy("item", "warehouse").agg(F.sum("l_quantity").cast("bigint").alias("available"))


@query("""
SELECT l_orderkey AS id, count(*) FILTER (WHERE l_returnflag = 'R') AS lines,
       CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(ROUND(l_extendedprice * 100) AS BIGINT) ELSE 0 END) AS BIGINT) AS cents
FROM lineitem GROUP BY 1 HAVING lines > 0
""")
def document_sink(spark, sf):
    """Documents written to files, one line each, and read back from there."""
    ids = table(spark, sf, "orders", "o_orderkey").select(F.col("o_orderkey").alias("id"))
    folder = f"{new_folder(spark)}-documents"
    write_documents(returned_docs(spark, sf)(ids).where("json is not null").select("id", "json"), folder)
    told = spark.read.schema("id long, json string").json(folder)
    return told.select(F.from_json("json", "id long, lines long, cents long").alias("d")).select("d.*")
