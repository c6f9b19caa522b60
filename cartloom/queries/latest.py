"""Latest, first, in-force, duplicate and numbering queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartloom.operators import temporal as tp
from cartloom.plans import prices as pr
from cartloom.queries.registry import (
    LINE_ORDER, PAIR_SQL, PRICE_COLUMNS, PRICES_SQL, pair_id, price_history, query, table, text,
)

AS_OF = "1998-06-30"


@query(f"""
WITH p AS ({PRICES_SQL}), m AS (SELECT item_rowid, list_id, MAX(activation) AS activation FROM p GROUP BY 1, 2)
SELECT item_rowid, list_id, strftime(activation, '%Y%m%d') AS activation, cents / 100.0 AS price FROM p JOIN m USING (item_rowid, list_id, activation)
""")
def latest_by_max(spark, sf):
    prices = price_history(table(spark, sf, "lineitem", *PRICE_COLUMNS))
    return tp.latest_by_max(prices, ["item_rowid", "list_id"], "activation").select(
        "item_rowid", "list_id", F.date_format("activation", "yyyyMMdd").alias("activation"), F.col("price").cast("double").alias("price")
    )


@query(f"""
WITH p AS (SELECT * FROM ({PRICES_SQL}) WHERE list_id = 'A' AND activation <= TIMESTAMP '{AS_OF}')
SELECT item_rowid, strftime(activation, '%Y%m%d') AS activation, cents / 100.0 AS price FROM p t
WHERE activation = (SELECT MAX(activation) FROM p WHERE p.item_rowid = t.item_rowid) AND cents > 100000
""")
def price_as_of(spark, sf):
    prices = price_history(table(spark, sf, "lineitem", *PRICE_COLUMNS, where=F.col("l_returnflag") == "A"))
    rows = tp.price_as_of(prices, ["item_rowid"], "activation", F.lit(AS_OF).cast("timestamp_ntz"), "price", 1000)
    return rows.select(
        "item_rowid", F.date_format("activation", "yyyyMMdd").alias("activation"), F.col("price").cast("double").alias("price")
    )


LATEST_SQL = f"""
latest AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY CASE WHEN ext_rowid IS NULL THEN 'item' ELSE 'ext' END, COALESCE(ext_rowid, item_rowid)
                               ORDER BY activation DESC, cents DESC, item_rowid DESC) AS rn
  FROM ({PRICES_SQL}) WHERE list_id = 'A') WHERE rn = 1)
"""


def _latest(spark, sf):
    prices = price_history(table(spark, sf, "lineitem", *PRICE_COLUMNS, where=F.col("l_returnflag") == "A"))
    return tp.latest_price(prices, "ext_rowid", "item_rowid", "activation", ["price", "item_rowid"])


@query(f"""
WITH {LATEST_SQL}
SELECT CASE WHEN ext_rowid IS NULL THEN 'item' ELSE 'ext' END AS key_kind, CAST(COALESCE(ext_rowid, item_rowid) AS VARCHAR) AS key_id,
       strftime(activation, '%Y%m%d') AS activation, cents / 100.0 AS price FROM latest
""")
def latest_price(spark, sf):
    return _latest(spark, sf).select(
        "key_kind", text("key_id").alias("key_id"), F.date_format("activation", "yyyyMMdd").alias("activation"), F.col("price").cast("double").alias("price")
    )


VARIANTS_SQL = f"""
variants AS (SELECT p_partkey + 7000000 AS variant_id, 'R' || p_partkey AS sku FROM part WHERE p_type <> 'SMALL'),
items AS (SELECT p_partkey AS item_rowid, CASE WHEN p_partkey % 7 <> 0 THEN 'R' || p_partkey END AS reference FROM part),
exts AS (SELECT DISTINCT {PAIR_SQL.format('l_suppkey', 'l_partkey')} AS ext_rowid, 'R' || l_partkey AS main_barcode, l_partkey AS item_rowid FROM lineitem),
classes AS (SELECT p_partkey AS item_rowid FROM part WHERE p_type = 'PROMO' AND p_size < 25)
"""


def _variants(spark, sf):
    k = F.col("p_partkey")
    part = table(spark, sf, "part", "p_partkey", "p_type", "p_size")
    variants = part.where("p_type <> 'SMALL'").select((k + 7000000).alias("variant_id"), F.concat(F.lit("R"), text(k)).alias("sku"))
    items = part.select(k.alias("item_rowid"), F.when(k % 7 != 0, F.concat(F.lit("R"), text(k))).alias("reference"))
    pairs = table(spark, sf, "lineitem", "l_partkey", "l_suppkey").distinct()
    ext = pairs.select(
        pair_id(F.col("l_suppkey"), F.col("l_partkey")).alias("ext_rowid"),
        F.concat(F.lit("R"), text("l_partkey")).alias("main_barcode"), F.col("l_partkey").alias("item_rowid"),
    )
    classes = part.where("p_size < 25").select(
        k.alias("item_rowid"), F.col("p_type").alias("plan_id"), F.lit("1").alias("major_id")
    )
    return variants, items, ext, classes


@query(f"""
WITH {LATEST_SQL}, {VARIANTS_SQL}
SELECT DISTINCT variant_id, sku, cents / 100.0 AS price FROM latest p JOIN exts e ON p.ext_rowid = e.ext_rowid
JOIN variants ON sku = main_barcode WHERE e.item_rowid IN (SELECT item_rowid FROM classes)
""")
def effective_price_by_extension(spark, sf):
    variants, _, ext, classes = _variants(spark, sf)
    out = pr.effective_price(_latest(spark, sf), variants, pr.EXTENSION, ext=ext, classes=classes, plan="PROMO", criterion="1")
    return out.withColumn("price", F.col("price").cast("double"))


UNION_SQL = f"""
WITH {LATEST_SQL}, {VARIANTS_SQL}
SELECT DISTINCT variant_id, sku, cents / 100.0 AS price FROM latest p JOIN exts e ON p.ext_rowid = e.ext_rowid JOIN variants ON sku = main_barcode
UNION
SELECT DISTINCT variant_id, sku, cents / 100.0 AS price FROM latest p JOIN items i ON p.item_rowid = i.item_rowid JOIN variants ON sku = reference
WHERE cents > 100
"""


@query(UNION_SQL)
def union_modes(spark, sf):
    variants, items, ext, _ = _variants(spark, sf)
    latest = _latest(spark, sf)
    by_ext = pr.effective_price(latest, variants, pr.EXTENSION, ext=ext)
    by_item = pr.effective_price(latest, variants, pr.ITEM, items=items, floor=1)
    return by_ext.union(by_item).distinct().withColumn("price", F.col("price").cast("double"))


@query(f"""
WITH {LATEST_SQL}, {VARIANTS_SQL},
s AS (SELECT variant_id, sku, MIN(cents) AS cents FROM latest p JOIN items i ON p.item_rowid = i.item_rowid JOIN variants ON sku = reference GROUP BY 1, 2),
t AS (SELECT p_partkey + 7000000 AS variant_id, 'R' || p_partkey AS sku, CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE CAST(ROUND(p_retailprice * 100) AS BIGINT) END AS cents
      FROM part WHERE p_size <= 25)
SELECT COALESCE(s.variant_id, t.variant_id) AS variant_id, COALESCE(s.sku, t.sku) AS sku, COALESCE(s.cents, t.cents) / 100.0 AS price,
       CASE WHEN t.variant_id IS NULL THEN 'insert' WHEN s.cents <> t.cents THEN 'update' ELSE 'keep' END AS action
FROM s FULL JOIN t ON s.variant_id = t.variant_id
""")
def price_sync(spark, sf):
    """Newest prices merged into the price state."""
    variants, items, _, _ = _variants(spark, sf)
    fresh = pr.effective_price(_latest(spark, sf), variants, pr.ITEM, items=items)
    k = F.col("p_partkey")
    price = F.when(k % 3 == 0, F.lit(0)).otherwise(F.col("p_retailprice")).cast("decimal(18,2)")
    state = table(spark, sf, "part", "p_partkey", "p_retailprice", "p_size", where=F.col("p_size") <= 25).select(
        (k + 7000000).alias("variant_id"), F.concat(F.lit("R"), text(k)).alias("sku"), price.alias("price"),
        F.lit(True).alias("synced"), F.lit("2024-01-01").cast("timestamp").alias("synced_at"),
    )
    merged = pr.sync_prices(state, fresh.select("variant_id", "price", "sku"))
    return merged.select("variant_id", "sku", F.col("price").cast("double").alias("price"), "action")


@query("""
SELECT p_partkey, '{"variant":{"id":' || p_partkey || ',"compare_at_price":' || CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) || '}}' AS compare_at,
       '{"variant":{"id":"' || p_partkey || '","price":"' || CAST(ROUND(CAST(p_retailprice AS DECIMAL(18,2))) AS BIGINT) || '"}}' AS plain,
       '{"markup":0,"basePrice":' || r || ',"listPrice":' || r || ',"fixedPrices":[{"tradePolicyId":"1","value":' || r || ',"listPrice":' || r || ',"minQuantity":1}]}' AS fixed
FROM (SELECT *, CAST(ROUND(CAST(p_retailprice AS DECIMAL(18,2))) AS BIGINT) AS r FROM part)
""")
def price_payloads(spark, sf):
    p, k = F.col("p_retailprice").cast("decimal(18,2)"), F.col("p_partkey")
    return table(spark, sf, "part", "p_partkey", "p_retailprice").select(
        "p_partkey", *[pr.price_payload(kind, k, p).alias(name) for kind, name in (("compare_at", "compare_at"), ("price", "plain"), ("fixed", "fixed"))]
    )


@query("SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def find_duplicates(spark, sf):
    return tp.find_duplicates(table(spark, sf, "lineitem", "l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT event_id AS id, user_id || '/' || n || CASE WHEN event_id <> first THEN '-1' ELSE '' END AS order_id,
       CASE WHEN event_id <> first THEN 3 ELSE 1 END AS state
FROM (SELECT event_id, user_id, CAST(floor(value) AS BIGINT) AS n, MIN(event_id) OVER (PARTITION BY user_id, CAST(floor(value) AS BIGINT)) AS first FROM events)
""")
def tag_duplicates(spark, sf):
    rows = table(spark, sf, "events", "event_id", "user_id", "value").select(
        F.col("event_id").alias("id"), F.concat(text("user_id"), F.lit("/"), text(F.floor("value"))).alias("order_id"), F.lit(1).alias("state")
    )
    return tp.tag_duplicates(rows, "order_id", "id").select("id", "order_id", "state")


@query("""
SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) WHERE rn = 1
""")
def dedupe_first(spark, sf):
    return tp.dedupe_keep_first(
        table(spark, sf, "events", "user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], ["event_id"]
    )


@query("""
SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
""")
def dedupe_latest(spark, sf):
    rows = table(spark, sf, "events", "user_id", "event_type", "event_id", "value", "ts")
    return tp.dedupe_latest(rows, ["user_id", "event_type"], "ts", ["event_id"]).drop("ts")


@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) AS line_no FROM lineitem
""")
def number_lines(spark, sf):
    lines = table(spark, sf, "lineitem", "l_orderkey", *LINE_ORDER)
    return tp.number_lines(lines, ["l_orderkey"], LINE_ORDER).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "line_no")


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type, value FROM events
WHERE event_type = 'purchase' AND ts > TIMESTAMP '2024-01-05' AND events.ts < TIMESTAMP '2024-01-12' ORDER BY event_id DESC LIMIT 100
""")
def top_transactions(spark, sf):
    from cartloom.plans.reports import device_transactions

    log = table(spark, sf, "events", "event_id", "ts", "event_type", "value", "props").select(
        F.col("event_id").alias("id"), "ts", F.col("event_type").alias("method"), "value", F.lit(1).alias("company_id"), F.col("props").alias("request")
    )
    day = [F.lit(d).cast("timestamp_ntz") for d in ("2024-01-05", "2024-01-12")]
    top = device_transactions(log, 1, "purchase", *day, n=100)
    return top.select(F.col("id").alias("event_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), F.col("method").alias("event_type"), "value")


@query("""
SELECT event_id, user_id, value FROM events
WHERE event_type = 'error' AND ts > TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' AND contains(props, '"k": 4')
""")
def device_search(spark, sf):
    from cartloom.plans.reports import device_transactions

    log = table(spark, sf, "events", "event_id", "user_id", "ts", "event_type", "value", "props").select(
        F.col("event_id").alias("id"), "user_id", "ts", F.col("event_type").alias("method"), "value", F.lit(1).alias("company_id"),
        F.col("props").alias("request"),
    )
    day = [F.lit(d).cast("timestamp_ntz") for d in ("2024-01-10", "2024-01-20")]
    rows = device_transactions(log, 1, "error", *day, device='"k": 4')
    return rows.select(F.col("id").alias("event_id"), "user_id", "value")
