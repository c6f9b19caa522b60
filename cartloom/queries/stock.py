"""Stock and catalogue queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartloom.operators import merge as mg
from cartloom.operators import relational as rl
from cartloom.plans import stock as st
from cartloom.queries.registry import (
    EXTENSIONS, LEVELS_SQL, SKU_SQL, barcodes, erp_warehouses, extensions, query, stock_levels, table, text,
)

STOCK_COLUMNS = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_linestatus", "l_returnflag"]
CUT = "1998-07-01"


def _levels(spark, sf, where=None):
    cols = STOCK_COLUMNS + (["l_shipdate"] if where is not None else [])
    return stock_levels(table(spark, sf, "lineitem", *cols, where=where))


AVAILABLE_SQL = f"""
levels AS ({LEVELS_SQL.format(where='')}),
ext AS (SELECT p_partkey * {EXTENSIONS} + n AS ext_rowid, p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN 'B' || p_partkey END AS main_barcode
        FROM part, range({EXTENSIONS}) r(n)),
bars AS (SELECT 'X' || p_partkey AS barcode, ext_rowid, p_partkey % 10 AS wh FROM ext WHERE p_partkey % 2 = 0),
available AS (
  SELECT ext_rowid, COALESCE(main_barcode, barcode) AS sku, 'W' || s_suppkey AS warehouse, available
  FROM ext JOIN levels USING (ext_rowid) LEFT JOIN bars USING (ext_rowid)
       JOIN supplier ON s_suppkey = COALESCE(levels.warehouse_rowid, bars.wh)
  WHERE main_barcode IS NOT NULL OR barcode IS NOT NULL)
"""


def _available(spark, sf):
    part = table(spark, sf, "part", "p_partkey")
    return st.available_stock(
        extensions(part), _levels(spark, sf), erp_warehouses(table(spark, sf, "supplier", "s_suppkey")), st.BARCODE,
        barcodes=barcodes(part),
    )


@query(f"WITH {AVAILABLE_SQL} SELECT ext_rowid, sku, warehouse, available FROM available")
def available_stock(spark, sf):
    return _available(spark, sf)


@query(f"""
WITH levels AS ({LEVELS_SQL.format(where='')})
SELECT ext_rowid, 'R' || p_partkey AS sku, 'W' || s_suppkey AS warehouse, available
FROM part JOIN levels ON p_partkey = ext_rowid // {EXTENSIONS} JOIN supplier ON s_suppkey = warehouse_rowid
WHERE p_partkey % 3 <> 0 AND p_partkey % 7 <> 0
""")
def available_stock_by_reference(spark, sf):
    part = table(spark, sf, "part", "p_partkey")
    k = F.col("p_partkey")
    items = part.select(k.alias("item_rowid"), F.when(k % 7 != 0, F.concat(F.lit("R"), text(k))).alias("reference"))
    return st.available_stock(
        extensions(part), _levels(spark, sf), erp_warehouses(table(spark, sf, "supplier", "s_suppkey")), st.REFERENCE, items=items
    )


@query("""
WITH s AS (SELECT l_orderkey, l_suppkey, l_orderkey % 100 AS other, CAST(l_quantity AS BIGINT) AS quantity FROM lineitem)
SELECT DISTINCT l_orderkey, quantity, s_suppkey FROM s JOIN supplier ON s_suppkey = l_suppkey OR s_suppkey = other
""")
def join_either_stock(spark, sf):
    lines = table(spark, sf, "lineitem", "l_orderkey", "l_suppkey", "l_quantity").select(
        "l_orderkey", "l_suppkey", (F.col("l_orderkey") % 100).alias("other"), F.col("l_quantity").cast("bigint").alias("quantity")
    )
    supplier = table(spark, sf, "supplier", "s_suppkey")
    both = rl.join_either(lines, supplier, ["l_suppkey", "other"], "s_suppkey")
    return both.select("l_orderkey", "quantity", "s_suppkey").distinct()


CATALOGUE_SQL = f"""
catalogue AS (
  SELECT DISTINCT p_partkey + 1000000 AS inventory_item_id, {SKU_SQL} AS sku, l_suppkey + 500 AS location_id
  FROM lineitem JOIN part ON l_partkey = p_partkey
  UNION SELECT p_partkey + 1000000, {SKU_SQL}, p_partkey % 10 + 500 FROM part),
shops AS (SELECT s_suppkey + 500 AS location_id, CASE WHEN s_nationkey <> 7 THEN 'W' || s_suppkey END AS warehouse
          FROM supplier),
crossed AS (
  SELECT DISTINCT inventory_item_id, c.sku, location_id, COALESCE(shops.warehouse, 'W0') AS warehouse, COALESCE(s.available, 0) AS available
  FROM catalogue c JOIN shops USING (location_id)
       LEFT JOIN (SELECT sku, warehouse, CAST(SUM(available) AS INTEGER) AS available FROM available GROUP BY 1, 2) s
       ON s.sku = c.sku AND s.warehouse = COALESCE(shops.warehouse, 'W0')
  WHERE c.sku IS NOT NULL)
"""


def _catalogue(spark, sf):
    k = F.col("p_partkey")
    sku = F.when(k % 3 != 0, F.concat(F.lit("B"), text(k))).when(k % 2 == 0, F.concat(F.lit("X"), text(k)))
    part = table(spark, sf, "part", "p_partkey")
    sold = table(spark, sf, "lineitem", "l_partkey", "l_suppkey")
    pairs = sold.select("l_partkey", "l_suppkey").distinct().join(part, F.col("l_partkey") == k)
    listed = pairs.select((k + 1000000).alias("inventory_item_id"), sku.alias("sku"), (F.col("l_suppkey") + 500).alias("location_id"))
    extra = part.select((k + 1000000).alias("inventory_item_id"), sku.alias("sku"), (k % 10 + 500).alias("location_id"))
    return listed.union(extra).distinct().where("sku is not null")


def _shops(spark, sf):
    s = F.col("s_suppkey")
    return table(spark, sf, "supplier", "s_suppkey", "s_nationkey").select(
        (s + 500).alias("location_id"), F.when(F.col("s_nationkey") != 7, F.concat(F.lit("W"), text(s))).alias("warehouse")
    )


@query(f"""
WITH {AVAILABLE_SQL}, {CATALOGUE_SQL}
SELECT inventory_item_id, sku, location_id, warehouse, available FROM crossed
""")
def catalogue_stock(spark, sf):
    return st.catalogue_stock(_catalogue(spark, sf), _shops(spark, sf), _available(spark, sf), "W0")


@query(f"""
WITH {AVAILABLE_SQL}, {CATALOGUE_SQL}
SELECT DISTINCT inventory_item_id, c.sku, location_id, COALESCE(shops.warehouse, 'W0') AS warehouse, COALESCE(s.available, 0) AS available
FROM catalogue c JOIN shops USING (location_id)
     LEFT JOIN (SELECT sku, CAST(SUM(available) AS INTEGER) AS available FROM available GROUP BY sku, warehouse) s ON s.sku = c.sku
WHERE c.sku IS NOT NULL
""")
def catalogue_stock_by_sku(spark, sf):
    """The SKU alone decides: an entry meets the stock of every warehouse of its SKU."""
    return st.catalogue_stock(_catalogue(spark, sf), _shops(spark, sf), _available(spark, sf), "W0", match_warehouse=False)


FLAGSHIP_SQL = f"""
WITH {AVAILABLE_SQL}, {CATALOGUE_SQL},
source AS (SELECT sku, warehouse, location_id, inventory_item_id, available FROM (
  SELECT *, row_number() OVER (PARTITION BY sku, warehouse ORDER BY inventory_item_id, location_id, available) AS rn FROM crossed)
  WHERE rn = 1),
state AS (SELECT sku, COALESCE(shops.warehouse, 'W0') AS warehouse, MIN(CASE WHEN location_id % 2 = 0 THEN 0 ELSE 7 END) AS available
          FROM catalogue JOIN shops USING (location_id) WHERE starts_with(sku, 'B') GROUP BY 1, 2)
SELECT sku, warehouse, source.location_id, source.inventory_item_id, source.available,
       (state.sku IS NOT NULL AND state.available = source.available) AS synced,
       CASE WHEN state.sku IS NULL THEN 'insert' WHEN state.available <> source.available THEN 'update' ELSE 'keep' END AS action,
       '{{"location_id":' || source.location_id || ',"inventory_item_id":' || source.inventory_item_id || ',"available":' || source.available || '}}' AS payload
FROM source LEFT JOIN state USING (sku, warehouse)
"""


@query(FLAGSHIP_SQL)
def stock_sync(spark, sf):
    """Available stock, crossed with the catalogue, merged into the state it changes."""
    crossed = mg.one_per_key(
        st.catalogue_stock(_catalogue(spark, sf), _shops(spark, sf), _available(spark, sf), "W0")
        .select("sku", "warehouse", "inventory_item_id", "location_id", "available"),
        ["sku", "warehouse"],
    )
    sent = (
        _catalogue(spark, sf).where(F.col("sku").startswith("B")).join(_shops(spark, sf), "location_id")
        .groupBy("sku", F.coalesce("warehouse", F.lit("W0")).alias("warehouse"))
        .agg(F.min(F.when(F.col("location_id") % 2 == 0, 0).otherwise(7)).alias("available"))
    )
    state = sent.select(
        "sku", "warehouse", F.lit(0).cast("bigint").alias("location_id"), F.lit(0).cast("bigint").alias("inventory_item_id"),
        "available", F.lit(True).alias("synced"), F.lit("2024-01-01").cast("timestamp").alias("synced_at"),
    )
    return st.sync_stock(state, crossed).select(
        "sku", "warehouse", "location_id", "inventory_item_id", "available", "synced", "action", "payload"
    )


def _merge_sides(spark, sf):
    """State from lines before the cut, source from the lines after it."""
    before = _levels(spark, sf, F.col("l_shipdate") < F.lit(CUT).cast("timestamp_ntz"))
    after = _levels(spark, sf, F.col("l_shipdate") >= F.lit(CUT).cast("timestamp_ntz"))

    def shape(df):
        return df.select(F.col("ext_rowid").alias("item"), F.col("warehouse_rowid").alias("warehouse"), st.available_quantity().alias("available"))

    state = shape(before).withColumn("synced", F.lit(True)).withColumn("synced_at", F.lit("2024-01-01").cast("timestamp"))
    return state, shape(after)


MERGE_SQL = f"""
b AS (SELECT ext_rowid AS item, warehouse_rowid AS warehouse, available FROM ({LEVELS_SQL.format(where=f"WHERE l_shipdate < TIMESTAMP '{CUT}'")})),
a AS (SELECT ext_rowid AS item, warehouse_rowid AS warehouse, available FROM ({LEVELS_SQL.format(where=f"WHERE l_shipdate >= TIMESTAMP '{CUT}'")})),
merged AS (
  SELECT COALESCE(a.item, b.item) AS item, COALESCE(a.warehouse, b.warehouse) AS warehouse,
         COALESCE(a.available, b.available) AS available,
         CASE WHEN b.item IS NULL THEN 'insert' WHEN a.item IS NOT NULL AND a.available <> b.available THEN 'update' ELSE 'keep' END AS action
  FROM a FULL JOIN b ON a.item = b.item AND a.warehouse = b.warehouse)
"""


def _merged(spark, sf):
    state, source = _merge_sides(spark, sf)
    return mg.merge_changed(
        state, source, ["item", "warehouse"], ["available"],
        {"synced": F.lit(False), "synced_at": F.lit(None).cast("timestamp")},
    )


@query(f"""
WITH {MERGE_SQL}
SELECT item, warehouse, available, action, action = 'keep' AS synced,
       CASE WHEN action = 'keep' THEN '2024-01-01' END AS synced_at FROM merged
""")
def merge_changed_stock(spark, sf):
    return _merged(spark, sf).select(
        "item", "warehouse", "available", "action", "synced", F.date_format("synced_at", "yyyy-MM-dd").alias("synced_at")
    )


@query(f"""
WITH {MERGE_SQL}
SELECT count(*) AS total_rows, count(*) FILTER (action = 'insert') AS new_rows, count(*) FILTER (action = 'update') AS updated_rows FROM merged
""")
def merge_stats(spark, sf):
    return mg.merge_stats(_merged(spark, sf))


@query(f"""
WITH {MERGE_SQL}
SELECT COALESCE(a.item, b.item) AS item, COALESCE(a.warehouse, b.warehouse) AS warehouse,
       COALESCE(a.available, b.available) AS available,
       CASE WHEN a.item IS NOT NULL THEN CASE WHEN a.item % 2 = 0 THEN 'new' END ELSE 'old' END AS code,
       CASE WHEN a.item IS NOT NULL THEN 'b' ELSE 'a' END AS note,
       CASE WHEN b.item IS NULL THEN false WHEN a.item IS NULL THEN true
            ELSE a.available IS NOT DISTINCT FROM b.available AND (CASE WHEN a.item % 2 = 0 THEN 'new' END) IS NOT DISTINCT FROM 'old' END AS synced
FROM a FULL JOIN b ON a.item = b.item AND a.warehouse = b.warehouse
""")
def merge_keep_flags(spark, sf):
    """Every match follows the source; the sync flag falls only where a compared column differs."""
    state, source = _merge_sides(spark, sf)
    state = state.drop("synced_at").withColumn("code", F.lit("old")).withColumn("note", F.lit("a"))
    source = source.withColumn("code", F.when(F.col("item") % 2 == 0, F.lit("new"))).withColumn("note", F.lit("b"))
    merged = mg.merge_changed(
        state, source, ["item", "warehouse"], ["available", "code"], {"synced": F.lit(False)}, always=["note"]
    )
    return merged.select("item", "warehouse", "available", "code", "note", "synced")


@query("""
WITH ids AS (SELECT CASE WHEN s_suppkey % 3 = 0 THEN '1_1' WHEN s_suppkey % 3 = 1 THEN '1_3' END AS grp, s_suppkey FROM supplier),
g AS (SELECT l_partkey AS variant_id, grp, CAST(SUM(l_quantity) AS BIGINT) AS available
      FROM lineitem JOIN ids ON l_suppkey = s_suppkey WHERE grp IS NOT NULL GROUP BY 1, 2)
SELECT variant_id, grp AS warehouse_group, available FROM g
""")
def stock_by_group(spark, sf):
    s = F.col("s_suppkey")
    groups = table(spark, sf, "supplier", "s_suppkey").where(s % 3 != 2).select(
        s.alias("warehouse"), F.when(s % 3 == 0, F.lit("1_1")).otherwise(F.lit("1_3")).alias("warehouse_group")
    )
    lines = table(spark, sf, "lineitem", "l_partkey", "l_suppkey", "l_quantity").select(
        F.col("l_partkey").alias("variant_id"), F.col("l_suppkey").alias("warehouse"), F.col("l_quantity").alias("available")
    )
    return st.stock_by_group(lines, groups, ["variant_id"])


@query("""
WITH g AS (SELECT l_partkey, CASE WHEN l_suppkey % 3 = 0 THEN '1_1' ELSE '1_3' END AS grp, CAST(SUM(l_quantity) AS BIGINT) AS available
           FROM lineitem WHERE l_suppkey % 3 <> 2 GROUP BY 1, 2),
w AS (SELECT unnest(['1_1', '1_3', '1_9']) AS grp)
SELECT p_partkey AS variant_id, w.grp AS warehouse_group, COALESCE(g.available, 0) AS available
FROM part CROSS JOIN w LEFT JOIN g ON p_partkey = l_partkey AND w.grp = g.grp
""")
def densify_grid(spark, sf):
    variants = table(spark, sf, "part", "p_partkey").select(F.col("p_partkey").alias("variant_id"))
    return st.grouped_grid(variants, stock_by_group(spark, sf), ["variant_id"], ["1_1", "1_3", "1_9"])


@query("""
WITH ordered AS (SELECT DISTINCT l_partkey AS sku FROM lineitem WHERE l_returnflag = 'A' AND l_shipdate < TIMESTAMP '1995-06-01'),
opened AS (SELECT DISTINCT l_partkey AS sku FROM lineitem WHERE l_returnflag = 'N' AND l_shipdate < TIMESTAMP '1995-06-01'),
never AS (SELECT p_partkey AS sku FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-06-01'))
SELECT sku FROM (SELECT sku FROM ordered EXCEPT SELECT sku FROM opened) UNION ALL SELECT sku FROM never
""")
def except_union(spark, sf):
    return _candidates(spark, sf)


def _candidates(spark, sf):
    early = table(spark, sf, "lineitem", "l_partkey", "l_returnflag", "l_shipdate", where=F.col("l_shipdate") < F.lit("1995-06-01").cast("timestamp_ntz"))
    closed = early.where("l_returnflag = 'A'").select(F.col("l_partkey").alias("sku")).distinct()
    still_open = early.where("l_returnflag = 'N'").select(F.col("l_partkey").alias("sku")).distinct()
    products = table(spark, sf, "part", "p_partkey").select(F.col("p_partkey").alias("sku"))
    never = products.join(early.select(F.col("l_partkey").alias("sku")).distinct(), "sku", "left_anti")
    return rl.only_in_first(closed, still_open, never)


SHOP_SQL = """
products AS (SELECT p_partkey AS sku, p_partkey + 1000000 AS inventory_item_id, p_partkey + 1 AS product_id FROM part WHERE p_type <> 'LARGE'),
erp AS (SELECT l_partkey AS ean, CAST(SUM(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY 1),
shop AS (SELECT p_partkey + 1000000 AS inventory_item_id, p_partkey % 7 AS location_id,
                CAST(SUM(CASE WHEN l_returnflag <> 'R' OR p_partkey % 2 = 0 THEN l_quantity ELSE 0 END) AS BIGINT) AS available,
                MAX(l_shipdate) AS audit, MIN(l_shipdate) AS updated_at
         FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY 1, 2),
stores AS (SELECT s_suppkey AS location_id, s_name AS description, s_suppkey % 3 AS id_store FROM supplier WHERE s_suppkey < 6)
"""


def _shop_tables(spark, sf):
    k = F.col("p_partkey")
    part = table(spark, sf, "part", "p_partkey", "p_type")
    products = part.where("p_type <> 'LARGE'").select(
        k.alias("sku"), (k + 1000000).alias("inventory_item_id"), (k + 1).alias("product_id")
    )
    lines = table(spark, sf, "lineitem", "l_partkey", "l_quantity", "l_returnflag", "l_shipdate")
    q = F.col("l_quantity")
    sums = lines.groupBy("l_partkey").agg(
        F.sum(q).cast("bigint").alias("quantity"),
        F.sum(F.when((F.col("l_returnflag") != "R") | (F.col("l_partkey") % 2 == 0), q).otherwise(0)).cast("bigint").alias("available"),
        F.max("l_shipdate").alias("audit"), F.min("l_shipdate").alias("updated_at"),
    )
    erp = sums.select(F.col("l_partkey").alias("ean"), "quantity")
    shop = sums.join(part, F.col("l_partkey") == k).select(
        (k + 1000000).alias("inventory_item_id"), (k % 7).alias("location_id"), "available", "audit", "updated_at"
    )
    stores = table(spark, sf, "supplier", "s_suppkey", "s_name", where=F.col("s_suppkey") < 6).select(
        F.col("s_suppkey").alias("location_id"), F.col("s_name").alias("description"), (F.col("s_suppkey") % 3).alias("id_store")
    )
    return products, shop, erp, stores


@query(f"""
WITH {SHOP_SQL},
ordered AS (SELECT DISTINCT l_partkey AS sku FROM lineitem WHERE l_returnflag = 'A' AND l_shipdate < TIMESTAMP '1995-06-01'),
opened AS (SELECT DISTINCT l_partkey AS sku FROM lineitem WHERE l_returnflag = 'N' AND l_shipdate < TIMESTAMP '1995-06-01'),
never AS (SELECT p_partkey AS sku FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-06-01')),
candidates AS (SELECT sku FROM (SELECT sku FROM ordered EXCEPT SELECT sku FROM opened) UNION ALL SELECT sku FROM never)
SELECT p.sku, p.inventory_item_id, i.location_id, i.available, e.quantity
FROM products p JOIN shop i USING (inventory_item_id) JOIN erp e ON p.sku = e.ean JOIN stores s ON s.location_id = i.location_id
WHERE p.sku IN (SELECT sku FROM candidates) AND e.quantity <> i.available AND s.id_store = 1
""")
def changed_stock(spark, sf):
    products, shop, erp, stores = _shop_tables(spark, sf)
    return st.changed_stock(products, shop, erp, stores, _candidates(spark, sf), 1)


@query(f"""
WITH {SHOP_SQL}
SELECT s.description AS store, p.product_id, COALESCE(p.sku, e.ean) AS sku, COALESCE(e.quantity, 0) AS erp_quantity,
       COALESCE(i.available, 0) AS shop_quantity, ABS(COALESCE(e.quantity, 0) - COALESCE(i.available, 0)) AS difference,
       strftime(CASE WHEN i.audit >= TIMESTAMP '2001-06-01' THEN i.audit ELSE i.updated_at END, '%Y-%m-%d') AS changed_at
FROM erp e FULL JOIN products p ON e.ean = p.sku LEFT JOIN shop i ON p.inventory_item_id = i.inventory_item_id
     LEFT JOIN stores s ON i.location_id = s.location_id
""")
def stock_diff_report(spark, sf):
    products, shop, erp, stores = _shop_tables(spark, sf)
    return st.stock_diff_report(products, shop, erp, stores, F.lit("2001-06-01").cast("timestamp_ntz")).withColumn(
        "changed_at", F.date_format("changed_at", "yyyy-MM-dd")
    )


@query("""
WITH o AS (SELECT o_orderkey, CAST(ROUND(o_totalprice) AS BIGINT) AS v FROM orders WHERE o_orderstatus <> 'P'),
l AS (SELECT l_orderkey, CAST(SUM(CAST(ROUND(l_extendedprice) AS BIGINT)) AS BIGINT) AS v FROM lineitem GROUP BY 1)
SELECT COALESCE(o_orderkey, l_orderkey) AS order_id, COALESCE(o.v, 0) AS left_value, COALESCE(l.v, 0) AS right_value,
       ABS(COALESCE(o.v, 0) - COALESCE(l.v, 0)) AS difference
FROM o FULL JOIN l ON o_orderkey = l_orderkey
""")
def reconcile_full(spark, sf):
    o = table(spark, sf, "orders", "o_orderkey", "o_totalprice", "o_orderstatus", where=F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("order_id"), F.round("o_totalprice").cast("bigint").alias("v")
    )
    lines = table(spark, sf, "lineitem", "l_orderkey", "l_extendedprice").groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.sum(F.round("l_extendedprice").cast("bigint")).alias("v")
    )
    return rl.reconcile(o, lines, ["order_id"], "v")
