"""Report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartloom.operators.relational import nest_tree
from cartloom.plans import reports as rp
from cartloom.queries.registry import query, table, text


@query("""
WITH m AS (SELECT *, CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS cents, CAST(ROUND(l_discount * 100) AS BIGINT) AS pct,
                  CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS sign FROM lineitem),
v AS (SELECT *, CASE WHEN o_orderkey % 5 = 0 THEN 4000 ELSE 1 END AS factor, (cents * pct * 2 + 100) // 200 AS disc FROM m JOIN orders ON l_orderkey = o_orderkey)
SELECT o_orderkey AS doc_id, l_linenumber AS line_id, l_partkey, l_suppkey, 'FE-' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS document, c_name AS party_name, s_name AS warehouse,
       p_name AS description, sign * l_quantity AS quantity, sign * (cents - disc) * factor / 100.0 AS subtotal, sign * cents * factor / 100.0 AS gross
FROM v JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
""")
def sales_lines(spark, sf):
    ext = F.col("l_extendedprice").cast("decimal(18,2)")
    disc = (ext * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(18,2)")
    lines = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag")
    movements = lines.select(
        F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("line_id"), "l_partkey", "l_suppkey", F.col("l_partkey").alias("item_rowid"),
        F.col("l_suppkey").alias("warehouse_rowid"), F.col("l_quantity").alias("quantity"), F.when(F.col("l_returnflag") == "R", 1).otherwise(2).alias("nature"),
        ext.alias("gross"), disc.alias("line_discount"), (ext * 4000).alias("gross_alt"), (disc * 4000).alias("line_discount_alt"),
        F.lit(0).alias("tax"), F.lit(0).alias("net"),
    )
    k = F.col("o_orderkey")
    documents = table(spark, sf, "orders", "o_orderkey", "o_custkey").select(
        k.alias("doc_id"), F.col("o_custkey").alias("party_rowid"), F.lit("FE ").alias("doc_type"), k.alias("doc_number"),
        F.when(k % 5 == 0, F.lit("USD")).otherwise(F.lit("COP")).alias("currency"), F.lit("COP").alias("local_currency"),
    )
    items = table(spark, sf, "part", "p_partkey", "p_name").select(F.col("p_partkey").alias("item_rowid"), F.concat("p_name", F.lit("\n ")).alias("description"))
    parties = table(spark, sf, "customer", "c_custkey", "c_name").select(F.col("c_custkey").alias("party_rowid"), F.col("c_name").alias("party_name"))
    warehouses = table(spark, sf, "supplier", "s_suppkey", "s_name").select(F.col("s_suppkey").alias("warehouse_rowid"), F.col("s_name").alias("warehouse"))
    out = rp.sales_lines(movements, documents, items, parties, warehouses)
    keys = [F.col("item_rowid").alias("l_partkey"), F.col("warehouse_rowid").alias("l_suppkey")]
    return out.select("doc_id", "line_id", *keys, "document", "party_name", "warehouse", "description", *[F.col(c).cast("double").alias(c) for c in ("quantity", "subtotal", "gross")])


@query("""
SELECT o_orderkey AS doc_id, 'FE' || (o_orderkey % 3) AS doc_type, 'x' || (o_custkey % 50) AS reference, CASE WHEN o_orderkey % 4 = 0 THEN '<doc>' || o_orderkey || '</doc>' END AS xml
FROM orders WHERE o_orderkey % 3 IN (0, 1) AND o_custkey % 50 = 7
""")
def invoice_lookup(spark, sf):
    k = F.col("o_orderkey")
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey")
    documents = orders.select(k.alias("doc_id"), F.concat(F.lit("FE"), text(k % 3)).alias("doc_type"))
    references = orders.select(k.alias("doc_id"), F.concat(F.lit("x"), text(F.col("o_custkey") % 50)).alias("reference"))
    stored = orders.where(k % 4 == 0).select(k.alias("doc_id"), F.concat(F.lit("<doc>"), text(k), F.lit("</doc>")).alias("xml"))
    return rp.invoice_lookup(documents, references, stored, "x7", ["FE0", "FE1"])


@query("""
WITH c AS (SELECT o_custkey, o_orderpriority, o_orderstatus FROM orders GROUP BY 1, 2, 3)
SELECT CAST(c_custkey AS VARCHAR) AS party_id, c_name AS contact, n_name AS country, c_mktsegment AS terms, CAST(count(o_custkey) AS INTEGER) AS classes,
       COALESCE(string_agg(o_orderpriority || '/' || o_orderstatus, ',' ORDER BY o_orderpriority, o_orderstatus), '') AS class_list
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN c ON o_custkey = c_custkey WHERE c_mktsegment <> 'BUILDING' GROUP BY 1, 2, 3, 4
""")
def customer_master(spark, sf):
    """Customers of one company with their classifications as a list."""
    k = F.col("c_custkey")
    cust = table(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    company = F.when(F.col("c_mktsegment") == "BUILDING", 2).otherwise(1).alias("company_id")
    parties = cust.select(k.alias("party_rowid"), text(k).alias("party_id"), company, k.alias("contact_rowid"))
    nation = table(spark, sf, "nation", "n_nationkey", "n_name")
    contacts = cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        k.alias("contact_rowid"), company, F.col("c_name").alias("contact"), F.col("n_name").alias("country")
    )
    clients = cust.select(k.alias("party_rowid"), F.lit("001").alias("branch_id"), F.col("c_mktsegment").alias("terms_id"))
    terms = cust.select(F.col("c_mktsegment").alias("terms_id"), company, F.col("c_mktsegment").alias("terms")).distinct()
    classes = table(spark, sf, "orders", "o_custkey", "o_orderpriority", "o_orderstatus").distinct().select(
        F.col("o_custkey").alias("party_rowid"), F.lit("001").alias("branch_id"), F.col("o_orderpriority").alias("plan_id"),
        F.col("o_orderpriority").alias("plan_name"), F.col("o_orderstatus").alias("major_id"), F.col("o_orderstatus").alias("major_name"),
    )
    rows = rp.customer_master(parties, contacts, clients, terms, classes, "-1", 1)
    listed = F.coalesce(F.array_join(F.transform("classifications", lambda c: F.concat(c["plan_id"], F.lit("/"), c["major_id"])), ","), F.lit(""))
    return rows.select(
        "party_id", "contact", "country", "terms", F.coalesce(F.size("classifications"), F.lit(0)).alias("classes"), listed.alias("class_list")
    )


def _levels(spark, sf):
    """Regions, nations, suppliers and parts as a five-level catalogue."""
    region, nation = table(spark, sf, "region"), table(spark, sf, "nation")
    groups = region.select(F.col("r_name").alias("group_name"), F.col("r_regionkey").alias("group_id"))
    relations = nation.select(F.col("n_regionkey").alias("group_id"), F.col("n_nationkey").alias("entity_id"))
    entities = nation.select(F.col("n_nationkey").alias("entity_id"), F.col("n_name").alias("entity_name"))
    s = table(spark, sf, "supplier", "s_suppkey", "s_name", "s_nationkey")
    attributes = s.select(
        F.col("s_nationkey").alias("entity_id"), F.col("s_suppkey").alias("attribute_id"), F.when(F.col("s_suppkey") % 3 != 0, F.col("s_suppkey") % 20).alias("master_id")
    )
    masters = s.where("s_suppkey < 20").select(F.col("s_suppkey").alias("master_id"), F.col("s_name").alias("master_name"))
    details = table(spark, sf, "part", "p_partkey", "p_type").select((F.col("p_partkey") % 20).alias("master_id"), F.col("p_type").alias("detail_name")).distinct()
    return groups, relations, entities, attributes, masters, details


CATALOGUE_SQL = """
cat AS (SELECT r_name AS group_name, n_nationkey AS entity_id, n_name AS entity_name, a.s_suppkey AS attribute_id, m.s_name AS master_name, d.p_type AS detail_name
FROM region JOIN nation ON n_regionkey = r_regionkey JOIN supplier a ON a.s_nationkey = n_nationkey
LEFT JOIN supplier m ON m.s_suppkey < 20 AND a.s_suppkey % 3 <> 0 AND m.s_suppkey = a.s_suppkey % 20
LEFT JOIN (SELECT DISTINCT p_partkey % 20 AS k, p_type FROM part) d ON d.k = a.s_suppkey % 20 AND a.s_suppkey % 3 <> 0)
"""


@query(f"WITH {CATALOGUE_SQL} SELECT * FROM cat")
def entity_catalogue(spark, sf):
    return rp.entity_catalogue(*_levels(spark, sf)).select("group_name", "entity_id", "entity_name", "attribute_id", "master_name", "detail_name")


@query(f"""
WITH {CATALOGUE_SQL}
SELECT group_name, CAST((row_number() OVER (PARTITION BY group_name ORDER BY entity_id NULLS FIRST, entity_name NULLS FIRST, attribute_id NULLS FIRST,
       master_name NULLS FIRST, detail_name NULLS FIRST) - 1) // 40 + 1 AS INTEGER) AS part, entity_id, entity_name, attribute_id, master_name, detail_name FROM cat
""")
def entity_tree(spark, sf):
    """The catalogue as trees of at most 40 leaves per group (entity, attribute, master, detail), read back leaf by leaf."""
    flat = entity_catalogue(spark, sf)
    tree = nest_tree(
        flat, [("entities", ["entity_id", "entity_name"]), ("attributes", ["attribute_id"]), ("masters", ["master_name"]), ("details", ["detail_name"])],
        ["group_name"], 40,
    )
    kept = ["group_name", "part"]
    for name, ids in (("entities", ["entity_id", "entity_name"]), ("attributes", ["attribute_id"]), ("masters", ["master_name"])):
        tree = tree.select(*kept, F.inline(name))
        kept += ids
    return tree.select(*kept, F.inline("details"))
