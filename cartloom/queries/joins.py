"""Join, lookup, reshape and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartloom.functions import text as tx
from cartloom.operators import merge as mg
from cartloom.operators import relational as rl
from cartloom.plans import places as pl
from cartloom.plans.prices import filter_by_class
from cartloom.config import LocationDefaults
from cartloom.queries.registry import (
    NATIONS_SQL, PEOPLE_SQL, PLACES_SQL, named_nations, people, places, query, table, text,
)
from cartloom.sources.tables import literal_rows

ACCENT_SQL = f"translate(lower({{0}}), '{tx.ACCENTED}', '{tx.PLAIN}')"


def fold_sql(c: str) -> str:
    return ACCENT_SQL.format(c)


@query("""
SELECT p_partkey, p_name, p_brand FROM part
WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 40 AND l_returnflag = 'R' AND l_shipdate < TIMESTAMP '1998-01-01')
""")
def append_new_products(spark, sf):
    sent = table(
        spark, sf, "lineitem", "l_partkey",
        where=(F.col("l_quantity") > 40) & (F.col("l_returnflag") == "R") & (F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")),
    ).select(F.col("l_partkey").alias("p_partkey"))
    return mg.append_new(sent, table(spark, sf, "part", "p_partkey", "p_name", "p_brand"), ["p_partkey"])


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'")
def optional_filter(spark, sf):
    rows = table(spark, sf, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    rows = rl.optional_eq(rl.optional_eq(rows, "c_mktsegment", "BUILDING"), "c_nationkey", -1)
    return rows.drop("c_nationkey")


@query("""
SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%' OR p_name LIKE 'red%' OR p_name LIKE '%bolt%'
""")
def like_any_parts(spark, sf):
    rows = table(spark, sf, "part", "p_partkey", "p_name")
    return rows.where(tx.like_any(F.col("p_name"), ["ring", "bolt"]) | F.col("p_name").startswith("red"))


@query("""
SELECT o_orderkey, o_orderpriority FROM orders
WHERE regexp_matches(CAST(o_orderkey AS VARCHAR), '^[789]') AND o_orderpriority IN ('1-URGENT', '5-LOW')
""")
def class_like_ids(spark, sf):
    rows = table(spark, sf, "orders", "o_orderkey", "o_orderpriority", where=F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
    return rows.where(text("o_orderkey").rlike("^[789]"))


@query("""
SELECT l_suppkey, count(*) AS n, CAST(SUM(l_quantity) AS BIGINT) AS quantity FROM lineitem
WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000) GROUP BY 1
""")
def semi_filter_warehouses(spark, sf):
    """The list of configured warehouses stays a table: a semi join, applied after the sums."""
    keys = table(spark, sf, "supplier", "s_suppkey", "s_acctbal", where=F.col("s_acctbal") > 5000).select(
        F.col("s_suppkey").alias("l_suppkey")
    )
    sums = table(spark, sf, "lineitem", "l_suppkey", "l_quantity").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity")
    )
    return rl.semi_filter(sums, keys, "l_suppkey")


@query("""
WITH created AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS reference, 'D' || (l_orderkey + 1) AS doc_reference
                 FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F')
SELECT o_orderkey, o_orderstatus FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM created WHERE reference = CAST(o_orderkey AS VARCHAR))
  AND NOT EXISTS (SELECT 1 FROM created WHERE doc_reference = 'D' || o_orderkey) AND o_orderstatus = 'O'
  AND NOT (o_orderkey % 2 = 0 AND EXISTS (SELECT 1 FROM created WHERE doc_reference = CAST(o_orderkey AS VARCHAR)))
""")
def not_yet_created(spark, sf):
    created = table(
        spark, sf, "lineitem", "l_orderkey", "l_returnflag", "l_linestatus",
        where=(F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"),
    ).select(text("l_orderkey").alias("reference"), text(F.col("l_orderkey") + 1).alias("doc_reference"))
    queue = table(spark, sf, "orders", "o_orderkey", "o_orderstatus", where=F.col("o_orderstatus") == "O")
    key = F.concat(F.lit('" '), text("o_orderkey"), F.lit('"'))
    return rl.not_yet_created(queue, created, key, ["reference", "doc_reference"])


@query("""
SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
""")
def not_in_anti(spark, sf):
    busy = table(
        spark, sf, "orders", "o_custkey", "o_orderstatus", "o_orderpriority",
        where=(F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"),
    )
    return table(spark, sf, "customer", "c_custkey", "c_name").join(
        busy.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti"
    )


@query("""
SELECT c_custkey, c_nationkey FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 450000)
""")
def not_exists_anti(spark, sf):
    big = table(spark, sf, "orders", "o_custkey", "o_totalprice", where=F.col("o_totalprice") > 450000)
    return table(spark, sf, "customer", "c_custkey", "c_nationkey").join(
        big.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti"
    )


@query("""
SELECT l_partkey AS item_rowid, count(*) AS n FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO' AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3')) GROUP BY 1
""")
def class_filter(spark, sf):
    part = table(spark, sf, "part", "p_partkey", "p_type", "p_brand", where=F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3"))
    classes = part.select(F.col("p_partkey").alias("item_rowid"), F.col("p_type").alias("plan_id"), F.lit("1").alias("major_id"))
    sums = table(spark, sf, "lineitem", "l_partkey").groupBy(F.col("l_partkey").alias("item_rowid")).agg(F.count(F.lit(1)).alias("n"))
    return filter_by_class(sums, classes, "PROMO", "1")


@query("""
WITH needles AS (SELECT 'ref ' || n_nationkey AS needle, n_name FROM nation),
texts AS (SELECT o_orderkey, 'Pedido ' || o_orderkey || ' ref ' || (o_custkey % 60) || ' prioridad ' || o_orderpriority AS notes FROM orders)
SELECT o_orderkey, needle, n_name FROM texts JOIN needles ON contains(notes, needle)
""")
def contains_join(spark, sf):
    needles = table(spark, sf, "nation", "n_nationkey", "n_name").select(
        F.concat(F.lit("ref "), text("n_nationkey")).alias("needle"), "n_name"
    )
    texts = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderpriority").select(
        "o_orderkey",
        F.concat(
            F.lit("Pedido "), text("o_orderkey"), F.lit(" ref "), text(F.col("o_custkey") % 60), F.lit(" prioridad "), "o_orderpriority"
        ).alias("notes"),
    )
    return rl.contains_join(texts, needles, "notes", "o_orderkey", "needle")


@query("""
SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer LEFT JOIN (
  SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
  FROM orders WHERE o_orderstatus = 'P') ON o_custkey = c_custkey AND rn = 1
""")
def lookup_first(spark, sf):
    dim = table(spark, sf, "orders", "o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus", where=F.col("o_orderstatus") == "P").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice"
    )
    return rl.lookup_first(
        table(spark, sf, "customer", "c_custkey", "c_name"), dim, ["c_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    )


@query("""
SELECT user_id, MAX(CASE WHEN event_type = 'click' THEN value END) AS click, MAX(CASE WHEN event_type = 'view' THEN value END) AS view_value,
       MAX(CASE WHEN event_type = 'purchase' THEN value END) AS purchase
FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY 1
""")
def pivot_first(spark, sf):
    return rl.pivot_first(
        table(spark, sf, "events", "user_id", "event_type", "value"), ["user_id"], "event_type", "value",
        {"click": "click", "view": "view_value", "purchase": "purchase"},
    )


@query("""
WITH a AS (SELECT l_partkey, MAX(CASE WHEN k = 'RF' THEN v END) AS des, MAX(CASE WHEN k = 'AO' THEN v END) AS dec_text, MAX(CASE WHEN k = 'NF' THEN v END) AS key_text
           FROM (SELECT l_partkey, l_returnflag || l_linestatus AS k, CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber AS v FROM lineitem WHERE l_quantity > 40) GROUP BY 1)
SELECT p_partkey, p_name, des, dec_text, key_text FROM part JOIN a ON p_partkey = l_partkey
WHERE des IS NOT NULL AND dec_text IS NOT NULL AND key_text IS NOT NULL
""")
def eav_wide(spark, sf):
    lines = table(
        spark, sf, "lineitem", "l_partkey", "l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber", "l_quantity", where=F.col("l_quantity") > 40
    )
    attributes = lines.select(
        F.col("l_partkey").alias("p_partkey"), F.concat("l_returnflag", "l_linestatus").alias("k"),
        F.concat(text("l_orderkey"), F.lit("-"), text("l_linenumber")).alias("v"),
    )
    return rl.eav_wide(
        table(spark, sf, "part", "p_partkey", "p_name"), attributes, ["p_partkey"], "k", "v",
        {"RF": "des", "AO": "dec_text", "NF": "key_text"},
    )


@query("""
SELECT '01 ' || lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(8, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0') AS reference, o_orderstatus, count(*) AS n
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2
""")
def computed_key_join(spark, sf):
    """Join on a built reference: the key becomes a column once, on both sides."""
    def ref(c):
        return F.concat(F.lit("01 "), tx.pad_left(F.col(c), 8))

    lines = table(spark, sf, "lineitem", "l_orderkey").select(ref("l_orderkey").alias("reference")).groupBy("reference").agg(
        F.count(F.lit(1)).alias("n")
    )
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderstatus").select(ref("o_orderkey").alias("reference"), "o_orderstatus")
    return orders.join(lines, "reference").select("reference", "o_orderstatus", "n")


@query("""
WITH a AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN upper(c_name) || '  ' ELSE c_name END AS n FROM customer),
b AS (SELECT c_custkey AS other_key, lower(c_name) AS n FROM customer)
SELECT a.c_custkey, b.other_key FROM a JOIN b ON lower(rtrim(a.n)) = lower(rtrim(b.n))
""")
def ci_join(spark, sf):
    k = F.col("c_custkey")
    cust = table(spark, sf, "customer", "c_custkey", "c_name")
    a = cust.select("c_custkey", tx.ci(F.when(k % 2 == 0, F.concat(F.upper("c_name"), F.lit("  "))).otherwise(F.col("c_name"))).alias("n"))
    b = cust.select(k.alias("other_key"), tx.ci(F.lower("c_name")).alias("n"))
    return a.join(b, "n").drop("n")


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_nationkey < 5) AND l_linenumber = 1
""")
def exists_semi(spark, sf):
    near = table(spark, sf, "supplier", "s_suppkey", "s_nationkey", where=F.col("s_nationkey") < 5).select(F.col("s_suppkey").alias("l_suppkey"))
    lines = table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", where=F.col("l_linenumber") == 1)
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderstatus")
    return rl.semi_filter(lines, near, "l_suppkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


@query("""
WITH numbered AS (SELECT s_nationkey, s_name, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_name) AS rn FROM supplier)
SELECT n_nationkey, CAST((rn - 1) // 10 + 1 AS INTEGER) AS part, string_agg(s_name, ',' ORDER BY s_name) AS s_name_list
FROM nation JOIN numbered ON s_nationkey = n_nationkey GROUP BY 1, 2
""")
def string_agg_list(spark, sf):
    """Supplier names of each nation as text, in parts of at most 10."""
    supplier = table(spark, sf, "supplier", "s_name", "s_nationkey").withColumnRenamed("s_nationkey", "n_nationkey")
    rows = rl.semi_filter(supplier, table(spark, sf, "nation", "n_nationkey"), "n_nationkey")
    return rl.text_list(rows, ["n_nationkey"], "s_name", ",", 10)


@query("""
WITH numbered AS (SELECT c_nationkey, c_custkey, c_acctbal, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn FROM customer)
SELECT n_name, CAST((rn - 1) // 25 + 1 AS INTEGER) AS part, CAST(count(c_custkey) AS INTEGER) AS children,
       MIN(c_custkey) AS first_id, MAX(c_custkey) AS last_id,
       string_agg(c_custkey || ':' || CAST(round(c_acctbal * 100) AS BIGINT), ',' ORDER BY c_custkey) AS content
FROM nation JOIN numbered ON n_nationkey = c_nationkey GROUP BY 1, 2
""")
def nest_children(spark, sf):
    """Customers as lists on their nation, in parts of at most 25."""
    nation = table(spark, sf, "nation", "n_nationkey", "n_name")
    cust = table(spark, sf, "customer", "c_nationkey", "c_custkey", "c_acctbal").withColumnRenamed("c_nationkey", "n_nationkey")
    nested = rl.nest(nation, cust, ["n_nationkey"], ["c_custkey"], ["c_custkey", "c_acctbal"], "children", 25)
    ids = F.transform("children", lambda c: c["c_custkey"])
    return nested.select(
        "n_name", "part", F.size("children").alias("children"), F.array_min(ids).alias("first_id"), F.array_max(ids).alias("last_id"),
        F.array_join(
            F.transform("children", lambda c: F.concat(text(c["c_custkey"]), F.lit(":"), text(F.round(c["c_acctbal"] * 100).cast("bigint")))), ","
        ).alias("content"),
    )


@query("""
WITH flat AS (SELECT n_regionkey, n_nationkey, c_mktsegment, c_custkey, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey, c_mktsegment, c_custkey) AS rn
              FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT r_name, CAST((rn - 1) // 100 + 1 AS INTEGER) AS part, n_nationkey, c_mktsegment, c_custkey FROM flat JOIN region ON n_regionkey = r_regionkey
""")
def nest_tree(spark, sf):
    """Region, nation, segment and customer as trees of at most 100 leaves, read back leaf by leaf."""
    nation, region = table(spark, sf, "nation", "n_nationkey", "n_regionkey"), table(spark, sf, "region")
    cust = table(spark, sf, "customer", "c_nationkey", "c_mktsegment", "c_custkey")
    flat = cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    tree = rl.nest_tree(
        flat.select("r_name", "n_nationkey", "c_mktsegment", "c_custkey"),
        [("nations", ["n_nationkey"]), ("segments", ["c_mktsegment"]), ("customers", ["c_custkey"])], ["r_name"], 100,
    )
    nations = tree.select("r_name", "part", F.inline("nations"))
    return nations.select("r_name", "part", "n_nationkey", F.inline("segments")).select(
        "r_name", "part", "n_nationkey", "c_mktsegment", F.inline("customers")
    )



@query(f"""
WITH nations AS ({NATIONS_SQL}), places AS ({PLACES_SQL}),
p AS (SELECT {fold_sql('city_name')} AS city, {fold_sql('state_name')} AS state, country_id, state_id, city_id FROM places),
people AS ({PEOPLE_SQL}),
asked AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'nowhere' ELSE {fold_sql('city')} END AS city,
                 CASE WHEN c_custkey % 7 = 0 THEN {fold_sql('city')} ELSE {fold_sql('province')} END AS state FROM people),
n AS (SELECT city, count(*) AS n, MIN(country_id || state_id || city_id) AS hit FROM p GROUP BY 1)
SELECT c_custkey, asked.city, asked.state, substr(hit, 1, 3) AS country_id, substr(hit, 4, 2) AS state_id, substr(hit, 6, 3) AS city_id FROM (
  SELECT asked.*, CASE WHEN COALESCE(n.n, 0) >= 2 THEN (SELECT MIN(country_id || state_id || city_id) FROM p WHERE p.city = asked.city AND p.state = asked.state)
                       WHEN n.n = 1 THEN n.hit ELSE (SELECT hit FROM n AS m WHERE m.city = asked.state) END AS hit
  FROM asked LEFT JOIN n ON n.city = asked.city) asked
""")
def lookup_by_ambiguity(spark, sf):
    lost = F.col("c_custkey") % 7 == 0
    who = people(spark, sf).select(
        "c_custkey", F.when(lost, F.lit("nowhere")).otherwise(tx.fold(F.col("city"))).alias("city"),
        F.when(lost, tx.fold(F.col("city"))).otherwise(tx.fold(F.col("province"))).alias("state"),
    )
    known = places(spark, sf).select(
        tx.fold(F.col("city_name")).alias("city"), tx.fold(F.col("state_name")).alias("state"), *pl.CODES
    )
    return rl.lookup_by_ambiguity(who, known, "city", "state", pl.CODES)


@query(f"""
WITH nations AS ({NATIONS_SQL}), places AS ({PLACES_SQL}), people AS ({PEOPLE_SQL}),
p AS (SELECT {fold_sql('country_name')} AS pc, {fold_sql('state_name')} AS ps, {fold_sql('city_name')} AS pt, country_id, state_id, city_id FROM places),
a AS (SELECT c_custkey, {fold_sql('country')} AS c, {fold_sql('province')} AS s, {fold_sql('city')} AS t FROM people),
d AS (SELECT DISTINCT c, s, t FROM a),
hits AS (
  SELECT d.*, country_id, state_id, city_id, CASE
    WHEN (contains(s, 'cundinamarca') OR contains(s, 'bogota')) AND contains(t, 'bogota') AND contains(ps, 'bogota') AND contains(pt, 'bogota') THEN 1
    WHEN (contains(s, 'cundinamarca') OR contains(s, 'bogota')) AND t <> 'bogota' AND contains(ps, 'cundinamarca') AND pt = t THEN 2
    WHEN contains(s, 'bolivar') AND contains(pt, 'cartagena') AND contains(t, 'cartagena') THEN 3
    WHEN c = 'mexico' AND s = 'ciudad de mexico' AND t IN ('cdmx', 'ciudad de mexico') AND ps = 'ciudad de mexico' AND pt = 'ciudad de mexico' THEN 4
    WHEN ps = s AND pt = t THEN 5
    WHEN ps = s AND contains(t, pt) AND NOT EXISTS (SELECT 1 FROM p q WHERE q.pc = c AND q.ps = s AND q.pt = t) THEN 6 END AS rule
  FROM d JOIN p ON pc = c),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c, s, t ORDER BY rule, country_id, state_id, city_id) AS rn FROM hits WHERE rule IS NOT NULL) WHERE rn = 1)
SELECT c_custkey, COALESCE(country_id, '169') AS country_id, COALESCE(state_id, '05') AS state_id, COALESCE(city_id, '001') AS city_id, rule AS location_rule
FROM a LEFT JOIN best USING (c, s, t)
""")
def resolve_location(spark, sf):
    who = people(spark, sf).select("c_custkey", "country", "province", "city")
    out = pl.resolve_location(who, places(spark, sf), "country", "province", "city", LocationDefaults())
    return out.select("c_custkey", *pl.CODES, "location_rule")


@query(f"""
WITH nations AS ({NATIONS_SQL}),
codes AS (SELECT * FROM (VALUES ('AFRICA', 'AF'), ('ASIA', 'AS'), ('EUROPE', 'EU')) AS v(country_name, code))
SELECT n_nationkey, state_name, code FROM nations LEFT JOIN codes USING (country_name)
""")
def literal_relation(spark, sf):
    codes = literal_rows(spark, [("AFRICA", "AF"), ("ASIA", "AS"), ("EUROPE", "EU")], "country_name string, code string")
    return named_nations(spark, sf).join(codes, "country_name", "left").select("n_nationkey", "state_name", "code")


@query("""
SELECT r_name, n_name, c_mktsegment, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3
""")
def join_chain(spark, sf):
    """Orders are counted per customer first; the chain of dimensions meets the counts."""
    per = table(spark, sf, "orders", "o_custkey").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return (
        per.join(table(spark, sf, "customer", "c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation", "n_nationkey", "n_name", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name", "n_name", "c_mktsegment").agg(F.sum("n").alias("orders"))
    )


@query("""
WITH best AS (SELECT l_suppkey, CAST(MAX(l_quantity) AS BIGINT) AS top FROM lineitem GROUP BY 1)
SELECT s_suppkey, s_name, top, (SELECT count(*) FROM nation) AS nations FROM supplier LEFT JOIN best ON s_suppkey = l_suppkey
""")
def scalar_lookup(spark, sf):
    """A scalar subquery next to a left join of an aggregated side."""
    best = table(spark, sf, "lineitem", "l_suppkey", "l_quantity").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.max("l_quantity").cast("bigint").alias("top")
    )
    nations = table(spark, sf, "nation", "n_nationkey").agg(F.count(F.lit(1)))
    rows = table(spark, sf, "supplier", "s_suppkey", "s_name").join(best, "s_suppkey", "left")
    return rows.select("s_suppkey", "s_name", "top", nations.scalar().alias("nations"))
