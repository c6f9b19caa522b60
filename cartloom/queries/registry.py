"""Registry of queries and the stand-in tables they run on."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.operators.skew import hot_table, is_hot, page_rows, page_small
from cartloom.sources.tables import read_source

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Declared schemas of the driver tables.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}
RUN_TS = "2024-02-01 10:30:00"
# Most lines of one shop document; longer orders arrive as several documents, the first of which carries what belongs to
# the order as a whole: freight and party.
PAGE = 200


def query(sql: str | None = None):
    """Register a query under its function name, with the SQL that must give the same rows."""

    def wrap(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return wrap


def table(spark: SparkSession, sf: str, name: str, *columns: str, where: Column | None = None) -> DataFrame:
    return read_source(spark, f"{sf}/{name}.parquet", list(columns) or None, where, schema=SCHEMAS[name])


def run_ts() -> Column:
    return F.lit(RUN_TS).cast("timestamp")


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def by_mod(n: Column, values: list[str | None]) -> Column:
    """A value picked by remainder."""
    out = F.lit(values[-1]).cast("string")
    for i, v in enumerate(values[:-1]):
        out = F.when(n % len(values) == i, F.lit(v)).otherwise(out)
    return out


def sql_mod(n: str, values: list[str | None]) -> str:
    arms = " ".join(f"WHEN {i} THEN {_quote(v)}" for i, v in enumerate(values))
    return f"CASE ({n}) % {len(values)} {arms} END"


def _quote(v: str | None) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


# --- stock -------------------------------------------------------------------


# Every item has three extensions; a line's number decides which one it sells.
EXTENSIONS = 3


def stock_levels(lines: DataFrame) -> DataFrame:
    """On-hand, committed and POS quantities per extension and warehouse, with fractions and gaps.

    Some rows have no POS quantity, some no warehouse.
    """
    q, wh = F.col("l_quantity"), F.col("warehouse_rowid")
    amount = lambda c: c.cast("decimal(18,6)")
    returned = F.sum(F.when((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "R"), q).otherwise(0))
    sums = lines.groupBy(
        (F.col("l_partkey") * EXTENSIONS + F.pmod("l_linenumber", F.lit(EXTENSIONS))).cast("bigint").alias("ext_rowid"),
        F.when(F.col("l_suppkey") % 13 != 0, F.col("l_suppkey")).alias("warehouse_rowid"),
    ).agg(
        amount(F.sum(q) + 0.5).alias("on_hand"), amount(F.sum(F.when(F.col("l_linestatus") == "O", q).otherwise(0)) + 0.7).alias("committed"),
        amount(returned).alias("pos"),
    )
    return sums.withColumn("pos", F.when(wh.isNull() | (wh % 11 != 0), F.col("pos")))


LEVELS_SQL = f"""
SELECT CAST(l_partkey * {EXTENSIONS} + l_linenumber % {EXTENSIONS} AS BIGINT) AS ext_rowid,
       CASE WHEN l_suppkey % 13 <> 0 THEN l_suppkey END AS warehouse_rowid,
       CAST(trunc(SUM(l_quantity) + 0.5) AS INTEGER) AS on_hand,
       CAST(trunc(SUM(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) + 0.7) AS INTEGER) AS committed,
       CAST(trunc(SUM(CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN l_quantity ELSE 0 END)) AS INTEGER) AS returned,
       COALESCE(on_hand - (committed + CASE WHEN warehouse_rowid IS NULL OR warehouse_rowid % 11 <> 0 THEN returned END), 0) AS available
FROM lineitem {{where}} GROUP BY 1, 2
"""


def _each_extension(part: DataFrame) -> DataFrame:
    return part.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(EXTENSIONS - 1)))).withColumn(
        "ext_rowid", (F.col("p_partkey") * EXTENSIONS + F.col("n")).cast("bigint")
    )


def extensions(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    return _each_extension(part).select(
        "ext_rowid", k.alias("item_rowid"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("B"), text(k))).alias("main_barcode"),
    )


def barcodes(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    return _each_extension(part.where(k % 2 == 0)).select(
        F.concat(F.lit("X"), text(k)).alias("barcode"), "ext_rowid", (k % 10).alias("warehouse_rowid")
    )


def erp_warehouses(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    return supplier.select(k.alias("warehouse_rowid"), F.concat(F.lit("W"), text(k)).alias("warehouse_id"))


SKU_SQL = "CASE WHEN p_partkey % 3 <> 0 THEN 'B' || p_partkey WHEN p_partkey % 2 = 0 THEN 'X' || p_partkey END"

# --- prices ------------------------------------------------------------------


def unit_price(ext: str = "l_extendedprice", qty: str = "l_quantity") -> Column:
    return (F.col(ext).cast("decimal(18,2)") / F.col(qty).cast("decimal(18,2)")).cast("decimal(18,2)")


CENTS_SQL = "CAST(ROUND(l_extendedprice * 100) AS BIGINT)"
QTY_SQL = "CAST(l_quantity AS BIGINT)"
PRICE_CENTS_SQL = f"((2 * {CENTS_SQL} + {QTY_SQL}) // (2 * {QTY_SQL}))"


def pair_id(high: Column, low: Column) -> Column:
    """One number for two bigints of any size, which no other pair has."""
    return (high.cast("decimal(19,0)") * F.lit(Decimal(10**19)) + low).cast("decimal(38,0)")


PAIR_SQL = "CAST(CAST({} AS HUGEINT) * 10000000000000000000 + {} AS DECIMAL(38,0))"


def price_history(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("l_shipdate").alias("activation"), F.col("l_partkey").alias("item_rowid"),
        F.when(F.col("l_suppkey") % 2 == 0, pair_id(F.col("l_suppkey"), F.col("l_partkey"))).alias("ext_rowid"),
        unit_price().alias("price"), F.col("l_returnflag").alias("list_id"),
    )


PRICES_SQL = f"""
SELECT l_shipdate AS activation, l_partkey AS item_rowid,
       CASE WHEN l_suppkey % 2 = 0 THEN {PAIR_SQL.format('l_suppkey', 'l_partkey')} END AS ext_rowid,
       {PRICE_CENTS_SQL} AS cents, l_returnflag AS list_id FROM lineitem
"""

PRICE_COLUMNS = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate", "l_returnflag"]

# --- places and people -------------------------------------------------------

STATE_NAMES = {0: "Bogotá D.C.", 5: "Cundinamarca", 10: "Bolívar", 1: "Ciudad de México"}
STATE_CITIES = {0: "Bogotá, D.C.", 10: "Cartagena de Indias", 1: "Ciudad de México"}


def named_nations(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    state = F.col("n_name")
    for key, name in STATE_NAMES.items():
        state = F.when(F.col("n_nationkey") == key, F.lit(name)).otherwise(state)
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_regionkey", "n_name", state.alias("state_name"),
        F.when(F.col("r_name") == "AMERICA", F.lit("México")).otherwise(F.col("r_name")).alias("country_name"),
    )


def places(spark: SparkSession, sf: str) -> DataFrame:
    special = F.lit(None).cast("string")
    for key, name in STATE_CITIES.items():
        special = F.when(F.col("n_nationkey") == key, F.lit(name)).otherwise(special)
    cities = F.array(F.concat(F.lit("Puerto "), F.col("n_name")), F.lit("Villa"), special)
    rows = named_nations(spark, sf).select("*", F.posexplode(cities).alias("at", "city_name")).where("city_name is not null")
    return rows.select(
        "country_name", "state_name", "city_name", F.lpad(text("n_regionkey"), 3, "0").alias("country_id"),
        F.lpad(text("n_nationkey"), 2, "0").alias("state_id"), F.lpad(text("at"), 3, "0").alias("city_id"),
    )


NATIONS_SQL = """
SELECT n_nationkey, n_regionkey, n_name,
       CASE n_nationkey WHEN 0 THEN 'Bogotá D.C.' WHEN 5 THEN 'Cundinamarca' WHEN 10 THEN 'Bolívar'
            WHEN 1 THEN 'Ciudad de México' ELSE n_name END AS state_name,
       CASE r_name WHEN 'AMERICA' THEN 'México' ELSE r_name END AS country_name
FROM nation JOIN region ON n_regionkey = r_regionkey
"""
PLACES_SQL = """
SELECT country_name, state_name, city_name, lpad(CAST(n_regionkey AS VARCHAR), 3, '0') AS country_id,
       lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state_id, lpad(CAST(idx AS VARCHAR), 3, '0') AS city_id
FROM (SELECT *, 0 AS idx, 'Puerto ' || n_name AS city_name FROM nations
      UNION ALL SELECT *, 1, 'Villa' FROM nations
      UNION ALL SELECT *, 2, CASE n_nationkey WHEN 0 THEN 'Bogotá, D.C.' WHEN 10 THEN 'Cartagena de Indias'
                             ELSE 'Ciudad de México' END FROM nations WHERE n_nationkey IN (0, 10, 1))
"""

FIRST_NAMES = ["Ana", "José", "Mar & Sol", "Luis Ángel", "Zoë"]
LAST_NAMES = ["Pérez", "Gómez Ruiz", " De la Cruz Núñez", "Ñáñez"]


PERSON = (
    "first_name", "last_name", "name", "company", "billing_company", "address1", "address2", "phone", "email", "country", "province", "city",
)


def person_columns() -> dict[str, Column]:
    """Invented names, ids, addresses and places of a customer, from its key and its nation."""
    k = F.col("c_custkey")
    first, last = by_mod(k, FIRST_NAMES), by_mod(k, LAST_NAMES)
    ident = (
        F.when(k % 6 == 0, F.concat(F.lit("9"), F.lpad(text(k), 9, "0"))).when(k % 6 == 1, F.lit("  "))
        .when(k % 6 == 3, F.concat(F.lpad(text(k), 8, "1"), F.lit("-3"))).when(k % 6 == 4, F.lpad(text(k), 8, "1"))
        .when(k % 6 == 5, F.concat(F.lit("CC 1."), F.lpad(text(k), 7, "2")))
    )
    billing = F.when(k % 5 == 1, F.lit("")).when(k % 5 != 0, F.concat(F.lit("NIT 8"), F.lpad(text(k), 9, "0")))
    city = (
        F.when(k % 6 == 0, F.concat(F.lit("PUERTO "), F.col("n_name")))
        .when(k % 6 == 1, F.concat(F.lit("Puerto "), F.col("n_name"), F.lit(" Centro")))
        .when(k % 6 == 2, F.lit("Bogotá")).when(k % 6 == 3, F.lit("Cartagena")).when(k % 6 == 4, F.lit("CDMX"))
        .otherwise(F.lit("villa"))
    )
    made = [
        first, last, F.concat(first, F.lit(" "), last), ident, billing,
        F.concat(F.lit("Calle "), text(k), F.lit(" # 10-20 apartamento "), text(k * 37), F.lit(" torre "), text(k % 9)),
        F.when(k % 3 != 0, F.concat(F.lit("Barrio "), text(k % 50))),
        F.concat(F.lit("+57300"), F.lpad(text(k), 7, "0")),
        F.when(k % 8 != 0, F.concat(F.lit("c"), text(k), F.lit("@example.com"))),
        F.upper("country_name"), F.col("state_name"), city,
    ]
    return dict(zip(PERSON, made))


def people(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with invented names, ids, addresses and places."""
    cust = table(spark, sf, "customer", "c_custkey", "c_nationkey", "c_name")
    return cust.join(named_nations(spark, sf), F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", *[c.alias(n) for n, c in person_columns().items()]
    )


def with_customer(orders: DataFrame, spark: SparkSession, sf: str, how: str) -> DataFrame:
    """Orders with the keys of their customer, which is all of it that moves with them; ``with_person`` makes the rest."""
    nations = named_nations(spark, sf).select("n_nationkey")
    cust = table(spark, sf, "customer", "c_custkey", "c_nationkey").join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    return orders.join(cust, F.col("o_custkey") == F.col("c_custkey"), how)


def with_person(rows: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """Rows of ``with_customer`` with the columns of ``people``; all null without a customer."""
    placed = rows.join(named_nations(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return placed.withColumns({n: F.when(F.col("c_custkey").isNotNull(), c) for n, c in person_columns().items()})


PEOPLE_SQL = f"""
SELECT c_custkey, c_name, {sql_mod('c_custkey', FIRST_NAMES)} AS first_name, {sql_mod('c_custkey', LAST_NAMES)} AS last_name,
       {sql_mod('c_custkey', FIRST_NAMES)} || ' ' || {sql_mod('c_custkey', LAST_NAMES)} AS name,
       CASE c_custkey % 6 WHEN 0 THEN '9' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') WHEN 1 THEN '  '
            WHEN 3 THEN lpad(CAST(c_custkey AS VARCHAR), 8, '1') || '-3' WHEN 4 THEN lpad(CAST(c_custkey AS VARCHAR), 8, '1')
            WHEN 5 THEN 'CC 1.' || lpad(CAST(c_custkey AS VARCHAR), 7, '2') END AS company,
       CASE WHEN c_custkey % 5 = 1 THEN '' WHEN c_custkey % 5 <> 0 THEN 'NIT 8' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') END AS billing_company,
       'Calle ' || c_custkey || ' # 10-20 apartamento ' || (c_custkey * 37) || ' torre ' || (c_custkey % 9) AS address1,
       CASE WHEN c_custkey % 3 <> 0 THEN 'Barrio ' || (c_custkey % 50) END AS address2,
       '+57300' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS phone,
       CASE WHEN c_custkey % 8 <> 0 THEN 'c' || c_custkey || '@example.com' END AS email,
       upper(country_name) AS country, state_name AS province,
       CASE c_custkey % 6 WHEN 0 THEN 'PUERTO ' || n_name WHEN 1 THEN 'Puerto ' || n_name || ' Centro' WHEN 2 THEN 'Bogotá'
            WHEN 3 THEN 'Cartagena' WHEN 4 THEN 'CDMX' ELSE 'villa' END AS city
FROM customer JOIN nations ON c_nationkey = n_nationkey
"""

# --- order documents ---------------------------------------------------------

LINE_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


def with_lines(orders: DataFrame, spark: SparkSession, sf: str, item: Column, name: str, last: str, how: str) -> DataFrame:
    """Orders with ``part`` and a list ``name`` of their lines, one row per part of at most PAGE lines.

    ``item`` is made of a line and its ``line_id`` inside the part; of LINE_ORDER it reads columns up to ``last``. Lines equal
    in all of these make equal items, so the columns behind it cannot change a list and stay in the files. Lines move once,
    to the task of their order; orders with too many lines for a task are ranked over many tasks and met part by part.
    """
    order = LINE_ORDER[: LINE_ORDER.index(last) + 1]
    lines = table(spark, sf, "lineitem", "l_orderkey", *order).where("l_orderkey is not null")
    hot = hot_table(lines.select("l_orderkey"), ["l_orderkey"])
    hot_line, hot_order, same = is_hot(hot, ["l_orderkey"]), is_hot(hot, ["o_orderkey"]), F.col("o_orderkey") == F.col("l_orderkey")

    def lists(paged: DataFrame) -> DataFrame:
        return paged.groupBy("l_orderkey", "part").agg(F.collect_list(item).alias(name))

    small = lists(page_small(lines.where(~hot_line), ["l_orderkey"], order, PAGE, "part", "line_id"))
    found = orders.where(~hot_order).join(small, same, how)
    # An inner join, so that the many parts of a hot order can be split over tasks; orders
    # without lines come in separately.
    large = lists(page_rows(lines.where(hot_line), ["l_orderkey"], order, PAGE, "part", "line_id"))
    found = found.unionByName(orders.where(hot_order).join(large, same))
    if how == "left":
        ordered = lines.where(hot_line).select("l_orderkey").distinct()
        found = found.unionByName(orders.where(hot_order).join(ordered, same, "left_anti"), allowMissingColumns=True)
    return found.drop("l_orderkey")


LINES_SQL = f"""
SELECT *, (rn - 1) // {PAGE} + 1 AS part, (rn - 1) % {PAGE} + 1 AS line_id,
       {CENTS_SQL} AS cents, {QTY_SQL} AS q, {PRICE_CENTS_SQL} AS price_cents,
       CAST(ROUND(l_discount * 100) AS BIGINT) AS disc_pct, CAST(ROUND(l_tax * 100) AS BIGINT) AS tax_pct
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) AS rn FROM lineitem)
"""
# One row per order and part; orders without lines keep one empty part.
PARTS_SQL = """
SELECT o.*, COALESCE(p.part, 1) AS part,
       '#' || o_orderkey || CASE WHEN COALESCE(p.part, 1) > 1 THEN '-' || p.part ELSE '' END AS order_name
FROM orders o LEFT JOIN (SELECT DISTINCT l_orderkey, part FROM lines) p ON o_orderkey = l_orderkey
"""


def order_name(key: Column, part: Column) -> Column:
    return F.concat(F.lit("#"), text(key), F.when(part > 1, F.concat(F.lit("-"), text(part))).otherwise(F.lit("")))


GATEWAYS = {
    "1-URGENT": ["gift_card", "Wompi"],
    "2-HIGH": ["Addi Payment"],
    "3-MEDIUM": ["Mercado Pago Checkout Pro", "gift_card"],
    "4-NOT SPECIFIED": ["unknown gateway"],
    "5-LOW": ["gift_card"],
}
# Shipping lines by remainder of the order key: (price, removed, discount).
SHIPPING = {0: [], 1: [("0.00", "false", None)], 2: [("10000.00", "true", None)],
            3: [("14000.00", "false", None), ("9000.00", "false", None)], 4: [("9000.00", "false", "500.00")]}
SHIPPING_LINES = "array<struct<price:string,is_removed:string,discount_allocations:array<struct<amount:string>>>>"


def _gateways() -> Column:
    out = F.array().cast("array<string>")
    for name, values in GATEWAYS.items():
        out = F.when(F.col("o_orderpriority") == name, F.array(*[F.lit(v) for v in values])).otherwise(out)
    return out


def _shipping() -> Column:
    out = F.array().cast(SHIPPING_LINES)
    for rest, rows in SHIPPING.items():
        made = F.array(
            *[
                F.struct(
                    F.lit(p).alias("price"), F.lit(r).alias("is_removed"),
                    (F.array(F.struct(F.lit(d).alias("amount"))) if d else F.array()).cast("array<struct<amount:string>>").alias("discount_allocations"),
                )
                for p, r, d in rows
            ]
        ).cast(SHIPPING_LINES)
        out = F.when(F.col("o_orderkey") % 5 == rest, made).otherwise(out)
    return out


def order_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Queue of allocation-dialect order documents as JSON text."""
    ext, disc = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_discount").cast("decimal(4,2)")
    by_rate = F.struct(text((ext * disc).cast("decimal(18,2)")).alias("amount"))
    by_tax = F.struct(text((ext * F.lit("0.01").cast("decimal(4,2)")).cast("decimal(18,2)")).alias("amount"))
    rated, taxed = F.coalesce(disc > 0, F.lit(False)), F.coalesce(F.col("l_tax").cast("decimal(4,2)") >= 0.07, F.lit(False))
    allocations = (
        F.when(rated & taxed, F.array(by_rate, by_tax)).when(rated, F.array(by_rate)).when(taxed, F.array(by_tax))
        .otherwise(F.array().cast("array<struct<amount:string>>"))
    )
    item = F.struct(
        text("line_id").alias("id"), F.concat(F.lit("P"), text("l_partkey")).alias("sku"),
        text(F.col("l_quantity").cast("int")).alias("quantity"), text(unit_price()).alias("price"),
        allocations.alias("discount_allocations"),
    )
    place = ["name", "first_name", "last_name", "company", "address1", "address2", "phone", "country", "province", "city"]
    home = F.struct(*place).alias("default_address")
    bill = F.struct(*[F.col("billing_company").alias("company") if p == "company" else F.col(p) for p in place])
    target = F.when(F.col("o_orderkey") % 3 == 0, F.lit("line_item")).when(F.col("o_orderkey") % 3 == 1, F.lit("shipping_line"))
    applications = F.when(
        target.isNotNull(),
        F.array(F.struct(F.lit("manual").alias("type"), F.lit("10").alias("value"), target.alias("target_type"), F.lit("fixed").alias("value_type"))),
    ).otherwise(F.array().cast("array<struct<type:string,value:string,target_type:string,value_type:string>>"))
    part = F.coalesce("part", F.lit(1))
    # Orders meet their customers while both are narrow; names and addresses are made where the document is.
    orders = with_customer(table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"), spark, sf, "left")
    rows = with_person(with_lines(orders, spark, sf, item, "line_items", "l_tax", "left"), spark, sf)
    created = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ssXXX")
    body = F.struct(
        order_name(F.col("o_orderkey"), part).alias("name"), text("o_orderkey").alias("id"), text("o_orderkey").alias("order_number"),
        created.alias("created_at"), created.alias("updated_at"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit("usd")).otherwise(F.lit("COP")).alias("currency"),
        F.struct("email", created.alias("created_at"), home).alias("customer"), bill.alias("billing_address"),
        F.struct(*place).alias("shipping_address"), F.col("line_items"),
        F.when(part == 1, _shipping()).otherwise(F.array().cast(SHIPPING_LINES)).alias("shipping_lines"),
        applications.alias("discount_applications"), _gateways().alias("payment_gateway_names"),
    )
    return rows.select(
        order_name(F.col("o_orderkey"), part).alias("order_id"), "o_orderkey", part.alias("part"), F.to_json(body).alias("document")
    )
