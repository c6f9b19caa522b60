"""Scalar function queries over names, ids, phones, dates and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartloom.config import BRAND_MARKS, PREFIXED_ORIGINS
from cartloom.functions import codes as cd
from cartloom.functions import text as tx
from cartloom.queries.joins import fold_sql
from cartloom.queries.registry import (
    FIRST_NAMES, LAST_NAMES, NATIONS_SQL, PEOPLE_SQL, by_mod, people, query, sql_mod, table, text,
)
from cartloom.sources.schemas import CUSTOMER_LAYOUT


@query("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.none') AS missing,
       TRY_CAST(event_type AS INTEGER) AS bad_number, CAST(trunc(value) AS INTEGER) AS whole_value FROM events
""")
def json_scalars(spark, sf):
    doc = F.from_json("props", "k int, none string")
    return table(spark, sf, "events", "event_id", "props", "event_type", "value").select(
        "event_id", doc["k"].alias("k"), doc["none"].alias("missing"), F.col("event_type").try_cast("int").alias("bad_number"),
        F.col("value").cast("int").alias("whole_value"),
    )


@query(f"""
SELECT doc_id, md5({fold_sql('text')}) AS folded, CAST(length(regexp_replace({fold_sql('text')}, '[^a-z0-9]', '', 'g')) AS INTEGER) AS letters,
       regexp_replace(text, '[^0-9]', '', 'g') AS digits, CAST(length(regexp_replace(text, '[^0-9-]', '', 'g')) AS INTEGER) AS digits_hyphen,
       CAST(length(regexp_replace(text, '[\\r\\n]', '', 'g')) AS INTEGER) AS one_line FROM documents
""")
def fold_text(spark, sf):
    t = F.col("text")
    return table(spark, sf, "documents", "doc_id", "text").select(
        "doc_id", F.md5(tx.fold(t)).alias("folded"), F.length(tx.letters_digits(t)).alias("letters"),
        tx.digits_only(t).alias("digits"), F.length(tx.digits_hyphen(t)).alias("digits_hyphen"),
        F.length(tx.strip_newlines(t)).alias("one_line"),
    )


@query(f"""
WITH n AS (SELECT c_custkey, upper({sql_mod('c_custkey', LAST_NAMES)}) AS s FROM customer)
SELECT c_custkey, split_part(trim(s), ' ', 1) AS surname1,
       CASE WHEN strpos(trim(s), ' ') > 0 THEN ltrim(substr(trim(s), strpos(trim(s), ' '))) ELSE '' END AS surname2 FROM n
""")
def split_surname(spark, sf):
    s = F.upper(by_mod(F.col("c_custkey"), LAST_NAMES))
    return table(spark, sf, "customer", "c_custkey").select(
        "c_custkey", tx.first_surname(s).alias("surname1"), tx.other_surnames(s).alias("surname2")
    )


@query("""
SELECT p_partkey, lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(7, length(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0') AS ref_id, right('00' || (p_partkey * 37), 2) AS short_id FROM part
""")
def pad_right(spark, sf):
    k = F.col("p_partkey")
    return table(spark, sf, "part", "p_partkey").select(
        "p_partkey", tx.pad_left(k, 7).alias("ref_id"), tx.fixed_width(k * 37, 2).alias("short_id")
    )


@query("""
SELECT p_partkey, lower(replace(trim(p_name), ' ', '-')) AS link, upper(left(p_name, 1)) || lower(substr(p_name, 2)) AS proper,
       CASE WHEN p_size % 3 = 0 THEN '' ELSE CAST(p_size % 3 AS VARCHAR) END AS number_text,
       'Hombre' AS man, 'hombre y mujer' AS both_words FROM part
""")
def slug(spark, sf):
    n = F.col("p_name")
    return table(spark, sf, "part", "p_partkey", "p_name", "p_size").select(
        "p_partkey", tx.slug(n).alias("link"), tx.first_upper(n).alias("proper"), tx.number_text(F.col("p_size") % 3).alias("number_text"),
        tx.gender_word(F.lit("MASCULINO")).alias("man"), F.lower(tx.gender_word(F.lit("MASCULINO y FEMENINO"))).alias("both_words"),
    )


@query(f"""
WITH nations AS ({NATIONS_SQL}), people AS ({PEOPLE_SQL})
SELECT c_custkey, regexp_replace(company, '[^0-9]', '', 'g') AS digits, regexp_replace(company, '[^0-9-]', '', 'g') AS with_hyphen,
       CASE WHEN regexp_matches(company, '^[789]') AND length(rtrim(company)) >= 10 THEN 'N' ELSE 'C' END AS kind_by_prefix,
       CASE WHEN contains(regexp_replace(company, '[^0-9-]', '', 'g'), '-') THEN 'N' ELSE 'C' END AS kind_by_hyphen,
       CASE WHEN regexp_matches(company, '^[789]') THEN left(company, 9) ELSE company END AS company_9 FROM people
""")
def digits_only(spark, sf):
    c = F.col("company")
    return people(spark, sf).select(
        "c_custkey", tx.digits_only(c).alias("digits"), tx.digits_hyphen(c).alias("with_hyphen"), cd.id_kind(c).alias("kind_by_prefix"),
        cd.id_kind(c, rule="hyphen").alias("kind_by_hyphen"), cd.company_id_9(c, c.rlike("^[789]")).alias("company_9"),
    )


@query(f"""
WITH nations AS ({NATIONS_SQL}), people AS ({PEOPLE_SQL})
SELECT c_custkey, replace(phone, '+57', '') AS plain_phone, replace(replace(upper('x' || phone || ' #3'), '+57', ''), 'X', '') AS kept,
       CASE WHEN email IS NULL THEN 'none@example.com' ELSE email END AS email, left(COALESCE(email, ''), 6) AS short_email FROM people
""")
def phone_clean(spark, sf):
    p, e = F.col("phone"), F.col("email")
    return people(spark, sf).select(
        "c_custkey", tx.clean_phone(p).alias("plain_phone"),
        tx.clean_phone(F.concat(F.lit("x"), p, F.lit(" #3")), drop="X").alias("kept"),
        tx.clean_email(e, "none@example.com").alias("email"), tx.clean_email(e, None, 6).alias("short_email"),
    )


@query("""
WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'mercadolibre' ELSE 'other' END AS origin,
                  '2' || repeat('0', CAST(o_orderkey % 6 AS INTEGER)) || (o_orderkey * 7919 + 123456789) || o_custkey AS ext FROM orders),
b AS (SELECT *, CASE WHEN origin = 'mercadolibre' THEN regexp_extract(ext, '^.[^1-9]*([1-9].*)$', 1) ELSE ext END AS bare FROM r)
SELECT o_orderkey, CASE WHEN length(bare) > 10 THEN right(bare, 10) ELSE bare END AS reference,
       CASE WHEN length(bare) > 15 THEN right(bare, 15) ELSE bare END AS document FROM b
""")
def external_ref(spark, sf):
    k = F.col("o_orderkey")
    ext = F.concat(F.lit("2"), F.repeat(F.lit("0"), (k % 6).cast("int")), text(k * 7919 + 123456789), text("o_custkey"))
    origin = F.when(k % 2 == 0, F.lit("mercadolibre")).otherwise(F.lit("other"))
    return table(spark, sf, "orders", "o_orderkey", "o_custkey").select(
        "o_orderkey", *[tx.external_reference(ext, origin, n, PREFIXED_ORIGINS).alias(a) for n, a in ((10, "reference"), (15, "document"))]
    )


@query("""
WITH s AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '0' ELSE '' END || p_partkey || '-' || p_size AS sku,
                  CASE p_partkey % 3 WHEN 0 THEN 'Laptop hp ' WHEN 1 THEN 'Apple ' ELSE 'Other ' END || p_name AS product FROM part)
SELECT p_partkey, CASE WHEN starts_with(sku, '0') THEN substr(sku, 2) ELSE sku END AS bare,
       CASE WHEN contains(upper(product), 'HP') THEN replace(sku, '-', '#') WHEN contains(upper(product), 'APPLE') THEN replace(sku, '-', '/') ELSE sku END AS marked FROM s
""")
def normalise_sku(spark, sf):
    k = F.col("p_partkey")
    sku = F.concat(F.when(k % 2 == 0, F.lit("0")).otherwise(F.lit("")), text(k), F.lit("-"), text("p_size"))
    product = F.concat(by_mod(k, ["Laptop hp ", "Apple ", "Other "]), F.col("p_name"))
    return table(spark, sf, "part", "p_partkey", "p_name", "p_size").select(
        "p_partkey", tx.drop_leading_zero(sku).alias("bare"), tx.brand_sku(sku, product, BRAND_MARKS).alias("marked")
    )


@query(f"""
WITH nations AS ({NATIONS_SQL}), people AS ({PEOPLE_SQL})
SELECT c_custkey, left(address1, 39) AS line_1, CASE WHEN length(address1) > 39 THEN substr(address1, 40, 39) ELSE left(COALESCE(address2, ''), 39) END AS line_2 FROM people
""")
def address_split(spark, sf):
    a, b = F.col("address1"), F.col("address2")
    return people(spark, sf).select("c_custkey", tx.address_line_1(a).alias("line_1"), tx.address_line_2(a, b).alias("line_2"))


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS day, strftime(o_orderdate + INTERVAL 1 DAY, '%Y%m%d') AS next_day,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso,
       strftime(o_orderdate + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M') AS utc_minute, CAST(NULL AS VARCHAR) AS unreadable FROM orders
""")
def date_text(spark, sf):
    d = F.col("o_orderdate")
    offset = tx.iso_instant(F.concat(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00")))
    return table(spark, sf, "orders", "o_orderkey", "o_orderdate").select(
        "o_orderkey", tx.day_text(d).alias("day"), tx.day_text(F.date_add(d, 1)).alias("next_day"),
        F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss").alias("iso"), F.date_format(offset, "yyyy-MM-dd HH:mm").alias("utc_minute"),
        F.date_format(tx.iso_instant(F.concat(F.lit("x"), text("o_orderkey"))), "yyyy").alias("unreadable"),
    )


@query(f"""
WITH nations AS ({NATIONS_SQL}), people AS ({PEOPLE_SQL})
SELECT c_custkey, NULLIF(trim(company), '') AS customer_only, NULLIF(trim(billing_company), '') AS billing_only,
       COALESCE(NULLIF(trim(company), ''), NULLIF(trim(billing_company), '')) AS customer_first,
       COALESCE(NULLIF(trim(billing_company), ''), NULLIF(trim(company), '')) AS billing_first FROM people
""")
def field_priority(spark, sf):
    c, b = F.col("company"), F.col("billing_company")
    names = {1: "customer_only", 2: "billing_only", 3: "customer_first", 4: "billing_first"}
    return people(spark, sf).select("c_custkey", *[cd.by_origin(o, c, b).alias(n) for o, n in names.items()])


@query(f"""
WITH nations AS ({NATIONS_SQL}), people AS ({PEOPLE_SQL})
SELECT c_custkey, left(name || ' ' || name || ' ' || name, 40) AS branch_name, left(address1, 40) AS address, left(phone || phone, 20) AS phone,
       left({sql_mod('c_custkey', FIRST_NAMES)}, 3) AS branch FROM people
""")
def fit_width(spark, sf):
    n = F.col("name")
    w = CUSTOMER_LAYOUT
    return people(spark, sf).select(
        "c_custkey", tx.clip(F.concat_ws(" ", n, n, n), w["F201_DESCRIPCION_SUCURSAL"]).alias("branch_name"),
        tx.clip(F.col("address1"), w["F015_DIRECCION1"]).alias("address"),
        tx.clip(F.concat("phone", "phone"), w["F015_TELEFONO"]).alias("phone"), tx.clip(F.col("first_name"), w["F201_ID_SUCURSAL"]).alias("branch"),
    )


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '02' WHEN 'P' THEN '04' ELSE '01' END AS warehouse,
       CASE WHEN contains(o_orderpriority, 'URGENT') THEN 'C1' WHEN contains(o_orderpriority, 'HIGH') THEN 'C2' END AS payment FROM orders
""")
def map_codes(spark, sf):
    return table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority").select(
        "o_orderkey", cd.map_code(F.col("o_orderstatus"), {"F": "02", "P": "04"}, "01").alias("warehouse"),
        cd.map_code(F.col("o_orderpriority"), {"URGENT": "C1", "HIGH": "C2"}, None, "contains").alias("payment"),
    )
