"""Product document and shipping label queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartloom.config import LabelConfig
from cartloom.plans import labels as lb
from cartloom.plans import products as pd
from cartloom.functions.text import pad_left
from cartloom.queries.registry import NATIONS_SQL, PEOPLE_SQL, people, query, run_ts, table, text


def long_rows(df, key, name, value, columns):
    """Columns of a wide table as rows (key, name, value)."""
    rows = F.array(*[F.struct(F.lit(n).alias(name), c.alias(value)) for n, c in columns.items()])
    return df.select(key, F.explode(rows).alias("r")).select(df.select(key).columns[0], "r.*")


@query("""
WITH base AS (SELECT p_partkey, 'R' || p_partkey AS reference, p_name, p_brand, p_type, p_size, CASE p_partkey % 2 WHEN 0 THEN 'MASCULINO' ELSE 'FEMENINO' END AS g,
                     CASE p_partkey % 2 WHEN 0 THEN 'Hombre' ELSE 'Mujer' END AS word FROM part WHERE p_size % 3 <> 0 AND p_brand <> 'Brand#12'),
b AS (SELECT * FROM base WHERE p_type <> 'PROMO' AND (contains(p_brand, '#1') OR contains(p_brand, '#2')))
SELECT reference, upper(left(p_name, 1)) || lower(substr(p_name, 2)) || ' Para ' || word || ' ' || upper(left(p_brand, 1)) || lower(substr(p_brand, 2)) AS name,
       CAST(p_partkey % 2 + 1 AS INTEGER) AS department, CAST(length(p_type) AS INTEGER) AS category,
       lower(p_name) || ' para ' || lower(word) || ' ' || lower(p_brand) || ' ' || lower(reference) AS link,
       lower(p_name) || ',' || lower(g) || ',' || lower(p_brand) AS key_words, upper(p_name) AS title FROM b
""")
def product_docs(spark, sf):
    """Documents of unseen flagged items, read back field by field."""
    k = F.col("p_partkey")
    part = table(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    ref = F.concat(F.lit("R"), text(k))
    items = part.select(k.alias("item_rowid"), F.concat(ref, F.lit("  ")).alias("reference"), F.lit("0001").alias("tax_group"))
    gender = F.when(k % 2 == 0, F.lit("010G")).otherwise(F.lit("011G"))
    classes = long_rows(
        part, k.alias("item_rowid"), "plan_id", "major_id",
        {"014": F.when(F.col("p_size") % 3 == 0, F.lit("NO")).otherwise(F.lit("SI 1")),
         "009": F.when(F.col("p_type") != "PROMO", F.col("p_type")), "003": F.col("p_brand"), "010": gender},
    )
    master = part.select(
        ref.alias("reference"), F.col("p_name").alias("description"),
        F.when(k % 2 == 0, F.lit("MASCULINO")).otherwise(F.lit("FEMENINO")).alias("gender_name"), F.col("p_brand").alias("brand_name"),
    )
    known = part.where("p_brand = 'Brand#12'").select(ref.alias("erp_reference"))
    departments = spark.createDataFrame([("010G", "1"), ("011G", "2")], "gender string, shop_id string")
    categories = part.select(gender.alias("gender"), F.col("p_type").alias("category"), text(F.length("p_type")).alias("shop_id")).distinct()
    brands = part.select(F.col("p_brand").alias("brand"), F.lit("7").alias("shop_id")).distinct()
    docs = pd.product_docs(
        items, classes, {"014": "flag", "009": "category", "003": "brand", "010": "gender"}, master, known, departments, categories, brands,
        ["#1", "#2"], run_ts(),
    )
    d = F.from_json("product", "Name string, DepartmentId int, CategoryId int, LinkId string, KeyWords string, Title string")
    return docs.select("reference", d.alias("d")).select(
        "reference", F.col("d.Name").alias("name"), F.col("d.DepartmentId").alias("department"), F.col("d.CategoryId").alias("category"),
        F.col("d.LinkId").alias("link"), F.col("d.KeyWords").alias("key_words"), F.col("d.Title").alias("title"),
    )


@query("""
WITH t AS (SELECT l_partkey, MAX(CASE WHEN l_returnflag = 'A' THEN 'long ' || l_orderkey END) AS a, MAX(CASE WHEN l_returnflag = 'N' THEN ' short ' || l_orderkey || chr(10) END) AS b,
                  MAX(CASE WHEN l_returnflag = 'R' THEN 'k-' || l_orderkey END) AS c FROM lineitem WHERE l_quantity > 30 GROUP BY 1)
SELECT lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(7, length(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0') AS ref_id, p_name AS name, CAST(p_size AS INTEGER) AS department, CAST(length(p_type) AS INTEGER) AS category, replace(p_name, ' ', '-') AS link,
       a AS long_text, replace(trim(b), chr(10), '') AS short_text, replace(c, '-', '') AS key_words
FROM part JOIN t ON l_partkey = p_partkey WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL AND p_type IN ('PROMO', 'LARGE', 'SMALL') AND p_brand <> 'Brand#3'
""")
def product_docs_eav(spark, sf):
    k = F.col("p_partkey")
    part = table(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    items = part.select(k.alias("item_rowid"), k.alias("item_id"), F.col("p_name").alias("description"), F.col("p_type").alias("category_label"))
    classes = long_rows(
        part, k.alias("item_rowid"), "plan_id", "note", {"15": text("p_size"), "10": text(F.length("p_type")), "60": F.lit("7")}
    )
    lines = table(spark, sf, "lineitem", "l_partkey", "l_orderkey", "l_returnflag", "l_quantity", where=F.col("l_quantity") > 30)
    o, f = text("l_orderkey"), F.col("l_returnflag")
    attributes = lines.select(
        F.col("l_partkey").alias("item_rowid"), f.alias("attribute_id"),
        F.when(f == "A", F.concat(F.lit("long "), o)).when(f == "N", F.concat(F.lit(" short "), o, F.lit("\n"))).otherwise(F.concat(F.lit("k-"), o)).alias("text_value"),
    )
    categories = spark.createDataFrame([("Promo!",), ("lar-ge",), ("SMÁLL",)], "name string")
    known = part.where("p_brand = 'Brand#3'").select(pad_left(k, 7).alias("ref_id"))
    docs = pd.product_docs_eav(
        items, classes, {"15": "department", "10": "category", "60": "brand"}, attributes,
        {"A": "long_text", "N": "short_text", "R": "key_words"}, categories, known,
    )
    d = F.from_json("product", "Name string, DepartmentId int, CategoryId int, LinkId string, Description string, DescriptionShort string, KeyWords string")
    return docs.select("ref_id", d.alias("d")).select(
        "ref_id", F.col("d.Name").alias("name"), F.col("d.DepartmentId").alias("department"), F.col("d.CategoryId").alias("category"),
        F.col("d.LinkId").alias("link"), F.col("d.Description").alias("long_text"), F.trim(F.col("d.DescriptionShort")).alias("short_text"),
        F.col("d.KeyWords").alias("key_words"),
    )


def _labels(spark, sf, cfg=LabelConfig()):
    k = F.col("o_orderkey")
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    who = people(spark, sf)
    shop = orders.join(who, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit("v"), pad_left(k, 8)).alias("order_id"), (k % 6).cast("int").alias("attempts"),
        F.when(F.col("o_orderstatus") == "P", 7).otherwise(3).alias("state"), F.when(k % 7 == 0, F.lit("labels")).when(k % 7 == 1, F.lit("party")).alias("endpoint"),
        F.when(k % 3 == 0, F.lit("Contra-entrega")).otherwise(F.lit("Coordinadora")).alias("delivery"), F.col("company").alias("party_id"),
        "name", F.concat_ws(" ", "address1", "address2").alias("address"), F.lit("05001000").alias("city"), "phone",
    )
    invoices = orders.select(
        k.alias("invoice_id"), F.concat(F.lit("OrderId: v"), pad_left(k, 8), F.lit(" Tienda: X")).alias("notes"),
        F.concat(F.lit("147-FE-"), text(k + 5)).alias("invoice_number"),
    )
    sender = {"id_cliente": "100", "nombre_remitente": "Shop & Sons", "direccion_remitente": "Main 1"}
    return lb.label_requests(shop, invoices, sender, cfg)


LABELS_SQL = f"""
WITH nations AS ({NATIONS_SQL}), people AS ({PEOPLE_SQL})
SELECT 'v' || lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(8, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0') AS order_id, '147-FE-' || (o_orderkey + 5) AS invoice_number, '22' AS service,
       replace(phone, '+57', '') AS phone, left('Entregar a: ' || name || ' Factura: 147-FE-' || (o_orderkey + 5), 85) AS remarks, 'Shop & Sons' AS sender {{more}}
FROM orders JOIN people ON o_custkey = c_custkey WHERE o_orderstatus = 'P' AND o_orderkey % 6 <= 3 AND o_orderkey % 3 = 0 AND o_orderkey % 7 <> 0
"""
LABEL_READ = "nivel_servicio string, telefono_destinatario string, observaciones string, nombre_remitente string"


def _read_label(requests, more=""):
    """Fields of the request body; types are dropped, as the reader knows no namespace."""
    body = F.regexp_replace(F.regexp_extract("request", "(?s)<p>.*</p>", 0), ' xsi:type="xsd:[a-z]+"', "")
    return requests.select("order_id", "invoice_number", F.from_xml(body, LABEL_READ + more).alias("b"), "request")


def _label_columns():
    return [
        "order_id", "invoice_number", F.col("b.nivel_servicio").alias("service"), F.col("b.telefono_destinatario").alias("phone"),
        F.col("b.observaciones").alias("remarks"), F.col("b.nombre_remitente").alias("sender"),
    ]


@query(LABELS_SQL.format(more=""))
def label_xml(spark, sf):
    """Label requests read back from their XML."""
    requests, _ = _labels(spark, sf)
    return _read_label(requests).select(*_label_columns())


@query(LABELS_SQL.format(more=", '35.0' AS declared, 'clothes <new> & more' AS content, CAST(41 AS INTEGER) AS fields"))
def label_xml_typed(spark, sf):
    """Label requests of the typed layout: types on every field, the carrier's trailing fields present."""
    cfg = LabelConfig(layout="typed", content="clothes <new> & more", declared_value=35)
    requests, _ = _labels(spark, sf, cfg)
    read = _read_label(requests, ", valor_declarado double, contenido string")
    fields = F.regexp_count("request", F.lit(" xsi:type=")) + F.regexp_count(F.regexp_extract("request", "</detalle>(.*)</p>", 1), F.lit("<[a-z0-9_]+/>"))
    return read.select(
        *_label_columns(), F.col("b.valor_declarado").cast("string").alias("declared"), F.col("b.contenido").alias("content"),
        fields.cast("int").alias("fields"),
    )


@query("""
SELECT 'v' || lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(8, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0') AS order_id, 8 AS state, 0 AS attempts FROM orders
WHERE o_orderstatus = 'P' AND o_orderkey % 6 <= 3 AND o_orderkey % 3 <> 0
""")
def label_skips(spark, sf):
    _, others = _labels(spark, sf)
    return others.select("order_id", "state", "attempts")
