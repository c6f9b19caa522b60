"""Party document and identity queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from cartloom.config import ClassRow, CurrencyRule, EntityRow, MarketplaceConfig, MinorUnitOrderConfig, PartyConfig, TaxRow
from cartloom.plans import parties as pt
from cartloom.plans.queue import id_outcome, party_id
from cartloom.queries.documents import CLIENT_TYPE_SQL, DOCS_SQL, PAID_SQL, parsed_orders, payment_documents, stored_orders
from cartloom.queries.joins import fold_sql
from cartloom.queries.orders import marketplace_orders, profile_orders
from cartloom.queries.registry import LINES_SQL, NATIONS_SQL, PARTS_SQL, PEOPLE_SQL, PLACES_SQL, people, places, query, run_ts
from cartloom.sources.tables import successful_payments

# What party jobs read of an order document.
PARTY_FIELDS = ("id", "name", "currency", "customer", "billing_address", "shipping_address")

CFG = PartyConfig(
    taxes=(TaxRow("46", "1", "1"), TaxRow("47", "1", "1")),
    entities=(EntityRow("FE TERCERO", "EUNOECO017", "co017_codigo_regimen", "MUNOECO016", "49"),),
)

# Place codes of every customer, by the rules of the place lookup.
PLACED_SQL = f"""
nations AS ({NATIONS_SQL}), places AS ({PLACES_SQL}), people AS ({PEOPLE_SQL}),
p AS (SELECT {fold_sql('country_name')} AS pc, {fold_sql('state_name')} AS ps, {fold_sql('city_name')} AS pt, country_id, state_id, city_id FROM places),
asked AS (SELECT *, {fold_sql('country')} AS c, {fold_sql('province')} AS s, {fold_sql('city')} AS t FROM people),
hits AS (
  SELECT d.*, country_id, state_id, city_id, CASE
    WHEN (contains(s, 'cundinamarca') OR contains(s, 'bogota')) AND contains(t, 'bogota') AND contains(ps, 'bogota') AND contains(pt, 'bogota') THEN 1
    WHEN (contains(s, 'cundinamarca') OR contains(s, 'bogota')) AND t <> 'bogota' AND contains(ps, 'cundinamarca') AND pt = t THEN 2
    WHEN contains(s, 'bolivar') AND contains(pt, 'cartagena') AND contains(t, 'cartagena') THEN 3
    WHEN c = 'mexico' AND s = 'ciudad de mexico' AND t IN ('cdmx', 'ciudad de mexico') AND ps = 'ciudad de mexico' AND pt = 'ciudad de mexico' THEN 4
    WHEN ps = s AND pt = t THEN 5
    WHEN ps = s AND contains(t, pt) AND NOT EXISTS (SELECT 1 FROM p q WHERE q.pc = c AND q.ps = s AND q.pt = t) THEN 6 END AS rule
  FROM (SELECT DISTINCT c, s, t FROM asked) d JOIN p ON pc = c),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c, s, t ORDER BY rule, country_id, state_id, city_id) AS rn FROM hits WHERE rule IS NOT NULL) WHERE rn = 1),
placed AS (SELECT asked.*, COALESCE(country_id, '169') AS country_id, COALESCE(state_id, '05') AS state_id, COALESCE(city_id, '001') AS city_id
           FROM asked LEFT JOIN best USING (c, s, t))
"""

PARTY_DOC = (
    "Terceros array<struct<F200_ID:string,F200_ID_TIPO_IDENT:string,F200_IND_TIPO_TERCERO:string,F200_RAZON_SOCIAL:string,"
    "F200_APELLIDO1:string,F200_APELLIDO2:string,F015_DIRECCION1:string,F015_ID_PAIS:string,F015_ID_DEPTO:string,"
    "F015_ID_CIUDAD:string,F015_TELEFONO:string,F015_EMAIL:string>>, Clientes array<struct<F201_FECHA_INGRESO:string>>, "
    "ImptosyReten array<struct<F_TIPO_REG:string,F_ID_TERCERO:string>>, EntDinamicaTercero array<struct<f200_id:string>>"
)


@query(f"""
WITH {PLACED_SQL}, {DOCS_SQL},
i AS (SELECT order_name, o_orderdate, placed.*, regexp_replace(COALESCE(NULLIF(trim(billing_company), ''), NULLIF(trim(company), '')), '[^0-9]', '', 'g') AS id
      FROM docs JOIN placed ON o_custkey = c_custkey WHERE part = 1 AND COALESCE(NULLIF(trim(billing_company), ''), NULLIF(trim(company), '')) IS NOT NULL)
SELECT order_name AS order_id, left(id, 15) AS party, CASE WHEN regexp_matches(id, '^[789]') AND length(id) >= 10 THEN 'N' ELSE 'C' END AS id_kind,
       CASE WHEN regexp_matches(id, '^[789]') AND length(id) >= 10 THEN '2' ELSE '1' END AS party_kind, left(upper(trim(name)), 100) AS legal_name,
       split_part(trim(upper(last_name)), ' ', 1) AS surname1,
       CASE WHEN strpos(trim(last_name), ' ') > 0 THEN left(ltrim(substr(trim(upper(last_name)), strpos(trim(last_name), ' '))), 29) ELSE '' END AS surname2,
       left(upper(address1), 40) AS address, country_id || state_id || city_id AS place, replace(phone, '+57', '') AS phone, email,
       strftime(o_orderdate, '%Y%m%d') AS created, 2 AS taxes, 1 AS entities, left(id, 15) AS tax_party
FROM i
""")
def party_docs(spark, sf):
    """Party documents read back field by field; orders without an id give none."""
    built = pt.build_party_docs(stored_orders(spark, sf, *PARTY_FIELDS), places(spark, sf), CFG)
    doc = built.select("idOrden", F.from_json("json", PARTY_DOC).alias("d"))
    p, c = F.get("d.Terceros", F.lit(0)), F.get("d.Clientes", F.lit(0))
    return doc.select(
        F.col("idOrden").alias("order_id"), p["F200_ID"].alias("party"), p["F200_ID_TIPO_IDENT"].alias("id_kind"),
        p["F200_IND_TIPO_TERCERO"].alias("party_kind"), p["F200_RAZON_SOCIAL"].alias("legal_name"), p["F200_APELLIDO1"].alias("surname1"),
        p["F200_APELLIDO2"].alias("surname2"), p["F015_DIRECCION1"].alias("address"),
        F.concat(p["F015_ID_PAIS"], p["F015_ID_DEPTO"], p["F015_ID_CIUDAD"]).alias("place"), p["F015_TELEFONO"].alias("phone"),
        p["F015_EMAIL"].alias("email"), c["F201_FECHA_INGRESO"].alias("created"), F.size("d.ImptosyReten").alias("taxes"),
        F.size("d.EntDinamicaTercero").alias("entities"), F.get("d.ImptosyReten", F.lit(0))["F_ID_TERCERO"].alias("tax_party"),
    )


def _built(spark, sf, cfg, payments=None, schema=PARTY_DOC):
    built = pt.build_party_docs(stored_orders(spark, sf, *PARTY_FIELDS), places(spark, sf), cfg, payments)
    return built.select(F.col("idOrden").alias("order_id"), F.from_json("json", schema).alias("d"))


@query(f"""
WITH nations AS ({NATIONS_SQL}), people AS ({PEOPLE_SQL}),
i AS (SELECT o_orderkey, CASE WHEN regexp_replace(COALESCE(billing_company, ''), '[^0-9]', '', 'g') <> '' THEN regexp_replace(billing_company, '[^0-9-]', '', 'g')
             WHEN regexp_replace(COALESCE(company, ''), '[^0-9]', '', 'g') <> '' THEN regexp_replace(company, '[^0-9-]', '', 'g') END AS id
      FROM orders JOIN people ON o_custkey = c_custkey)
SELECT '#' || o_orderkey AS order_id, left(id, 15) AS party, CASE WHEN contains(id, '-') THEN 'N' ELSE 'C' END AS id_kind,
       CASE WHEN contains(id, '-') THEN '2' ELSE '1' END AS party_kind FROM i WHERE id IS NOT NULL
""")
def party_docs_hyphen(spark, sf):
    """Ids keep their hyphen, which marks a company; orders without one are parked."""
    p = F.get("d.Terceros", F.lit(0))
    return _built(spark, sf, replace(CFG, id_rule="hyphen", park_without_id=True)).select(
        "order_id", p["F200_ID"].alias("party"), p["F200_ID_TIPO_IDENT"].alias("id_kind"), p["F200_IND_TIPO_TERCERO"].alias("party_kind")
    )


@query(f"""
WITH nations AS ({NATIONS_SQL}), people AS ({PEOPLE_SQL}),
a AS (SELECT o_orderkey, upper(address1) AS a1, upper(COALESCE(address2, '')) AS a2 FROM orders JOIN people ON o_custkey = c_custkey
      WHERE COALESCE(NULLIF(trim(billing_company), ''), NULLIF(trim(company), '')) IS NOT NULL)
SELECT '#' || o_orderkey AS order_id, left(a1, 39) AS line1, CASE WHEN length(a1) > 39 THEN substr(a1, 40, 39) ELSE left(a2, 39) END AS line2 FROM a
""")
def party_docs_split_address(spark, sf):
    """Addresses longer than 39 characters go on in the second line."""
    schema = "Terceros array<struct<F015_DIRECCION1:string,F015_DIRECCION2:string>>"
    p = F.get("d.Terceros", F.lit(0))
    return _built(spark, sf, replace(CFG, address_overflow=39), schema=schema).select(
        "order_id", p["F015_DIRECCION1"].alias("line1"), p["F015_DIRECCION2"].alias("line2")
    )


@query(f"""
WITH nations AS ({NATIONS_SQL}), people AS ({PEOPLE_SQL}), {PAID_SQL},
a AS (SELECT o_orderkey FROM orders JOIN people ON o_custkey = c_custkey
      WHERE COALESCE(NULLIF(trim(billing_company), ''), NULLIF(trim(company), '')) IS NOT NULL)
SELECT '#' || o_orderkey AS order_id, {CLIENT_TYPE_SQL} AS client_type, '003/0101,004/0200' AS classes
FROM a LEFT JOIN f ON user_id = o_orderkey AND rn = 1
""")
def party_docs_client_type(spark, sf):
    """The gateway of the first successful payment decides the client type; customers carry two classes."""
    schema = "Clientes array<struct<F201_ID_TIPO_CLI:string>>, Criterios_Clientes array<struct<F207_ID_PLAN_CRITERIOS:string,F207_ID_CRITERIO_MAYOR:string>>"
    cfg = replace(CFG, classes=(ClassRow("003", "0101"), ClassRow("004", "0200")))
    payments = successful_payments(payment_documents(spark, sf), ["event_id"])
    classes = F.transform("d.Criterios_Clientes", lambda x: F.concat_ws("/", x["F207_ID_PLAN_CRITERIOS"], x["F207_ID_CRITERIO_MAYOR"]))
    return _built(spark, sf, cfg, payments, schema).select(
        "order_id", F.get("d.Clientes", F.lit(0))["F201_ID_TIPO_CLI"].alias("client_type"), F.array_join(classes, ",").alias("classes")
    )


PROFILE_DOC = (
    "Terceros array<struct<F200_ID:string,F200_ID_TIPO_IDENT:string,F200_IND_TIPO_TERCERO:string,F200_RAZON_SOCIAL:string,F200_APELLIDO1:string,"
    "F200_APELLIDO2:string,F015_EMAIL:string,F015_ID_DEPTO:string,F015_ID_CIUDAD:string,F200_ID_CIIU:string>>, "
    "ImpuestosyRetenciones array<struct<F_TIPO_REG:string>>, EntDinamicaCliente array<struct<f201_id_tercero:string>>"
)


@query(f"""
WITH nations AS ({NATIONS_SQL}), people AS ({PEOPLE_SQL}), lines AS ({LINES_SQL}), docs AS ({PARTS_SQL})
SELECT order_name AS order_id, CASE WHEN c_custkey % 4 = 0 THEN '9' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') ELSE lpad(CAST(c_custkey AS VARCHAR), 8, '1') END AS party,
       CASE WHEN c_custkey % 4 = 0 THEN 'N' WHEN c_custkey % 3 = 1 THEN 'P' ELSE 'C' END AS id_kind, CASE WHEN c_custkey % 4 = 0 THEN '2' ELSE '1' END AS party_kind,
       CASE WHEN c_custkey % 4 = 0 THEN upper(last_name || ' ' || first_name) ELSE '' END AS legal_name,
       left(split_part(trim(upper(last_name)), ' ', 1), 15) AS surname1,
       CASE WHEN strpos(trim(last_name), ' ') > 0 THEN trim(left(ltrim(substr(trim(upper(last_name)), strpos(trim(last_name), ' '))), 15)) ELSE '' END AS surname2,
       COALESCE(email, 'SINCORREO@EXAMPLE.COM') AS email, left(lpad(CAST(c_custkey AS VARCHAR), 5, '0'), 2) || '-' || substr(lpad(CAST(c_custkey AS VARCHAR), 5, '0'), 3, 5) AS place,
       CASE WHEN c_custkey % 4 = 0 THEN '9999' ELSE '0081' END AS activity, CASE WHEN o_orderkey % 6 = 0 THEN 2 ELSE 3 END AS taxes, 1 AS mails
FROM docs JOIN people ON o_custkey = c_custkey WHERE part = 1 AND o_orderkey IN (SELECT l_orderkey FROM lineitem)
""")
def profile_party_docs(spark, sf):
    taxes = (TaxRow("46", "1", "1", True), TaxRow("47", "1"), TaxRow("47", "5"))
    built = pt.build_profile_party_docs(profile_orders(spark, sf).where("part = 1"), MinorUnitOrderConfig(), taxes, CFG.entities, run_ts())
    doc = built.select("idOrden", F.from_json("json", PROFILE_DOC).alias("d"))
    p = F.get("d.Terceros", F.lit(0))
    return doc.select(
        F.col("idOrden").alias("order_id"), p["F200_ID"].alias("party"), p["F200_ID_TIPO_IDENT"].alias("id_kind"), p["F200_IND_TIPO_TERCERO"].alias("party_kind"),
        p["F200_RAZON_SOCIAL"].alias("legal_name"), p["F200_APELLIDO1"].alias("surname1"), p["F200_APELLIDO2"].alias("surname2"), p["F015_EMAIL"].alias("email"),
        F.concat(p["F015_ID_DEPTO"], F.lit("-"), p["F015_ID_CIUDAD"]).alias("place"), p["F200_ID_CIIU"].alias("activity"),
        F.size("d.ImpuestosyRetenciones").alias("taxes"), F.size("d.EntDinamicaCliente").alias("mails"),
    )


@query(f"""
WITH nations AS ({NATIONS_SQL}), people AS ({PEOPLE_SQL}), lines AS ({LINES_SQL}), docs AS ({PARTS_SQL}),
i AS (SELECT order_name, o_orderkey, people.*, COALESCE(regexp_matches(company, '^[789]') AND length(company) >= 10, false) AS firm,
             regexp_replace(company, '[^0-9]', '', 'g') AS id FROM docs JOIN people ON o_custkey = c_custkey WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))
SELECT order_name AS order_id, CASE WHEN firm THEN '2' ELSE '1' END AS party_kind, CASE WHEN firm THEN left(id, 9) ELSE id END AS party_id,
       left(upper(replace(name, '&', '')), 50) AS full_name, replace(phone, '+57', '') AS phone,
       CASE WHEN o_orderkey % 2 = 0 THEN COALESCE(email, 'noemail@example.com') ELSE COALESCE(email, '') END AS email,
       {fold_sql('city')} AS city, {fold_sql('province')} AS state, {fold_sql('country')} AS country FROM i
""")
def marketplace_party(spark, sf):
    cols = ["order_id", "party_kind", "party_id", "full_name", "phone", "email", "city", "state", "country"]
    return pt.marketplace_party(marketplace_orders(spark, sf)).select(*cols)


@query(f"""
WITH nations AS ({NATIONS_SQL}), people AS ({PEOPLE_SQL}),
i AS (SELECT c_custkey, CASE WHEN regexp_replace(COALESCE(billing_company, ''), '[^0-9]', '', 'g') <> '' THEN regexp_replace(billing_company, '[^0-9-]', '', 'g')
             WHEN regexp_replace(COALESCE(company, ''), '[^0-9]', '', 'g') <> '' THEN regexp_replace(company, '[^0-9-]', '', 'g') END AS id FROM people)
SELECT c_custkey, id AS party_id, COALESCE(id, '222222222222') AS with_fallback, CASE WHEN id IS NULL THEN 'no_id' ELSE 'ok' END AS outcome,
       CASE WHEN id IS NULL THEN 'parked' ELSE 'ok' END AS parked_outcome FROM i
""")
def party_id_policy(spark, sf):
    b, c = F.col("billing_company"), F.col("company")
    plain = party_id(b, c)
    return people(spark, sf).select(
        "c_custkey", plain.alias("party_id"), party_id(b, c, "222222222222").alias("with_fallback"), id_outcome(plain).alias("outcome"),
        id_outcome(plain, True).alias("parked_outcome"),
    )


@query(f"""
WITH {DOCS_SQL}
SELECT order_name AS order_id, CASE WHEN o_orderkey % 10 = 0 THEN 'EXT' ELSE 'NAC' END AS client_type, CASE WHEN o_orderkey % 10 = 0 THEN '002' ELSE '001' END AS price_list,
       CASE WHEN o_orderkey % 10 = 0 THEN '11' ELSE '10' END AS residency, CASE WHEN o_orderkey % 10 = 0 THEN '0' ELSE '1' END AS tax_value FROM docs
""")
def by_currency(spark, sf):
    attributes = pt.by_currency(F.col("doc.currency"), CurrencyRule())
    return parsed_orders(spark, sf).select("order_id", *[c.alias(n) for n, c in attributes.items()])


MARKETPLACE_PARTY = (
    "Terceros array<struct<F200_ID:string,F200_ID_TIPO_IDENT:string,F015_CONTACTO:string,F015_ID_PAIS:string,F015_ID_DEPTO:string,F015_ID_CIUDAD:string>>, "
    "Clientes array<struct<F201_ID_VENDEDOR:string>>, CriteriosClientes array<struct<F207_ID_CRITERIO_MAYOR:string>>, "
    "ImptosReten array<struct<F_TIPO_REG:string>>, EntidadTercero array<struct<f753_id_maestro_detalle:string>>"
)


@query(f"""
WITH nations AS ({NATIONS_SQL}), places AS ({PLACES_SQL}), people AS ({PEOPLE_SQL}), lines AS ({LINES_SQL}), docs AS ({PARTS_SQL}),
p AS (SELECT {fold_sql('city_name')} AS city, {fold_sql('state_name')} AS state, country_id || state_id || city_id AS code FROM places),
n AS (SELECT city, count(*) AS n, MIN(code) AS hit FROM p GROUP BY 1), b AS (SELECT city, state, MIN(code) AS hit FROM p GROUP BY 1, 2),
i AS (SELECT people.*, COALESCE(regexp_matches(company, '^[789]') AND length(company) >= 10, false) AS firm, {fold_sql('city')} AS t, {fold_sql('province')} AS s FROM people),
w AS (SELECT i.*, COALESCE(CASE WHEN COALESCE(n.n, 0) >= 2 THEN b.hit WHEN n.n = 1 THEN n.hit ELSE m.hit END, '16976999') AS place
      FROM i LEFT JOIN n ON n.city = t LEFT JOIN b ON b.city = t AND b.state = s LEFT JOIN n AS m ON m.city = s)
SELECT order_name AS order_id, CASE WHEN firm THEN left(regexp_replace(company, '[^0-9]', '', 'g'), 9) ELSE regexp_replace(company, '[^0-9]', '', 'g') END AS party,
       CASE WHEN firm THEN 'N' ELSE 'C' END AS id_kind, CASE WHEN firm THEN '' ELSE left(upper(replace(name, '&', '')), 50) END AS contact, place,
       CASE WHEN o_orderkey % 2 = 0 THEN '0100' END AS seller, CASE WHEN o_orderkey % 2 = 0 THEN '101' END AS class, 2 AS taxes, CASE WHEN firm THEN '48' ELSE '49' END AS regime
FROM docs JOIN w ON o_custkey = c_custkey WHERE part = 1 AND o_orderkey IN (SELECT l_orderkey FROM lineitem)
""")
def marketplace_party_docs(spark, sf):
    built = pt.build_marketplace_party_docs(marketplace_orders(spark, sf, "origin", "Client").where("part = 1"), places(spark, sf), MarketplaceConfig(), run_ts())
    doc = built.select("idOrden", F.from_json("json", MARKETPLACE_PARTY).alias("d"))
    p = F.get("d.Terceros", F.lit(0))
    return doc.select(
        F.col("idOrden").alias("order_id"), p["F200_ID"].alias("party"), p["F200_ID_TIPO_IDENT"].alias("id_kind"), p["F015_CONTACTO"].alias("contact"),
        F.concat(p["F015_ID_PAIS"], p["F015_ID_DEPTO"], p["F015_ID_CIUDAD"]).alias("place"), F.get("d.Clientes", F.lit(0))["F201_ID_VENDEDOR"].alias("seller"),
        F.get("d.CriteriosClientes", F.lit(0))["F207_ID_CRITERIO_MAYOR"].alias("class"), F.size("d.ImptosReten").alias("taxes"),
        F.get("d.EntidadTercero", F.lit(0))["f753_id_maestro_detalle"].alias("regime"),
    )
