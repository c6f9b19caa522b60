"""Party documents: party, customer, taxes and entity sections from shop orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.config import (
    CLIENT_TYPES, EXEMPT_BENEFIT, ORIGIN_CLASSES, ORIGIN_SELLERS, ClassRow, CurrencyRule, EntityRow, MarketplaceConfig, MinorUnitOrderConfig,
    PartyConfig, TaxRow,
)
from cartloom.functions import codes as cd
from cartloom.functions import text as tx
from cartloom.operators.relational import lookup_by_ambiguity
from cartloom.plans.places import CODES, resolve_location
from cartloom.plans.queue import id_outcome, party_id
from cartloom.sources.schemas import CUSTOMER_LAYOUT, PARTY_LAYOUT, contract, document_text, fit
from cartloom.sources.tables import store_rows


def address(doc: Column, origin: int) -> Column:
    """Address section: 1 customer, 2 billing, 3 shipping."""
    return {
        1: doc["customer"]["default_address"], 2: doc["billing_address"], 3: doc["shipping_address"],
    }[origin]


def pick(doc: Column, name: str, origin: int) -> Column:
    """Customer or billing field by source priority."""
    return cd.by_origin(origin, doc["customer"]["default_address"][name], doc["billing_address"][name])


def by_currency(currency: Column, rule: CurrencyRule) -> dict[str, Column]:
    """Client type, price list, residency and tax value by order currency."""
    foreign = F.upper(currency) == rule.foreign
    pairs = {
        "client_type": rule.client_type, "price_list": rule.price_list,
        "residency": rule.residency, "tax_value": rule.tax_value,
    }
    return {n: F.when(foreign, F.lit(a)).otherwise(F.lit(b)) for n, (a, b) in pairs.items()}


def tax_rows(party: Column, branch: str, taxes: tuple[TaxRow, ...], exempt: Column | None = None) -> Column:
    """Tax and withholding records of one party as an array."""
    exempt = F.lit(False) if exempt is None else exempt
    rows = [
        F.struct(
            F.lit(t.kind).alias("F_TIPO_REG"), tx.clip(party, 15).alias("F_ID_TERCERO"),
            F.lit(branch).alias("F_ID_SUCURSAL"), F.lit(t.tax_class).alias("F_ID_CLASE"),
            F.lit(t.value).alias("F_ID_VALOR_TERCERO"), (F.lit(t.skip_if_exempt) & exempt).alias("__skip"),
        )
        for t in taxes
    ]
    if not rows:
        return F.array()
    names = ["F_TIPO_REG", "F_ID_TERCERO", "F_ID_SUCURSAL", "F_ID_CLASE", "F_ID_VALOR_TERCERO"]
    kept = F.filter(F.array(*rows), lambda r: ~r["__skip"])
    return F.transform(kept, lambda r: F.struct(*[r[n].alias(n) for n in names]))


def entity_rows(party: Column, entities: tuple[EntityRow, ...]) -> Column:
    rows = [
        F.struct(
            party.alias("f200_id"), F.lit(e.group).alias("f753_id_grupo_entidad"), F.lit(e.entity).alias("f753_id_entidad"),
            F.lit(e.attribute).alias("f753_id_atributo"), F.lit(e.master).alias("f753_id_maestro"),
            F.lit(e.detail).alias("f753_id_maestro_detalle"),
        )
        for e in entities
    ]
    return F.array(*rows)


def class_rows(party: Column, branch: str, classes: tuple[ClassRow, ...]) -> Column:
    """Classification records of one customer as an array."""
    rows = [
        F.struct(
            tx.clip(party, 15).alias("F207_ID_TERCERO"), F.lit(branch).alias("F207_ID_SUCURSAL"),
            F.lit(c.plan).alias("F207_ID_PLAN_CRITERIOS"), F.lit(c.criterion).alias("F207_ID_CRITERIO_MAYOR"),
        )
        for c in classes
    ]
    return F.array(*rows)


PARTY_FIELDS = [
    "shop_id", "country", "state", "city", "party_id", "legal_name", "given_names", "surnames", "address1", "address2", "phone", "email",
    "created", "currency", "status", "id_kind", "party_kind",
]


def party_fields(orders: DataFrame, places: DataFrame, cfg: PartyConfig) -> DataFrame:
    """One row per order with the resolved party fields; ``status`` is ok or no_id."""
    doc = F.col("doc")
    where = address(doc, cfg.location_origin)
    if cfg.id_rule == "hyphen":
        raw = party_id(doc["billing_address"]["company"], doc["customer"]["default_address"]["company"], cfg.fallback_id)
    else:
        raw = pick(doc, "company", cfg.client_origin)
        if cfg.fallback_id is not None:
            raw = F.coalesce(raw, F.lit(cfg.fallback_id))
    upper = {k: F.upper(F.coalesce(where[k], F.lit(""))) for k in ("address1", "address2")}
    if cfg.address_overflow is None:
        lines = {k: tx.clip(v, 40) for k, v in upper.items()}
    else:
        lines = {
            "address1": tx.address_line_1(upper["address1"], cfg.address_overflow),
            "address2": tx.address_line_2(upper["address1"], upper["address2"], cfg.address_overflow),
        }
    customer_first = 3
    flat = orders.withColumns(
        {
            "country": where["country"], "state": where["province"], "city": where["city"],
            "shop_id": doc["id"], "raw_id": raw, "party_id": raw if cfg.id_rule == "hyphen" else tx.digits_only(raw),
            "legal_name": F.upper(F.coalesce(pick(doc, "name", customer_first), F.lit(""))),
            "given_names": F.upper(F.coalesce(pick(doc, "first_name", customer_first), F.lit(""))),
            "surnames": F.upper(F.coalesce(pick(doc, "last_name", customer_first), F.lit(""))),
            **lines,
            "phone": tx.clean_phone(doc["customer"]["default_address"]["phone"]),
            "email": doc["customer"]["email"],
            "currency": doc["currency"],
            "created": F.replace(F.substring(doc["customer"]["created_at"], 1, 10), F.lit("-"), F.lit("")),
        }
    ).withColumn("status", id_outcome(F.col("raw_id"), cfg.park_without_id))
    kinds = flat.withColumn("id_kind", cd.id_kind(F.col("party_id"), cfg.id_kind, rule=cfg.id_rule)).withColumn(
        "party_kind", F.when(F.col("id_kind") == "N", F.lit("2")).otherwise(F.lit(cfg.party_kind))
    )
    flat_fields = kinds.select("order_id", F.col("doc.name").alias("order_name"), *PARTY_FIELDS)
    located = resolve_location(flat_fields, places, "country", "state", "city", cfg.defaults)
    return located.withColumn("surname1", tx.first_surname(F.col("surnames"))).withColumn(
        "surname2", tx.other_surnames(F.col("surnames"))
    )


def build_party_docs(orders: DataFrame, places: DataFrame, cfg: PartyConfig, payments: DataFrame | None = None) -> DataFrame:
    """Result rows for the integrator, one per order that has an identity.

    ``orders`` carries ``order_id`` and the parsed ``doc``. Apart from the place lookup the job is a map over rows. With
    ``payments`` (order_id as the shop knows it, gateway; one row an order) the gateway decides the client type.
    """
    c = F.col
    rows = party_fields(orders, places, cfg).where("status = 'ok'")
    if payments is not None:
        paid = payments.select(F.col("order_id").alias("__paid"), F.col("gateway").alias("__gateway"))
        rows = rows.join(paid, F.col("shop_id") == F.col("__paid"), "left")
    place = {"F015_ID_PAIS": c("country_id"), "F015_ID_DEPTO": c("state_id"), "F015_ID_CIUDAD": c("city_id")}
    contact = {
        "F015_CONTACTO": c("legal_name"), "F015_DIRECCION1": c("address1"), "F015_DIRECCION2": c("address2"),
        **place, "F015_TELEFONO": c("phone"), "F015_EMAIL": c("email"),
    }
    party = {
        "F200_ID": c("party_id"), "F200_NIT": c("party_id"), "F200_ID_TIPO_IDENT": c("id_kind"),
        "F200_IND_TIPO_TERCERO": c("party_kind"), "F200_RAZON_SOCIAL": c("legal_name"), "F200_APELLIDO1": c("surname1"),
        "F200_APELLIDO2": c("surname2"), "F200_NOMBRES": c("given_names"), "F200_NOMBRE_EST": c("legal_name"),
        **contact, "F200_FECHA_NACIMIENTO": c("created"), "F200_ID_CIIU": F.lit(cfg.activity), "F015_CELULAR": c("phone"),
    }
    price_list, taxes = F.lit(cfg.price_list), tax_rows(c("party_id"), cfg.branch, cfg.taxes)
    if cfg.by_currency is not None:
        rule = by_currency(c("currency"), cfg.by_currency)
        price_list = rule["price_list"]
        taxes = F.transform(taxes, lambda t: t.withField("F_ID_VALOR_TERCERO", rule["tax_value"]))
    customer = {
        "F201_ID_TERCERO": c("party_id"), "F201_ID_SUCURSAL": F.lit(cfg.branch), "F201_DESCRIPCION_SUCURSAL": c("legal_name"),
        "F201_ID_MONEDA": F.lit(cfg.currency), "F201_ID_LISTA_PRECIO": price_list,
        **contact, "F201_FECHA_INGRESO": c("created"), "f015_celular": c("phone"),
    }
    client = fit(customer, CUSTOMER_LAYOUT)
    if cfg.by_currency is not None:
        client = client.withField("F201_ID_TIPO_CLI", rule["client_type"])
    if payments is not None:
        client = client.withField("F201_ID_TIPO_CLI", cd.map_code(c("__gateway"), CLIENT_TYPES, cfg.client_type))
    parts = [F.array(fit(party, PARTY_LAYOUT)), F.array(client), taxes, entity_rows(c("party_id"), cfg.entities)]
    sections = dict(zip(cfg.sections, parts))
    if cfg.classes:
        sections[cfg.class_section] = class_rows(c("party_id"), cfg.branch, cfg.classes)
    return rows.select(*contract(c("order_name"), document_text(sections), cfg))


# --- profile dialect ---------------------------------------------------------


def has_benefit(doc: Column, name: str = EXEMPT_BENEFIT) -> Column:
    listed = F.coalesce(
        doc["ratesAndBenefitsData"]["rateAndBenefitsIdentifiers"], F.array().cast("array<struct<name:string>>")
    )
    return F.exists(listed, lambda b: b["name"] == name)


def profile_party_id(doc: Column) -> Column:
    profile = doc["clientProfileData"]
    own = F.coalesce(profile["document"], F.lit(""))
    return F.when(own == "", profile["corporateDocument"]).otherwise(profile["document"])


def build_profile_party_docs(
    orders: DataFrame, cfg: MinorUnitOrderConfig, taxes: tuple[TaxRow, ...], entities: tuple[EntityRow, ...], run_ts: Column
) -> DataFrame:
    """Party documents of the profile dialect: place codes come from the postal code."""
    doc = F.col("doc")
    profile, place = doc["clientProfileData"], doc["shippingData"]["address"]
    company = profile["corporateDocument"]
    is_person = F.coalesce(company, F.lit("")) == ""
    party = profile_party_id(doc)
    surnames = F.upper(profile["lastName"])
    phone = tx.clean_phone(profile["phone"])
    full = tx.join_text(profile["firstName"], F.lit(" "), profile["lastName"])
    postal = place["postalCode"]
    contact = [
        full.alias("F015_CONTACTO"), tx.clip(place["street"], 40).alias("F015_DIRECCION1"),
        tx.clip(place["complement"], 40).alias("F015_DIRECCION2"), tx.clip(place["neighborhood"], 40).alias("F015_DIRECCION3"),
        tx.clip(postal, 2).alias("F015_ID_DEPTO"), F.substring(postal, 3, 5).alias("F015_ID_CIUDAD"), phone.alias("F015_TELEFONO"),
    ]
    parties = F.struct(
        party.alias("F200_ID"), party.alias("F200_NIT"),
        cd.profile_id_kind(profile["documentType"], company).alias("F200_ID_TIPO_IDENT"),
        F.when(is_person, F.lit("1")).otherwise(F.lit("2")).alias("F200_IND_TIPO_TERCERO"),
        F.when(is_person, F.lit("")).otherwise(
            F.upper(tx.join_text(profile["lastName"], F.lit(" "), profile["firstName"]))
        ).alias("F200_RAZON_SOCIAL"),
        tx.clip(tx.first_surname(surnames), 15).alias("F200_APELLIDO1"),
        F.trim(tx.clip(tx.other_surnames(surnames), 15)).alias("F200_APELLIDO2"),
        profile["firstName"].alias("F200_NOMBRES"),
        *contact, tx.clean_email(profile["email"], cfg.default_email, 40).alias("F015_EMAIL"),
        tx.day_text(run_ts).alias("F200_FECHA_NACIMIENTO"),
        F.when(is_person, F.lit("0081")).otherwise(F.lit("9999")).alias("F200_ID_CIIU"), phone.alias("F015_CELULAR"),
    )
    customers = F.struct(
        party.alias("F201_ID_TERCERO"), F.lit("001").alias("F201_ID_SUCURSAL"), tx.clip(full, 40).alias("F201_DESCRIPCION_SUCURSAL"),
        *contact, tx.clip(profile["email"], 40).alias("F015_EMAIL"), tx.day_text(run_ts).alias("F201_FECHA_INGRESO"),
        phone.alias("F015_CELULAR"),
    )
    entity_mail = F.struct(
        party.alias("f201_id_tercero"), F.lit("001").alias("f201_id_sucursal"), tx.clip(profile["email"], 40).alias("f753_dato_texto")
    )
    json = document_text(
        {
            "Terceros": F.array(parties), "Clientes": F.array(customers),
            "ImpuestosyRetenciones": tax_rows(party, "001", taxes, has_benefit(doc)),
            "EntDinamicaTercero": entity_rows(party, entities), "EntDinamicaCliente": F.array(entity_mail),
        }
    )
    return orders.select(*contract(F.col("order_id"), json, cfg))


# --- marketplace dialect -----------------------------------------------------


def marketplace_party(orders: DataFrame) -> DataFrame:
    """Identity, contact and place texts of a marketplace order, named by what they hold."""
    client = F.col("doc")["Client"]
    bill = F.get(client["BillingAddresses"], F.lit(0))
    is_company = client["taxId"].rlike("^[789]") & (F.length(client["taxId"]) >= 10)
    name = F.replace(client["fullName"], F.lit("&"), F.lit(""))
    return orders.withColumns(
        {
            "party_kind": F.when(is_company, F.lit("2")).otherwise(F.lit("1")),
            "party_id": cd.company_id_9(tx.digits_only(client["taxId"]), is_company),
            "full_name": tx.clip(F.coalesce(F.upper(name), F.lit("")), 50),
            "given_names": F.coalesce(F.upper(F.replace(client["name"], F.lit("&"), F.lit(""))), F.lit("")),
            "surnames": F.coalesce(F.upper(F.replace(client["lastName"], F.lit("&"), F.lit(""))), F.lit("")),
            "address1": tx.clip(F.coalesce(F.upper(bill["address_1"]), F.lit("")), 40),
            "address2": tx.clip(F.coalesce(F.upper(bill["address_2"]), F.lit("")), 40),
            "origin": F.col("doc")["origin"],
            "phone": tx.clean_phone(F.replace(client["phoneNumber"], F.lit(" "), F.lit("")), "+57", "#X"),
            "email": F.when(
                F.col("doc")["origin"] == "mercadolibre", tx.clean_email(client["email"], "noemail@example.com")
            ).otherwise(tx.clean_email(client["email"])),
            "city": tx.fold(bill["city"]), "state": tx.fold(bill["state"]), "country": tx.fold(bill["country"]),
        }
    )


MARKETPLACE_FIELDS = [
    "party_kind", "party_id", "full_name", "given_names", "surnames", "address1", "address2", "origin", "phone", "email",
    "city", "state", "country",
]


def build_marketplace_party_docs(orders: DataFrame, places: DataFrame, cfg: MarketplaceConfig, run_ts: Column) -> DataFrame:
    """Party documents of marketplace orders; the place code depends on how often its name occurs."""
    known = places.select(
        tx.fold(F.col("city_name")).alias("city"), tx.fold(F.col("state_name")).alias("state"), *CODES
    )
    # Read twice below: for its distinct places and for its rows.
    flat = store_rows(marketplace_party(orders).select("order_id", *MARKETPLACE_FIELDS))
    rows = lookup_by_ambiguity(flat, known, "city", "state", CODES)
    c = F.col
    person = c("party_kind") == "1"
    codes = dict(zip(CODES, (cfg.defaults.country, cfg.defaults.state, cfg.defaults.city)))
    country, state, city = [F.coalesce(c(n), F.lit(d)) for n, d in codes.items()]

    def only_person(col: Column) -> Column:
        return F.when(person, col).otherwise(F.lit(""))

    today, named = tx.day_text(run_ts), F.when(person, c("full_name")).otherwise(tx.clip(c("given_names"), 50))
    contact = [
        named.alias("F015_CONTACTO"), c("address1").alias("F015_DIRECCION1"), c("address2").alias("F015_DIRECCION2"),
        country.alias("F015_ID_PAIS"), state.alias("F015_ID_DEPTO"), city.alias("F015_ID_CIUDAD"), c("phone").alias("F015_TELEFONO"),
        c("email").alias("F015_EMAIL"),
    ]
    party = F.struct(
        c("party_id").alias("F200_ID"), c("party_id").alias("F200_NIT"), F.when(person, F.lit("C")).otherwise(F.lit("N")).alias("F200_ID_TIPO_IDENT"),
        c("party_kind").alias("F200_IND_TIPO_TERCERO"), F.when(person, F.lit("")).otherwise(c("given_names")).alias("F200_RAZON_SOCIAL"),
        only_person(tx.clip(tx.first_surname(c("surnames")), 29)).alias("F200_APELLIDO1"),
        only_person(tx.clip(tx.other_surnames(c("surnames")), 29)).alias("F200_APELLIDO2"),
        only_person(tx.clip(c("given_names"), 40)).alias("F200_NOMBRES"), *contact, today.alias("F200_FECHA_NACIMIENTO"),
        c("phone").alias("F015_CELULAR"),
    )
    customer = F.struct(
        c("party_id").alias("F201_ID_TERCERO"), F.lit(cfg.branch).alias("F201_ID_SUCURSAL"), tx.clip(named, 40).alias("F201_DESCRIPCION_SUCURSAL"),
        F.lit(cfg.currency).alias("F201_ID_MONEDA"), cd.map_code(c("origin"), ORIGIN_SELLERS).alias("F201_ID_VENDEDOR"),
        F.lit(cfg.price_list).alias("F201_ID_LISTA_PRECIO"), *contact, today.alias("F201_FECHA_INGRESO"), c("phone").alias("f015_celular"),
    )
    classes = F.struct(
        c("party_id").alias("F207_ID_TERCERO"), F.lit(cfg.branch).alias("F207_ID_SUCURSAL"), F.lit(cfg.plan).alias("F207_ID_PLAN_CRITERIOS"),
        cd.map_code(c("origin"), ORIGIN_CLASSES).alias("F207_ID_CRITERIO_MAYOR"),
    )
    # Regime and tax detail differ between persons and companies.
    regime = [
        F.struct(
            c("party_id").alias("f200_id"), F.lit(e).alias("f753_id_entidad"), F.lit(a).alias("f753_id_atributo"),
            F.lit(m).alias("f753_id_maestro"), F.when(person, F.lit(p)).otherwise(F.lit(f)).alias("f753_id_maestro_detalle"),
        )
        for e, a, m, p, f in REGIME_ROWS
    ]
    json = document_text(
        {
            "Terceros": F.array(party), "Clientes": F.array(customer),
            "ImptosReten": tax_rows(c("party_id"), cfg.branch, (TaxRow("46"), TaxRow("47"))),
            "CriteriosClientes": F.array(classes), "EntidadTercero": F.array(*regime),
        }
    )
    return rows.select(*contract(c("order_id"), json, cfg))


# Regime and tax detail rows as (entity, attribute, master, person, company).
REGIME_ROWS = [
    ("EUNOECO017", "co017_codigo_regimen", "MUNOECO016", "49", "48"),
    ("EUNOECO031", "co031_detalle_tributario1", "MUNOECO035", "ZZ", "01"),
]
