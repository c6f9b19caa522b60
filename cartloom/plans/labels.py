"""Shipping label requests for cash-on-delivery orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.config import LABEL_EMPTY, LABEL_FIELDS, PARCEL_FIELDS, LabelConfig
from cartloom.functions import text as tx
from cartloom.operators.relational import contains_join

PRINTED = "IMPRESO"

# Envelope of the carrier's request around its body, without and with typed fields.
ENVELOPE_OPEN = (
    '<soapenv:Envelope xmlns:soapenv="http://schemas.xmlsoap.org/soap/envelope/"><soapenv:Header/><soapenv:Body>'
)
TYPED_OPEN = (
    '<soapenv:Envelope xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xmlns:xsd="http://www.w3.org/2001/XMLSchema" '
    'xmlns:soapenv="http://schemas.xmlsoap.org/soap/envelope/"><soapenv:Header/><soapenv:Body>'
)
ENVELOPE_CLOSE = "</soapenv:Body></soapenv:Envelope>"


def label_fields(c: dict[str, Column], sender: dict[str, str], cfg: LabelConfig) -> dict[str, Column]:
    """Request fields by name; what nobody gives is empty."""
    known = {
        **{k: F.lit(v) for k, v in sender.items()},
        "nit_destinatario": c["party_id"], "div_destinatario": F.lit(cfg.division), "nombre_destinatario": c["name"],
        "direccion_destinatario": c["address"], "ciudad_destinatario": c["city"], "telefono_destinatario": tx.clean_phone(c["phone"]),
        "valor_declarado": F.lit(cfg.declared_value), "codigo_cuenta": F.lit(cfg.account), "codigo_producto": F.lit(cfg.product),
        "nivel_servicio": F.lit(cfg.service), "contenido": F.lit(cfg.content), "referencia": c["order_id"],
        "observaciones": c["remarks"], "estado": F.lit(PRINTED),
    }
    return {name: known.get(name, F.lit("")) for name in LABEL_FIELDS}


def plain_body(fields: dict[str, Column], cfg: LabelConfig) -> Column:
    """Fields as plain elements; ``to_xml`` escapes every value."""
    parcel = F.struct(*[F.lit(v).alias(k) for k, v in zip(PARCEL_FIELDS, cfg.parcel)])
    body = F.struct(*[v.alias(k) for k, v in fields.items()], F.struct(parcel.alias("item")).alias("detalle"))
    return F.to_xml(body, {"rowTag": "p"})


def typed_body(fields: dict[str, Column], cfg: LabelConfig) -> Column:
    """Fields with their types. ``to_xml`` cannot write prefixed attributes, so elements are joined from escaped values."""

    def element(name: str, kind: str, value: Column) -> Column:
        return F.concat(F.lit(f'<{name} xsi:type="xsd:{kind}">'), tx.xml_text(value), F.lit(f"</{name}>"))

    item = [element(k, kind, F.lit(v)) for (k, kind), v in zip(PARCEL_FIELDS.items(), cfg.parcel)]
    return F.concat(
        F.lit("<p>"), *[element(k, kind, fields[k]) for k, kind in LABEL_FIELDS.items()], F.lit("<detalle><item>"), *item,
        F.lit("</item></detalle>"), *[F.lit(f"<{k}/>") for k in LABEL_EMPTY], F.lit("</p>"),
    )


def label_requests(
    orders: DataFrame, invoices: DataFrame, sender: dict[str, str], cfg: LabelConfig = LabelConfig()
) -> tuple[DataFrame, DataFrame]:
    """Label requests of cash-on-delivery orders with an invoice, and the orders that skip ahead.

    Both take orders of the label state with attempts left; a request is made once, so orders that carry the label endpoint
    already are left out. An invoice belongs to the order whose id occurs in its notes.
    """
    due = orders.where((F.col("state") == cfg.state) & (F.col("attempts") <= cfg.max_attempts))
    fresh = F.coalesce(F.col("endpoint"), F.lit("")) != cfg.endpoint
    cash = due.where((F.col("delivery") == cfg.delivery) & fresh)
    others = due.where(F.col("delivery") != cfg.delivery)
    noted = contains_join(invoices, cash.select("order_id"), "notes", "invoice_id", "order_id")
    rows = cash.join(noted.select("order_id", "invoice_number"), "order_id")
    remarks = tx.clip(
        F.concat(F.lit("Entregar a: "), F.col("name"), F.lit(" Factura: "), F.col("invoice_number")), cfg.remarks_width
    )
    fields = {n: F.col(n) for n in ("order_id", "party_id", "name", "address", "city", "phone")} | {"remarks": remarks}
    fields = label_fields(fields, sender, cfg)
    typed = cfg.layout == "typed"
    body = typed_body(fields, cfg) if typed else plain_body(fields, cfg)
    xml = F.concat(F.lit(TYPED_OPEN if typed else ENVELOPE_OPEN), body, F.lit(ENVELOPE_CLOSE))
    skipped = others.withColumns({"state": F.lit(cfg.skip_to), "attempts": F.lit(0)})
    return rows.select("order_id", "invoice_number", xml.alias("request")), skipped
