"""Document schemas, result contract and record layouts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ADDRESS = (
    "name string, first_name string, last_name string, company string, address1 string, "
    "address2 string, phone string, country string, province string, city string"
)

# Shop dialect with billing, shipping and customer addresses and discount allocations.
ORDER_A = (
    "name string, id string, order_number string, created_at string, updated_at string, "
    "currency string, presentment_currency string, "
    f"customer struct<email: string, created_at: string, default_address: struct<{_ADDRESS}>>, "
    f"billing_address struct<{_ADDRESS}>, shipping_address struct<{_ADDRESS}>, "
    "line_items array<struct<id: string, sku: string, quantity: string, price: string, "
    "discount_allocations: array<struct<amount: string>>>>, "
    "shipping_lines array<struct<price: string, is_removed: string, "
    "discount_allocations: array<struct<amount: string>>>>, "
    "discount_applications array<struct<type: string, value: string, target_type: string, value_type: string>>, "
    "payment_gateway_names array<string>"
)

# Shop dialect with profile data, logistics and prices in minor units.
ORDER_B = (
    "orderId string, sequence string, origin string, "
    "clientProfileData struct<document: string, corporateDocument: string, documentType: string, "
    "firstName: string, lastName: string, phone: string, email: string>, "
    "shippingData struct<address: struct<street: string, complement: string, neighborhood: string, "
    "postalCode: string>, logisticsInfo: array<struct<deliveryCompany: string, selectedSla: string, "
    "slas: array<struct<id: string, deliveryChannel: string, pickupStoreInfo: struct<friendlyName: string>>>>>>, "
    "items array<struct<id: string, uniqueId: string, ean: string, refId: string, quantity: string, "
    "price: string, sellingPrice: string>>, "
    "totals array<struct<id: string, value: string>>, sellers array<struct<name: string>>, "
    "paymentData struct<transactions: array<struct<payments: array<struct<id: string, paymentSystemName: string>>>>>, "
    "ratesAndBenefitsData struct<rateAndBenefitsIdentifiers: array<struct<name: string>>>"
)

# Marketplace dialect with checkout items and a named warehouse.
ORDER_C = (
    "origin string, createdAt string, Warehouse struct<name: string>, "
    "CheckoutLinks array<struct<externalOrderNumber: string>>, "
    "Client struct<taxId: string, type: string, fullName: string, name: string, lastName: string, "
    "email: string, phoneNumber: string, BillingAddresses: array<struct<address_1: string, address_2: string, "
    "city: string, state: string, country: string>>>, "
    "CheckoutItems array<struct<count: string, gross: string, ProductVersion: struct<_id: string, code: string, "
    "Product: struct<name: string>>, CheckoutItemDiscounts: array<struct<discount: string>>>>"
)



def fields(schema: str) -> list[str]:
    """Top-level fields of a document schema, each with its type."""
    depth, field, found = 0, "", []
    for ch in schema + ",":
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            found.append(field.strip())
            field = ""
        else:
            field += ch
    return found


def only(schema: str, *names: str) -> str:
    """The named top-level fields of a document schema: a job parses what it reads and nothing else."""
    return ", ".join(f for f in fields(schema) if f.split()[0] in names)


# The columns of the result every document job hands to the integrator.
DOCUMENT_SCHEMA = "idDocumento int, indicaParalelismo boolean, descripcion string, idOrden string, json string"

# Field names and widths of the receiving party and customer records.
PARTY_LAYOUT = {
    "F200_ID": 15,
    "F200_NIT": 25,
    "F200_ID_TIPO_IDENT": 1,
    "F200_IND_TIPO_TERCERO": 1,
    "F200_RAZON_SOCIAL": 100,
    "F200_APELLIDO1": 29,
    "F200_APELLIDO2": 29,
    "F200_NOMBRES": 40,
    "F200_NOMBRE_EST": 50,
    "F015_CONTACTO": 50,
    "F015_DIRECCION1": 40,
    "F015_DIRECCION2": 40,
    "F015_ID_PAIS": 3,
    "F015_ID_DEPTO": 2,
    "F015_ID_CIUDAD": 3,
    "F015_TELEFONO": 20,
    "F015_EMAIL": 255,
    "F200_FECHA_NACIMIENTO": 8,
    "F200_ID_CIIU": 4,
    "F015_CELULAR": 50,
}
CUSTOMER_LAYOUT = {
    "F201_ID_TERCERO": 15,
    "F201_ID_SUCURSAL": 3,
    "F201_DESCRIPCION_SUCURSAL": 40,
    "F201_ID_MONEDA": 3,
    "F201_ID_LISTA_PRECIO": 3,
    "F015_CONTACTO": 50,
    "F015_DIRECCION1": 40,
    "F015_DIRECCION2": 40,
    "F015_ID_PAIS": 3,
    "F015_ID_DEPTO": 2,
    "F015_ID_CIUDAD": 3,
    "F015_TELEFONO": 20,
    "F015_EMAIL": 255,
    "F201_FECHA_INGRESO": 8,
    "f015_celular": 50,
}


def fit(values: dict[str, Column], layout: dict[str, int]) -> Column:
    """A record struct in layout order, every field cut to its width."""
    return F.struct(*[F.substring(values[f].cast("string"), 1, n).alias(f) for f, n in layout.items()])


def document_text(sections: dict[str, Column], keep_nulls: bool = True) -> Column:
    """One document: each section an array of records."""
    options = {"ignoreNullFields": "false" if keep_nulls else "true"}
    return F.to_json(F.struct(*[c.alias(n) for n, c in sections.items()]), options)


def contract(order_id: Column, json: Column, cfg) -> list[Column]:
    return [
        F.lit(cfg.document_id).cast("int").alias("idDocumento"),
        F.lit(cfg.parallel).cast("boolean").alias("indicaParalelismo"),
        F.lit(cfg.description).alias("descripcion"),
        order_id.cast("string").alias("idOrden"),
        json.alias("json"),
    ]
