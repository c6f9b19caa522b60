"""Settings of the jobs. Plan-time choices (modes, sources, defaults) live here."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class LocationDefaults:
    country: str = "169"
    state: str = "05"
    city: str = "001"


@dataclass(frozen=True)
class TaxRow:
    kind: str = "46"
    tax_class: str = "1"
    value: str = "1"
    # Left out for parties of a tax-exempt region.
    skip_if_exempt: bool = False


@dataclass(frozen=True)
class EntityRow:
    group: str
    entity: str
    attribute: str
    master: str
    detail: str


@dataclass(frozen=True)
class ClassRow:
    """A customer's class: plan and criterion."""

    plan: str
    criterion: str


@dataclass(frozen=True)
class CurrencyRule:
    """Party attributes for orders in the foreign currency, and for all others."""

    foreign: str = "USD"
    client_type: tuple[str, str] = ("EXT", "NAC")
    price_list: tuple[str, str] = ("002", "001")
    residency: tuple[str, str] = ("11", "10")
    tax_value: tuple[str, str] = ("0", "1")


@dataclass(frozen=True)
class PartyConfig:
    document_id: int = 200000
    description: str = "Ecommerce_Terceros_Clientes"
    parallel: bool = True
    branch: str = "001"
    price_list: str = "001"
    currency: str = "COP"
    # Party fields from: 1 customer, 2 billing, 3 customer then billing, 4 billing then customer.
    client_origin: int = 4
    # Address from: 1 customer, 2 billing, 3 shipping.
    location_origin: int = 1
    defaults: LocationDefaults = LocationDefaults()
    id_kind: str = "C"
    party_kind: str = "1"
    activity: str = "0081"
    # Orders without an id: move on to the next state (True) or count an attempt (False).
    pass_without_id: bool = False
    # Section names of the receiving connector: party, customer, taxes, entities.
    sections: tuple[str, str, str, str] = ("Terceros", "Clientes", "ImptosyReten", "EntDinamicaTercero")
    # Client type, price list, residency and tax value by order currency, where they differ.
    by_currency: CurrencyRule | None = None
    fallback_id: str | None = None
    # "prefix": digits only, long numbers from 7 up are companies; "hyphen": digits and hyphens, a hyphen marks a company.
    id_rule: str = "prefix"
    # Orders without an id: never tried again (True) or tried again (False).
    park_without_id: bool = False
    # Characters of the first address line; what is longer goes on in the second. None: both lines are cut at 40.
    address_overflow: int | None = None
    # Client type of orders without a successful payment, where payments decide it.
    client_type: str = "C001"
    taxes: tuple[TaxRow, ...] = (TaxRow(),)
    entities: tuple[EntityRow, ...] = ()
    # Classes of every customer and the section they go to; no section without classes.
    classes: tuple[ClassRow, ...] = ()
    class_section: str = "Criterios_Clientes"


# Payment gateway texts, the payment codes they map to, and their priority.
PAYMENT_CODES = {
    "Sistecredito": "C005",
    "Addi": "C004",
    "Wompi": "C009",
    "Mercado Pago": "C008",
    "MercadoPago": "C008",
    "gift": "C006",
}
PAYMENT_PRIORITY = {
    "Sistecredito": 1,
    "Addi Payment": 2,
    "Wompi": 3,
    "Mercado": 4,
    "gift_card": 5,
}
# Client type by the gateway of the successful transaction.
CLIENT_TYPES = {
    "Addi Payment": "C004",
    "cash": "C001",
    "manual": "C001",
    "Checkout Mercado Pago": "C008",
    "Pago TC MercadoPago": "C008",
    "Pago TD MercadoPago": "C008",
    "gift_card": "C006",
    "Sistecredito": "C005",
    "Wompi": "C009",
}
# ERP warehouse by the shop's warehouse name.
WAREHOUSE_CODES = {
    "Bodega Ingram": "01",
    "Bodega Online": "01",
    "FULL": "04",
    "Bodega Bogota": "02",
    "FULL FALABELLA": "08",
    "FULL ML BOGOTA": "11",
    "FULL ML TIENDA OFICIAL": "06",
}
# Origins whose order numbers carry a prefix, and brand marks in references.
PREFIXED_ORIGINS = ["mercadolibre"]
BRAND_MARKS = {"HP": "#", "APPLE": "/"}
# Marketplace by the first letters of the order id.
MARKETPLACES = {"MLC": ("Mercado Libre", "25"), "GVL": ("AGAVAL", "26")}
DEFAULT_REASON = "13"
EXEMPT_BENEFIT = "Impuesto en San Andres"
TAXED_GROUP = "0001"
# Error log texts and the report each one belongs to.
ERROR_TEXTS = {
    "missing_item": "Movto Inventario: El item - extension no existe.",
    "no_stock": "Movto Inventario: Item sin cantidad disponible",
    "missing_contact": "Falta el nombre del contacto",
    "balance_mismatch": "El valor de la cartera debe ser igual al valor de las CxC",
}


@dataclass(frozen=True)
class OrderConfig:
    document_id: int = 228557
    description: str = "PEDIDOS_INTEGRACION"
    parallel: bool = False
    default_party: str = "22222222"
    item_unit: str = "PAR"
    freight_unit: str = "UND"
    freight_reference: str = "FLETES NACIONAL WEB"
    # Section names of the receiving connector: header, lines, discounts.
    sections: tuple[str, str, str] = ("Pedidos", "Movto_Pedidos_comercial", "Descuentos")
    # Freight reference and note by shipping price, in place of the single reference.
    freight_by_price: dict = field(default_factory=dict)
    # Order day: the day of the "run", or the day the shop "updated" the order.
    day_from: str = "run"
    drop_leading_zero: bool = False
    # Which payment wins when an order carries several: "first" by priority, or "last".
    payment_pick: str = "first"
    payment_codes: dict = field(default_factory=lambda: dict(PAYMENT_CODES))
    payment_priority: dict = field(default_factory=lambda: dict(PAYMENT_PRIORITY))
    # Whole currency units in the record, as the receiving fields have no decimals.
    quantity_type: str = "decimal(18,0)"
    price_type: str = "decimal(18,0)"
    discount_type: str = "decimal(18,0)"


@dataclass(frozen=True)
class MarketplaceConfig:
    document_id: int = 225805
    description: str = "PedidosDesc"
    parallel: bool = False
    branch: str = "002"
    currency: str = "COP"
    price_list: str = "090"
    default_email: str = "noemail@example.com"
    plan: str = "001"
    defaults: LocationDefaults = LocationDefaults("169", "76", "999")


# Seller and classification of the marketplace an order comes from.
ORIGIN_SELLERS = {"shopify": "9999", "fcom": "0102", "mercadolibre": "0100"}
ORIGIN_CLASSES = {"shopify": "107", "fcom": "102", "mercadolibre": "101"}


@dataclass(frozen=True)
class MinorUnitOrderConfig:
    document_id: int = 205744
    description: str = "PEDIDOS_INT_ECOMM"
    parallel: bool = False
    centre: str = "147"
    document_kind: str = "EPV"
    warehouse: str = "BV147"
    store_prefix: str = "01"
    seller_party: str = "900000000"
    payment_terms: str = "000"
    courier: str = "Coordinadora"
    tax_key: str = "IV02"
    default_email: str = "SINCORREO@EXAMPLE.COM"


@dataclass(frozen=True)
class LabelConfig:
    """Which orders get a shipping label, what the parcel is declared as, and how the request is laid out."""

    # Orders of this state with attempts left that the endpoint has not labelled yet; others of the state skip ahead.
    endpoint: str = "labels"
    state: int = 7
    skip_to: int = 8
    max_attempts: int = 3
    delivery: str = "Contra-entrega"
    # "plain": field names only; "typed": every field with its type, and the fields the second carrier account asks for.
    layout: str = "plain"
    content: str = ""
    declared_value: int = 34000
    account: int = 1
    product: int = 0
    service: str = "22"
    division: str = "01"
    remarks_width: int = 85
    # ubl, height, width, length, weight, units
    parcel: tuple[int, int, int, int, int, int] = (0, 1, 50, 50, 5, 1)


# Fields of the carrier's label request in its order, with their types.
LABEL_FIELDS = {
    "codigo_remision": "string",
    "fecha": "string",
    "id_cliente": "int",
    "id_remitente": "int",
    "nombre_remitente": "string",
    "direccion_remitente": "string",
    "telefono_remitente": "string",
    "ciudad_remitente": "string",
    "nit_destinatario": "string",
    "div_destinatario": "string",
    "nombre_destinatario": "string",
    "direccion_destinatario": "string",
    "ciudad_destinatario": "string",
    "telefono_destinatario": "string",
    "valor_declarado": "float",
    "codigo_cuenta": "int",
    "codigo_producto": "int",
    "nivel_servicio": "int",
    "contenido": "string",
    "referencia": "string",
    "observaciones": "string",
    "estado": "string",
}
# Parcel fields with their types, and the empty fields that end the typed request.
PARCEL_FIELDS = {
    "ubl": "int",
    "alto": "float",
    "ancho": "float",
    "largo": "float",
    "peso": "float",
    "unidades": "int",
}
LABEL_EMPTY = (
    "cuenta_contable", "centro_costos", "recaudos", "margen_izquierdo", "margen_superior", "id_rotulo", "formato_impresion",
    "atributo1_nombre", "atributo1_valor", "notificaciones", "atributos_retorno", "nro_doc_radicados", "nro_sobre",
)
