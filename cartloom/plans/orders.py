"""Order documents: header, lines, freight, discounts, taxes and attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.config import (
    BRAND_MARKS, DEFAULT_REASON, MARKETPLACES, PREFIXED_ORIGINS, TAXED_GROUP, WAREHOUSE_CODES,
    MarketplaceConfig, MinorUnitOrderConfig, OrderConfig,
)
from cartloom.functions import codes as cd
from cartloom.functions import text as tx
from cartloom.operators.skew import lookup_hot
from cartloom.plans.parties import has_benefit, profile_party_id
from cartloom.sources.schemas import contract, document_text

NO_PAYMENT = 99


# --- exploding ---------------------------------------------------------------


def explode_items(orders: DataFrame) -> DataFrame:
    """One row per line item with its position in the document."""
    return orders.select("order_id", F.posexplode("doc.line_items").alias("position", "item")).select(
        "order_id", "position", F.col("item.id").alias("line_id"), F.col("item.sku").alias("sku"),
        F.col("item.quantity").alias("quantity"), F.col("item.price").alias("price"),
        F.col("item.discount_allocations").alias("discount_allocations"),
    )


def explode_discounts(items: DataFrame) -> DataFrame:
    """One row per discount of a line; lines without discounts give none."""
    return items.select("order_id", "line_id", "quantity", F.explode("discount_allocations").alias("d")).select(
        "order_id", "line_id", "quantity", F.col("d.amount").alias("amount")
    )


# --- payments ----------------------------------------------------------------


def pick_payment(gateways: Column, cfg: OrderConfig) -> Column:
    """One payment of an order as struct(value, code): by priority, then position in the list.

    Works inside the row's array, so no rows move.
    """
    ranked = F.transform(
        gateways,
        lambda g, i: F.struct(
            F.coalesce(_priority(g, cfg), F.lit(NO_PAYMENT)).alias("priority"), i.alias("position"),
            g.alias("value"), cd.map_code(g, cfg.payment_codes, None, "contains").alias("code"),
        ),
    )
    known = F.filter(ranked, lambda p: p["code"].isNotNull())
    best = F.array_min(known) if cfg.payment_pick == "first" else F.array_max(known)
    return best


def _priority(gateway: Column, cfg: OrderConfig) -> Column:
    out = F.lit(None).cast("int")
    for name, rank in reversed(list(cfg.payment_priority.items())):
        hit = gateway.contains(name) if name == "Mercado" else gateway == name
        out = F.when(hit, F.lit(rank)).otherwise(out)
    return out


def last_gateway(gateways: Column) -> Column:
    """Last listed gateway that is not a gift card."""
    return F.try_element_at(F.filter(gateways, lambda g: g != "gift_card"), F.lit(-1))


# --- allocation dialect ------------------------------------------------------


def order_header(doc: Column, cfg: OrderConfig, run_ts: Column) -> Column:
    """Header record; the party is the billing id, then the customer id, then the default."""
    party = F.coalesce(
        tx.blank_to_null(F.coalesce(doc["billing_address"]["company"], doc["customer"]["default_address"]["company"])),
        F.lit(cfg.default_party),
    )
    payment = pick_payment(doc["payment_gateway_names"], cfg)
    day = _order_day(doc, cfg, run_ts)
    return F.struct(
        tx.day_text(day).alias("f430_id_fecha"), party.alias("f430_id_tercero_fact"), party.alias("f430_id_tercero_rem"),
        tx.day_text(F.date_add(day, 1)).alias("f430_fecha_entrega"), tx.clip(doc["name"], 15).alias("f430_num_docto_referencia"),
        tx.clip(doc["name"], 10).alias("f430_referencia"), F.coalesce(payment["code"], F.lit("")).alias("f430_id_tipo_cli_fact"),
    )


def _order_day(doc: Column, cfg: OrderConfig, run_ts: Column) -> Column:
    """Day of the run, or the day the shop last touched the order (its payment)."""
    if cfg.day_from == "run":
        return run_ts.cast("date")
    return F.substring(doc["updated_at"], 1, 10).try_cast("date")


def sorted_items(doc: Column) -> Column:
    """Line items in the order of their ids, ids compared as text."""
    return F.array_sort(F.coalesce(doc["line_items"], F.array().cast(_ITEMS)))


_ITEMS = "array<struct<id:string,sku:string,quantity:string,price:string,discount_allocations:array<struct<amount:string>>>>"


def _line(number: Column, reference: Column, barcode: Column, unit: str, qty: Column, price: Column, notes: Column,
          cfg: OrderConfig, day: Column) -> Column:
    return F.struct(
        number.cast("int").alias("f431_nro_registro"), reference.alias("f431_referencia_item"),
        barcode.alias("f431_codigo_barras"), tx.day_text(F.date_add(day, 1)).alias("f431_fecha_entrega"),
        F.lit(unit).alias("f431_id_unidad_medida"), qty.try_cast(cfg.quantity_type).alias("f431_cant_pedida_base"),
        price.try_cast(cfg.price_type).alias("f431_precio_unitario"), notes.alias("f431_notas"),
    )


def order_lines(doc: Column, cfg: OrderConfig, run_ts: Column) -> Column:
    notes, day = last_gateway(doc["payment_gateway_names"]), _order_day(doc, cfg, run_ts)

    def line(item: Column, i: Column) -> Column:
        sku = tx.drop_leading_zero(item["sku"]) if cfg.drop_leading_zero else item["sku"]
        return _line(i + 1, F.lit(""), sku, cfg.item_unit, item["quantity"], item["price"], notes, cfg, day)

    return F.transform(sorted_items(doc), line)


def freight_lines(doc: Column, cfg: OrderConfig, run_ts: Column) -> Column:
    """Freight records, numbered 0: positive, not removed, and no shipping line discounted."""
    lines = F.coalesce(doc["shipping_lines"], F.array().cast(_SHIPPING))
    discounted = F.exists(lines, lambda s: F.get(s["discount_allocations"], F.lit(0))["amount"].isNotNull())
    paid = F.filter(
        lines, lambda s: (cd.money(s["price"]) > 0) & (s["is_removed"] == "false") & ~discounted
    )
    day = _order_day(doc, cfg, run_ts)

    def line(s: Column) -> Column:
        ref = notes = F.lit(cfg.freight_reference)
        if cfg.freight_by_price:
            ref = cd.map_code(s["price"], {p: r for p, (r, _) in cfg.freight_by_price.items()}, "")
            notes = cd.map_code(s["price"], {p: n for p, (_, n) in cfg.freight_by_price.items()}, "")
        return _line(F.lit(0), ref, F.lit(""), cfg.freight_unit, F.lit("1"), s["price"], notes, cfg, day)

    return F.transform(paid, line)


_SHIPPING = "array<struct<price:string,is_removed:string,discount_allocations:array<struct<amount:string>>>>"


def line_discounts(doc: Column, cfg: OrderConfig) -> Column:
    """Unit discounts per line number when the first discount applies to line items.

    A discount is kept when it is positive and leaves the line a positive value.
    """
    on_lines = F.coalesce(F.get(doc["discount_applications"], F.lit(0))["target_type"] == "line_item", F.lit(False))
    rows = F.flatten(
        F.transform(
            sorted_items(doc),
            lambda li, i: F.transform(
                F.coalesce(li["discount_allocations"], F.array().cast("array<struct<amount:string>>")),
                lambda d: F.struct(
                    (i + 1).cast("int").alias("f431_nro_registro"),
                    cd.unit_share(d["amount"], li["quantity"]).alias("unit"),
                    (cd.money(li["price"]) * cd.money(li["quantity"]) - cd.money(d["amount"])).alias("left"),
                ),
            ),
        )
    )
    kept = F.filter(rows, lambda r: on_lines & (r["unit"] > 0) & (r["left"] > 0))
    return F.transform(
        kept,
        lambda r: F.struct(r["f431_nro_registro"].alias("f431_nro_registro"), r["unit"].cast(cfg.discount_type).alias("f432_vlr_uni")),
    )


def order_sections(orders: DataFrame, cfg: OrderConfig, run_ts: Column) -> DataFrame:
    """Order rows with their header, lines and discounts as typed columns.

    Each document is one row and every section is built from its own arrays: no shuffle.
    """
    doc = F.col("doc")
    return orders.select(
        "order_id", doc["name"].alias("order_name"), order_header(doc, cfg, run_ts).alias("header"),
        F.concat(order_lines(doc, cfg, run_ts), freight_lines(doc, cfg, run_ts)).alias("lines"),
        line_discounts(doc, cfg).alias("discounts"),
        F.when(pick_payment(doc["payment_gateway_names"], cfg).isNull(), F.lit("unknown payment method")).alias("warning"),
    )


def build_order_docs(orders: DataFrame, cfg: OrderConfig, run_ts: Column) -> DataFrame:
    sections = order_sections(orders, cfg, run_ts)
    parts = [F.array("header"), F.col("lines"), F.col("discounts")]
    json = document_text(dict(zip(cfg.sections, parts)), False)
    return sections.select(*contract(F.col("order_name"), json, cfg))


def price_gap_discounts(lines: DataFrame, prices: DataFrame) -> DataFrame:
    """Discount per line where the ERP list price is above the shop price.

    A best-selling SKU may own a large share of the lines. Of several list prices the
    highest counts, so a line gets at most one discount.
    """
    listed = prices.groupBy("sku").agg(F.max("price").alias("list_price"))
    return (
        lookup_hot(lines, listed, ["sku"], "inner")
        .withColumn("gap", F.col("list_price") - F.col("price"))
        .where("gap > 0")
        .select(*lines.columns, "list_price", "gap")
    )


# --- minor-unit dialect ------------------------------------------------------


def marketplace_of(order_id: Column, which: int, default: Column) -> Column:
    """Marketplace name (0) or movement reason (1) by the first letters of the order id."""
    out = default
    for prefix, pair in reversed(list(MARKETPLACES.items())):
        out = F.when(F.substring(order_id, 1, 3) == prefix, F.lit(pair[which])).otherwise(out)
    return out


def order_notes(doc: Column, cfg: MinorUnitOrderConfig) -> Column:
    """Order, sequence, payment method and the store or courier that hands it over."""
    payment = F.get(F.get(doc["paymentData"]["transactions"], F.lit(0))["payments"], F.lit(0))["paymentSystemName"]
    paid = F.when(payment == "Assumed value by affiliate ADDI(DDD)", F.lit("Addi")).otherwise(F.coalesce(payment, F.lit("")))
    first = F.get(doc["shippingData"]["logisticsInfo"], F.lit(0))
    chosen = F.filter(
        first["slas"],
        lambda s: (s["id"] == first["selectedSla"]) & (s["deliveryChannel"] == "pickup-in-point"),
    )
    pickup = F.get(chosen, F.lit(0))["pickupStoreInfo"]["friendlyName"]
    seller = F.get(doc["sellers"], F.lit(0))["name"]
    store = F.when(
        first["deliveryCompany"] == cfg.courier, marketplace_of(doc["orderId"], 0, seller)
    ).otherwise(F.coalesce(pickup, first["deliveryCompany"]))
    return tx.join_text(
        F.lit("OrderId: "), doc["orderId"], F.lit(" Secuencia: "), doc["sequence"], F.lit(" Metodo Pago: "), paid,
        F.lit(" Tienda: "), F.coalesce(store, F.lit("SIN INFO COURIER")),
    )


def item_tax_rates(items: DataFrame, groups: DataFrame, keys: DataFrame, indicator: int = 3) -> DataFrame:
    """Tax rate per item reference through its tax group and tax key."""
    wanted = groups.where(F.col("indicator") == indicator).select("company_id", "tax_group", "tax_key")
    return (
        items.select("company_id", F.rtrim("reference").alias("reference"), "tax_group")
        .join(wanted, ["company_id", "tax_group"])
        .join(keys.select("company_id", "tax_key", "rate"), ["company_id", "tax_key"])
        .select("company_id", "reference", "tax_key", "rate")
    )


def _unfold(orders: DataFrame, ordered: Column, every: dict[str, Column], carry: dict[str, Column] | None) -> DataFrame:
    """One row per element of ``ordered``, numbered from 1.

    ``every`` columns go on all rows, ``carry`` columns on the first row of an order only.
    """
    unfold = F.posexplode if carry is None else F.posexplode_outer
    carry = carry or {}
    kept = [c.alias(n) for n, c in {**every, **carry}.items()]
    base = orders.select("order_id", *kept, ordered.alias("__items"))
    lines = base.select("order_id", *every, *carry, unfold("__items").alias("__at", "it"))
    on_first = F.coalesce(F.col("__at"), F.lit(0)) == 0
    return lines.select(
        "order_id", *every, *[F.when(on_first, F.col(n)).alias(n) for n in carry], (F.col("__at") + 1).alias("line_no"), "it.*"
    )


MINOR_FIELDS = ["line_no", "barcode", "unit", "quantity", "unit_price", "tax_rate", "unit_discount"]
MARKETPLACE_FIELDS = ["line_no", "reference", "warehouse", "unit", "quantity", "net_price"]


def _regrouped(lines: DataFrame, fields: list[str]) -> DataFrame:
    """Lines back in one row per order as (order_id, head, rows), in number order.

    Lines that met a master lie far from the others of their order: they move as flat rows, lists of one line would be larger.
    """
    rows = F.sort_array(F.collect_list(F.when(F.col("line_no").isNotNull(), F.struct(*fields))))
    return lines.repartition("order_id").groupBy("order_id").agg(F.first("head", ignorenulls=True).alias("head"), rows.alias("rows"))


def minor_unit_lines(orders: DataFrame, items: DataFrame, carry: dict[str, Column] | None = None) -> DataFrame:
    """Numbered lines of minor-unit orders with unit, price and discount from the item master.

    ``items`` carries ``barcode``, ``unit`` and ``tax_group``, one row per barcode. Lines are
    numbered inside their document by barcode (reference where it has none). ``carry`` names
    order-level columns to keep: they travel on the first line only, and an order without
    lines then keeps one row with ``line_no`` NULL.
    """
    doc = F.col("doc")
    ordered = F.array_sort(
        F.transform(
            doc["items"],
            lambda it: F.struct(
                F.coalesce(it["ean"], it["refId"]).alias("code"), it["id"].alias("id"), it["uniqueId"].alias("unique_id"),
                it["ean"].alias("ean"), it["quantity"].alias("quantity"), it["price"].alias("price"),
                it["sellingPrice"].alias("selling_price"),
            ),
        )
    )
    # What moves to the master is the code once, whether it is the barcode, and numbers in place of texts.
    lines = _unfold(orders, ordered, {"exempt": has_benefit(doc)}, carry).select(
        "order_id", "exempt", *(carry or {}), "line_no", "code", F.col("ean").isNotNull().alias("has_ean"), "quantity",
        F.col("price").try_cast("double").alias("price"), F.col("selling_price").try_cast("double").alias("selling_price"),
    )
    master = items.select(F.col("barcode").alias("code"), "unit", "tax_group")
    joined = lines.join(master, "code", "left")
    taxed = F.coalesce(F.col("tax_group") == TAXED_GROUP, F.lit(False))
    price, selling = F.col("price"), F.col("selling_price")
    has_discount = (selling != 0) & ((price - selling) != 0)
    return joined.select(
        "order_id", *(carry or {}), "line_no", F.when(F.col("has_ean"), F.col("code")).alias("barcode"),
        F.coalesce("unit", F.lit("UND")).alias("unit"), "quantity",
        cd.whole_from_minor(price, taxed).alias("unit_price"),
        F.when(F.col("tax_group").isNotNull() & ~F.col("exempt"), F.when(taxed, F.lit(19)).otherwise(F.lit(0))).alias("tax_rate"),
        F.when(has_discount, cd.exempt_discount(price, selling, taxed, F.col("exempt"))).alias("unit_discount"),
    )


def minor_unit_freight(doc: Column) -> Column:
    """Shipping total in whole units; NULL when there is none."""
    paid = F.filter(
        doc["totals"], lambda t: (t["id"] == "Shipping") & (t["value"].try_cast("int") > 0)
    )
    return F.round(F.get(paid, F.lit(0))["value"].cast("double") / F.lit(100.0), 0).cast("int")


def build_minor_unit_order_docs(orders: DataFrame, items: DataFrame, cfg: MinorUnitOrderConfig, run_ts: Column) -> DataFrame:
    """Header, lines (with freight), taxes and discounts of minor-unit orders.

    Lines meet the item master and return to their document, which held them in one row
    before, so the regrouped lists are no larger than the input documents. What a document
    says for its header is read where it is parsed and travels with the first line; fixed
    values and copies are added when the lines are back.
    """
    doc = F.col("doc")
    today = tx.day_text(run_ts)
    key = {"co": cfg.centre, "kind": cfg.document_kind, "no": "1"}

    def ids(prefix: str) -> list[Column]:
        return [F.lit(v).alias(f"{prefix}{n}") for n, v in zip(("_id_co", "_id_tipo_docto", "_consec_docto"), key.values())]

    reason = F.col("reason")

    def line(r: Column) -> Column:
        return F.struct(
            r["line_no"].alias("f431_nro_registro"), *ids("f431"), F.lit("").alias("f431_referencia_item"),
            r["barcode"].alias("f431_codigo_barras"), F.lit(cfg.warehouse).alias("f431_id_bodega"), reason.alias("f431_id_motivo"),
            F.lit(cfg.centre).alias("f431_id_co_movto"), F.lit("02").alias("f431_id_un_movto"), today.alias("f431_fecha_entrega"),
            F.lit("3").alias("f431_num_dias_entrega"), r["unit"].alias("f431_id_unidad_medida"),
            r["quantity"].alias("f431_cant_pedida_base"), r["unit_price"].alias("f431_precio_unitario"),
        )

    def tax(r: Column) -> Column:
        return F.struct(
            r["line_no"].alias("F431_NRO_REGISTRO"), F.lit(cfg.tax_key).alias("F433_ID_LLAVE_IMPUESTO"), r["tax_rate"].alias("F433_TASA"),
            F.lit(cfg.tax_key).alias("F433_ID_LLAVE_IMPUESTO_DESC"), r["tax_rate"].alias("F433_TASA_DESC"),
        )

    def discount(r: Column) -> Column:
        return F.struct(r["line_no"].alias("f431_nro_registro"), *ids("f430"), r["unit_discount"].alias("f432_vlr_uni"))

    profile, place = doc["clientProfileData"], doc["shippingData"]["address"]
    head = F.struct(
        profile_party_id(doc).alias("party"), F.concat(F.lit(cfg.store_prefix), F.lit(" "), doc["sequence"]).alias("reference"),
        order_notes(doc, cfg).alias("notes"),
        tx.clip(F.upper(tx.join_text(F.replace(profile["firstName"], F.lit("&"), F.lit("Y")), F.lit(" "), profile["lastName"])), 40)
        .alias("contact"),
        tx.clip(F.upper(place["street"]), 40).alias("address1"), tx.clip(F.upper(place["complement"]), 40).alias("address2"),
        tx.clip(F.upper(place["neighborhood"]), 40).alias("address3"), tx.clip(place["postalCode"], 2).alias("state"),
        F.substring(place["postalCode"], 3, 5).alias("city"), tx.clean_phone(profile["phone"]).alias("phone"),
        tx.clip(F.upper(profile["email"]), 40).alias("email"),
        minor_unit_freight(doc).alias("freight"), F.coalesce(F.size(doc["items"]), F.lit(0)).alias("n_items"),
        marketplace_of(doc["orderId"], 1, F.lit(DEFAULT_REASON)).alias("reason"),
    )
    both = _regrouped(minor_unit_lines(orders, items, {"head": head}), MINOR_FIELDS).select("order_id", "head.*", "rows")
    c = F.col
    header = F.struct(
        *ids("f430"), today.alias("f430_id_fecha"), c("party").alias("f430_id_tercero_fact"), F.lit("001").alias("f430_id_sucursal_fact"),
        c("party").alias("f430_id_tercero_rem"), F.lit("001").alias("f430_id_sucursal_rem"), today.alias("f430_fecha_entrega"),
        F.lit("3").alias("f430_num_dias_entrega"), c("reference").alias("f430_num_docto_referencia"),
        F.lit(cfg.payment_terms).alias("f430_id_cond_pago"), c("notes").alias("f430_notas"),
        F.lit(cfg.seller_party).alias("f430_id_tercero_vendedor"), c("contact").alias("f419_contacto"),
        c("address1").alias("f419_direccion1"), c("address2").alias("f419_direccion2"), c("address3").alias("f419_direccion3"),
        c("state").alias("f419_id_depto"), c("city").alias("f419_id_ciudad"), c("phone").alias("f419_telefono"), c("email").alias("f419_email"),
    )
    freight = F.struct(
        (F.col("n_items") + 1).alias("f431_nro_registro"), *ids("f431"), F.lit("FLETES").alias("f431_referencia_item"),
        F.lit("").alias("f431_codigo_barras"), F.lit(cfg.warehouse).alias("f431_id_bodega"), reason.alias("f431_id_motivo"),
        F.lit(cfg.centre).alias("f431_id_co_movto"), F.lit("01").alias("f431_id_un_movto"), today.alias("f431_fecha_entrega"),
        F.lit("3").alias("f431_num_dias_entrega"), F.lit("UND").alias("f431_id_unidad_medida"),
        F.lit("1").alias("f431_cant_pedida_base"), F.col("freight").alias("f431_precio_unitario"),
    )
    moves = F.concat(F.transform("rows", line), F.filter(F.array(freight), lambda f: F.col("freight") > 0))
    json = document_text(
        {
            "Pedidos": F.array(header),
            "Movimientos": moves, "Impuestos": F.transform(F.filter("rows", lambda r: r["tax_rate"].isNotNull()), tax),
            "Descuento": F.transform(F.filter("rows", lambda r: r["unit_discount"] > 0), discount),
        }
    )
    return both.select(*contract(F.col("order_id"), json, cfg))


# --- marketplace dialect -----------------------------------------------------


def marketplace_lines(
    orders: DataFrame, items: DataFrame, rates: DataFrame, carry: dict[str, Column] | None = None
) -> DataFrame:
    """Numbered lines of marketplace orders: brand reference, warehouse code, net unit price."""
    doc = F.col("doc")
    ordered = F.array_sort(
        F.transform(
            doc["CheckoutItems"],
            lambda it: F.struct(
                it["ProductVersion"]["_id"].alias("id"), it["ProductVersion"]["code"].alias("code"),
                it["ProductVersion"]["Product"]["name"].alias("product"), it["count"].alias("count"), it["gross"].alias("gross"),
                F.get(it["CheckoutItemDiscounts"], F.lit(0))["discount"].alias("discount"),
            ),
        )
    )
    warehouse = cd.map_code(doc["Warehouse"]["name"], WAREHOUSE_CODES, "01")
    lines = _unfold(orders, ordered, {"warehouse": warehouse}, carry)
    # What moves to units and rates is the reference and numbers in place of texts.
    keyed = lines.select(
        "order_id", "warehouse", *(carry or {}), "line_no", tx.brand_sku(F.col("code"), F.col("product"), BRAND_MARKS).alias("reference"),
        F.col("count").try_cast("int").alias("quantity"), F.col("gross").cast("decimal(18,2)").alias("gross"),
        F.col("discount").try_cast("decimal(18,2)").alias("discount"),
    )
    return (
        keyed.join(items.select("reference", "unit"), "reference", "left")
        .join(rates.select("reference", "rate"), "reference", "left")
        .select(
            "order_id", *(carry or {}), "line_no", "reference", "warehouse", F.trim(F.coalesce("unit", F.lit("UND"))).alias("unit"), "quantity",
            cd.net_unit_price(F.col("gross"), F.col("discount"), F.col("quantity"), F.col("rate")).alias("net_price"),
        )
    )


def build_marketplace_order_docs(
    orders: DataFrame, items: DataFrame, rates: DataFrame, cfg: MarketplaceConfig, run_ts: Column
) -> DataFrame:
    """Header and lines of marketplace orders, prices net of discount and tax.

    What a document says for its header travels with the first line; fixed values are added when the lines are back.
    """
    doc = F.col("doc")
    today, tomorrow = tx.day_text(run_ts), tx.day_text(F.date_add(run_ts, 1))
    number = F.get(doc["CheckoutLinks"], F.lit(0))["externalOrderNumber"]
    notes = tx.join_text(
        F.lit("Orden: "), F.col("order_id"), F.lit("   Pedido de: "), doc["origin"], F.lit("   Venta: "), number,
        F.lit("   Bodega: "), doc["Warehouse"]["name"],
    )
    head = F.struct(
        doc["Client"]["taxId"].alias("party"), marketplace_reference(doc, 15).alias("long_reference"),
        marketplace_reference(doc, 10).alias("reference"), notes.alias("notes"),
        tx.clip(F.upper(F.coalesce(doc["Client"]["fullName"], F.lit(""))), 50).alias("contact"),
    )

    def line(r: Column) -> Column:
        return F.struct(
            r["line_no"].alias("f431_nro_registro"), r["reference"].alias("f431_referencia_item"),
            r["warehouse"].alias("f431_id_bodega"), tomorrow.alias("f431_fecha_entrega"), F.lit("1").alias("f431_num_dias_entrega"),
            r["unit"].alias("f431_id_unidad_medida"), r["quantity"].alias("f431_cant_pedida_base"),
            r["net_price"].alias("f431_precio_unitario"), F.lit("").alias("f431_notas"),
        )

    both = _regrouped(marketplace_lines(orders, items, rates, {"head": head}), MARKETPLACE_FIELDS).select("order_id", "head.*", "rows")
    c, branch = F.col, F.lit(cfg.branch)
    header = F.struct(
        today.alias("f430_id_fecha"), c("party").alias("f430_id_tercero_fact"), branch.alias("f430_id_sucursal_fact"),
        c("party").alias("f430_id_tercero_rem"), branch.alias("f430_id_sucursal_rem"), tomorrow.alias("f430_fecha_entrega"),
        F.lit("1").alias("f430_num_dias_entrega"), c("long_reference").alias("f430_num_docto_referencia"),
        c("reference").alias("f430_referencia"), c("notes").alias("f430_notas"), F.lit("").alias("f430_id_tercero_vendedor"),
        c("contact").alias("f419_contacto"),
    )
    json = document_text({"Pedidos": F.array(header), "MovtoPedidosComercial": F.transform("rows", line)}, False)
    return both.select(*contract(F.col("order_id"), json, cfg))


def marketplace_reference(doc: Column, width: int) -> Column:
    number = F.get(doc["CheckoutLinks"], F.lit(0))["externalOrderNumber"]
    return tx.external_reference(number, doc["origin"], width, PREFIXED_ORIGINS)


# --- attributes --------------------------------------------------------------


def order_attributes(orders: DataFrame, erp: DataFrame, guides: DataFrame, carrier: str) -> DataFrame:
    """Marketplace, carrier, tracking number and gateway of each order as attribute rows."""
    base = orders.join(erp, "reference").join(guides, "order_id", "left")
    rows = F.array(
        F.struct(F.lit("Market_Place").alias("attribute"), F.col("origin").alias("value")),
        F.struct(F.lit("Transportadora").alias("attribute"), F.lit(carrier).alias("value")),
        F.struct(F.lit("Nro_Guia").alias("attribute"), F.coalesce("tracking", F.lit("")).alias("value")),
        F.struct(F.lit("Pasarela").alias("attribute"), F.coalesce("gateway", F.lit("")).alias("value")),
    )
    return base.select("order_id", "centre", "doc_type", "doc_number", F.explode(rows).alias("a")).select(
        "order_id", "centre", "doc_type", "doc_number", "a.attribute", "a.value"
    )
