"""Available stock, catalogue cross, stock change detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.operators.merge import merge_changed
from cartloom.operators.relational import densify
from cartloom.sources.tables import whole

REFERENCE, BARCODE = 1, 2


def available_quantity() -> Column:
    """On hand less committed and POS. Each is cut to whole units first; a row that lacks one of them has none available."""
    return F.coalesce(whole(F.col("on_hand")) - (whole(F.col("committed")) + whole(F.col("pos"))), F.lit(0))


def available_stock(
    ext: DataFrame, stock: DataFrame, warehouses: DataFrame, mode: int,
    items: DataFrame | None = None, barcodes: DataFrame | None = None,
) -> DataFrame:
    """Available whole units per extension, SKU and warehouse.

    Mode 1 takes the SKU from the item reference, mode 2 from the main barcode or, failing
    that, the barcode table. The barcode's warehouse counts only where the stock row names none,
    so a quantity is credited once. Extensions of one SKU stay apart: equal quantities are not
    repeats, and neither are equal stock rows of one extension and warehouse. Several barcodes of one SKU count once.
    """
    levels = stock.select("ext_rowid", F.col("warehouse_rowid").alias("stock_wh"), available_quantity().alias("available"))
    codes = ext if mode == BARCODE else ext.join(
        items.where("reference is not null").select("item_rowid", "reference"), "item_rowid"
    )
    if barcodes is not None:
        codes = codes.join(barcodes.withColumnRenamed("warehouse_rowid", "barcode_wh"), "ext_rowid", "left")
    else:
        codes = codes.withColumns({"barcode": F.lit(None).cast("string"), "barcode_wh": F.lit(None).cast("bigint")})
    codes = codes.where("main_barcode is not null or barcode is not null").withColumn(
        "sku", F.col("reference") if mode == REFERENCE else F.coalesce("main_barcode", "barcode")
    )
    wh = warehouses.select("warehouse_rowid", F.col("warehouse_id").alias("warehouse")).distinct()
    # One row per extension and SKU meets the stock; the barcodes' warehouses serve only stock rows without one of their own.
    codes = codes.groupBy("ext_rowid", "sku").agg(F.collect_set("barcode_wh").alias("barcode_whs"))
    where = F.when(F.col("stock_wh").isNotNull(), F.array("stock_wh")).otherwise(F.col("barcode_whs"))
    rows = codes.join(levels, "ext_rowid").withColumn("warehouse_rowid", F.explode(where))
    return rows.join(wh, "warehouse_rowid").select("ext_rowid", "sku", "warehouse", "available")


def total_stock(rows: DataFrame) -> DataFrame:
    """One quantity per SKU and warehouse, summed over its extensions."""
    return rows.groupBy("sku", "warehouse").agg(F.sum("available").cast("int").alias("available"))


def catalogue_stock(
    catalogue: DataFrame, warehouses: DataFrame, stock: DataFrame, fallback: str, match_warehouse: bool = True
) -> DataFrame:
    """Shop catalogue entries with their stock; entries without stock get zero.

    With ``match_warehouse`` an entry meets the stock of its own warehouse only. Without,
    the SKU alone decides, so a SKU held in several warehouses gives several rows.
    """
    available = F.coalesce(F.col("available").cast("int"), F.lit(0)).alias("available")
    # Both sides are distinct before they meet, so the pairs, many more than either, need no distinct of their own.
    entries = catalogue.where("inventory_item_id is not null").join(
        warehouses.select("location_id", "warehouse").distinct(), "location_id"
    ).select("inventory_item_id", "sku", "location_id", F.coalesce("warehouse", F.lit(fallback)).alias("warehouse")).distinct()
    levels = total_stock(stock)
    on = ["sku", "warehouse"] if match_warehouse else ["sku"]
    levels = levels.select(*on, available) if match_warehouse else levels.select(*on, available).distinct()
    return entries.join(levels, on, "left").select("inventory_item_id", "sku", "location_id", "warehouse", available)


def with_payload(rows: DataFrame) -> DataFrame:
    return rows.withColumn("payload", F.to_json(F.struct("location_id", "inventory_item_id", "available")))


def sync_stock(state: DataFrame, levels: DataFrame) -> DataFrame:
    """Next stock state: changed or new quantities wait for delivery again."""
    merged = merge_changed(
        state, levels, ["sku", "warehouse"], ["available"],
        on_change={"synced": F.lit(False), "synced_at": F.lit(None).cast("timestamp")},
        always=["location_id", "inventory_item_id"],
    )
    return with_payload(merged)


def stock_by_group(lines: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Stock summed per key and warehouse group; warehouses outside every group drop out.

    Quantities are summed per warehouse before they meet the mapping.
    """
    per_wh = lines.groupBy(*keys, "warehouse").agg(F.sum("available").alias("available"))
    return per_wh.join(groups, "warehouse").groupBy(*keys, "warehouse_group").agg(
        F.sum("available").cast("bigint").alias("available")
    )


def grouped_grid(variants: DataFrame, grouped: DataFrame, keys: list[str], groups: list[str]) -> DataFrame:
    """Every variant for every warehouse group, absent stock as zero."""
    return densify(variants, grouped, keys, "warehouse_group", groups, "available")


def changed_stock(
    products: DataFrame, shop: DataFrame, erp: DataFrame, stores: DataFrame, candidates: DataFrame, store: int
) -> DataFrame:
    """Candidate SKUs of one store whose ERP quantity differs from the shop's."""
    here = stores.where(F.col("id_store") == F.lit(store)).select("location_id")
    return (
        products.join(candidates.select("sku").distinct(), "sku", "left_semi")
        .join(shop, "inventory_item_id")
        .join(here, "location_id", "left_semi")
        .join(erp.withColumnRenamed("ean", "sku"), "sku")
        .where(F.col("quantity") != F.col("available"))
        .select("sku", "inventory_item_id", "location_id", "available", "quantity")
    )


def stock_diff_report(products: DataFrame, shop: DataFrame, erp: DataFrame, stores: DataFrame, since: Column) -> DataFrame:
    """ERP and shop quantities side by side with their absolute difference."""
    erp_q = erp.select(F.col("ean").alias("sku"), F.col("quantity").alias("erp_quantity"))
    return (
        erp_q.join(products, "sku", "full")
        .join(shop, "inventory_item_id", "left")
        .join(stores.select("location_id", F.col("description").alias("store")), "location_id", "left")
        .select(
            "store", "product_id", "sku",
            F.coalesce("erp_quantity", F.lit(0)).alias("erp_quantity"),
            F.coalesce("available", F.lit(0)).alias("shop_quantity"),
            F.abs(F.coalesce("erp_quantity", F.lit(0)) - F.coalesce("available", F.lit(0))).alias("difference"),
            F.when(F.col("audit") >= since, F.col("audit")).otherwise(F.col("updated_at")).alias("changed_at"),
        )
    )
