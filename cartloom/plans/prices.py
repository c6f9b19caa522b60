"""Price in force per variant and its payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.functions.text import number_text
from cartloom.operators.merge import merge_changed

EXTENSION, ITEM = 1, 2


def filter_by_class(df: DataFrame, classes: DataFrame, plan: str | None = None, criterion: str | None = None) -> DataFrame:
    """Items of a plan and criterion; with neither, all items."""
    if plan is None and criterion is None:
        return df
    wanted = classes
    if plan is not None:
        wanted = wanted.where(F.col("plan_id") == F.lit(plan))
    if criterion is not None:
        wanted = wanted.where(F.col("major_id") == F.lit(criterion))
    return df.join(wanted.select("item_rowid").distinct(), "item_rowid", "left_semi")


def effective_price(
    prices: DataFrame, variants: DataFrame, mode: int, items: DataFrame | None = None, ext: DataFrame | None = None,
    classes: DataFrame | None = None, plan: str | None = None, criterion: str | None = None, floor: float | None = None,
) -> DataFrame:
    """Price of each shop variant from the newest prices, by extension or by item."""
    if mode == EXTENSION:
        keyed = prices.drop("item_rowid").join(ext.withColumnRenamed("main_barcode", "sku"), "ext_rowid")
    else:
        keyed = prices.join(items.where("reference is not null").withColumnRenamed("reference", "sku"), "item_rowid")
    if classes is not None:
        keyed = filter_by_class(keyed, classes, plan, criterion)
    if floor is not None:
        keyed = keyed.where(F.col("price") > F.lit(floor))
    return keyed.select("sku", "price").join(variants, "sku").select("variant_id", "sku", "price").distinct()


def price_payload(kind: str, variant: Column, price: Column) -> Column:
    """Payload text: ``compare_at``, ``price`` or a ``fixed`` price list for one trade policy."""
    if kind == "compare_at":
        return F.to_json(F.struct(F.struct(variant.alias("id"), price.alias("compare_at_price")).alias("variant")))
    if kind == "price":
        return F.to_json(
            F.struct(F.struct(variant.cast("string").alias("id"), number_text(price).alias("price")).alias("variant"))
        )
    amount = F.round(price).cast("bigint")
    fixed = F.struct(
        F.lit("1").alias("tradePolicyId"), amount.alias("value"), amount.alias("listPrice"), F.lit(1).alias("minQuantity")
    )
    return F.to_json(
        F.struct(
            F.lit(0).alias("markup"), amount.alias("basePrice"), amount.alias("listPrice"), F.array(fixed).alias("fixedPrices")
        )
    )


def sync_prices(state: DataFrame, prices: DataFrame) -> DataFrame:
    return merge_changed(
        state, prices, ["variant_id"], ["price"],
        on_change={"synced": F.lit(False), "synced_at": F.lit(None).cast("timestamp")}, always=["sku"],
    )
