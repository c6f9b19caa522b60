"""Delivery of pending stock: eligibility, batches, payloads, run log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.functions.codes import resource_id
from cartloom.functions.text import log_text
from cartloom.operators.skew import number_rows
from cartloom.operators.temporal import latest_valid

# Prefixes of the shop's global identifiers and the fixed words of its request.
ITEM_PREFIX = "gid://shopify/InventoryItem/"
LOCATION_PREFIX = "gid://shopify/Location/"
QUANTITY_NAME, QUANTITY_REASON = "available", "correction"


def pending_stock(state: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Unsent stock rows of the warehouses active in both systems."""
    active = warehouses.where("is_active and is_active_shop").select("warehouse").distinct()
    return state.where(~F.col("synced")).join(active, "warehouse", "left_semi")


def flag_eligible(pending: DataFrame, checks: DataFrame) -> DataFrame:
    """Pending rows with ``ok``: whether their latest location check holds. Each side is read once.

    The newest check decides, so an item whose good check was followed by a bad one is skipped.
    """
    on = ["inventory_item_id", "location_id"]
    good = latest_valid(checks, on, "checked_at", [], F.col("stocked") & F.col("error").isNull())
    flagged = pending.join(good.select(*on, F.lit(True).alias("ok")), on, "left")
    return flagged.withColumn("ok", F.coalesce("ok", F.lit(False)))


def eligible_split(pending: DataFrame, checks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pending rows whose latest location check holds, and the rest."""
    flagged = flag_eligible(pending, checks)
    return flagged.where("ok").drop("ok"), flagged.where("not ok").drop("ok")


def to_batches(df: DataFrame, size: int, order: list[str], ranges: int | None = None) -> DataFrame:
    """Consecutive batches of ``size`` rows by ``order``; only the last may be short."""
    numbered = number_rows(df, [], order, "__rn", ranges)
    return numbered.withColumn("batch", F.floor((F.col("__rn") - 1) / F.lit(size)).cast("bigint")).withColumn(
        "position", ((F.col("__rn") - 1) % F.lit(size)).cast("int")
    ).drop("__rn")


def quantity_payload(batches: DataFrame) -> DataFrame:
    """One request body per batch; a batch is bounded by its size."""
    entry = F.struct(
        "position",
        F.struct(
            resource_id(F.col("inventory_item_id"), ITEM_PREFIX).alias("inventoryItemId"),
            resource_id(F.col("location_id"), LOCATION_PREFIX).alias("locationId"),
            F.col("available").alias("quantity"),
        ).alias("q"),
    )
    grouped = batches.groupBy("batch").agg(
        F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["q"]).alias("quantities")
    )
    body = F.struct(
        F.lit(QUANTITY_NAME).alias("name"), F.lit(QUANTITY_REASON).alias("reason"),
        F.lit(True).alias("ignoreCompareQuantity"), F.col("quantities"),
    )
    return grouped.select("batch", F.size("quantities").alias("items"), F.to_json(F.struct(body.alias("input"))).alias("payload"))


def run_log(
    events: DataFrame, description: Column, start: Column, end: Column, success: Column, keep: list[str] = ()
) -> DataFrame:
    return events.select(
        *keep, log_text(description).alias("description"), start.alias("started_at"), end.alias("ended_at"), success.alias("success")
    )


def run_summary(log: DataFrame, keys: list[str] = ()) -> DataFrame:
    return log.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("entries"),
        F.count_if("success").alias("succeeded"),
        F.count_if(~F.col("success")).alias("failed"),
        F.bool_or(~F.col("success")).alias("any_failure"),
    )
