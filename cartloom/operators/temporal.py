"""Latest, first and in-force rows per key; document line numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartloom.operators.skew import number_rows


def keep_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key. Spark drops all but one row per key and task before the shuffle."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rn", rn).where("__rn = 1").drop("__rn")


def dedupe_latest(df: DataFrame, keys: list[str], ts: str, tie: list[str]) -> DataFrame:
    return keep_one(df, keys, [F.col(ts).desc(), *[F.col(t).desc() for t in tie]])


def dedupe_keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return keep_one(df, keys, [F.col(o) for o in order])


def latest_by_max(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """All rows at the newest time of their key; ties stay.

    The maxima are aggregated map-side, so a key with most rows never meets in one task.
    """
    newest = df.groupBy(*keys).agg(F.max(ts).alias(ts))
    return df.join(newest, [*keys, ts], "left_semi")


def price_as_of(
    prices: DataFrame, keys: list[str], ts: str, as_of: Column, price: str, floor: float = 1
) -> DataFrame:
    """Prices in force at ``as_of``: newest activation not after it, above the floor; ties stay."""
    in_force = latest_by_max(prices.where(F.col(ts) <= as_of), keys, ts)
    return in_force.where(F.col(price) > F.lit(floor))


def latest_price(prices: DataFrame, ext: str, item: str, ts: str, tie: list[str]) -> DataFrame:
    """Newest price per extension, or per item where no extension is named.

    The key carries its kind, so an extension id never meets an equal item id.
    """
    kind = F.when(F.col(ext).isNotNull(), F.lit("ext")).otherwise(F.lit("item"))
    keyed = prices.withColumn("key_kind", kind).withColumn("key_id", F.coalesce(F.col(ext), F.col(item)))
    return dedupe_latest(keyed, ["key_kind", "key_id"], ts, tie)


def latest_valid(df: DataFrame, keys: list[str], ts: str, tie: list[str], flag: Column) -> DataFrame:
    """Newest row per key, kept only when its own flag holds."""
    return dedupe_latest(df, keys, ts, tie).where(flag)


def number_lines(df: DataFrame, document: list[str], order: list[str], name: str = "line_no", ranges: int | None = None) -> DataFrame:
    return number_rows(df, document, order, name, ranges)


def find_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def tag_duplicates(df: DataFrame, key: str, row_id: str, suffix: str = "-1", state: int = 3) -> DataFrame:
    """The smallest id keeps its key; every other copy is renamed and set aside.

    Only repeated keys are joined back, each as one aggregated row.
    """
    first = df.groupBy(key).agg(F.min(row_id).alias("__first"), F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n")
    copy = F.col("__first").isNotNull() & (F.col(row_id) != F.col("__first"))
    return (
        df.join(first, key, "left")
        .withColumn("__copy", copy)
        .withColumn(key, F.when(F.col("__copy"), F.concat(F.col(key).cast("string"), F.lit(suffix))).otherwise(F.col(key).cast("string")))
        .withColumn("state", F.when(F.col("__copy"), F.lit(state)).otherwise(F.col("state")))
        .drop("__first", "__copy")
    )
