"""Upserts as new snapshots: change detection, inserts, rejects, sync flags.

Plain files have no row update. Each function returns the next state, which the caller
writes to a new path; the state being read is never overwritten.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSERT, UPDATE, KEEP = "insert", "update", "keep"


def one_per_key(source: DataFrame, keys: list[str]) -> DataFrame:
    """One source row per key (the smallest by its remaining columns).

    An upsert with two source rows for one target row has no defined winner.
    """
    rest = [c for c in source.columns if c not in keys]
    if not rest:
        return source.dropDuplicates(keys)
    least = source.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__r"))
    return least.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])


def merge_changed(
    target: DataFrame, source: DataFrame, keys: list[str], compare: list[str],
    on_change: dict[str, Column], always: list[str] = (),
) -> DataFrame:
    """Target after the upsert, with an ``action`` column.

    A matched row changes when any ``compare`` column differs, NULLs compared as values;
    it then takes the source's ``compare`` columns and the ``on_change`` values. Columns in
    ``always`` follow the source on every match. Rows only in the target stay as they are.
    Values are compared as typed columns, not as serialised text.
    """
    carried = list(dict.fromkeys([*compare, *always]))
    new = one_per_key(source, keys).select(
        *keys, *[F.col(c).alias(f"__new_{c}") for c in carried], F.lit(True).alias("__in_source")
    )
    both = target.withColumn("__in_target", F.lit(True)).join(new, keys, "full")
    matched = F.col("__in_target").isNotNull() & F.col("__in_source").isNotNull()
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"__new_{c}")) for c in compare])
    action = (
        F.when(F.col("__in_target").isNull(), F.lit(INSERT))
        .when(matched & differs, F.lit(UPDATE))
        .otherwise(F.lit(KEEP))
    )
    both = both.withColumn("action", action).withColumn("__matched", matched)
    touched = F.col("action").isin(INSERT, UPDATE)
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in on_change:
            out.append(F.when(touched, on_change[c]).otherwise(F.col(c)).alias(c))
        elif c in always:
            out.append(F.when(touched | F.col("__matched"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c))
        elif c in carried:
            out.append(F.when(touched, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return both.select(*out, "action")


def merge_stats(merged: DataFrame) -> DataFrame:
    return merged.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("action") == INSERT).alias("new_rows"),
        F.count_if(F.col("action") == UPDATE).alias("updated_rows"),
    )


def append_new(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows, one per key, that the target does not hold yet."""
    return one_per_key(source, keys).join(target.select(*keys), keys, "left_anti")


def upsert_snapshot(
    target: DataFrame, batch: DataFrame, keys: list[str], value: str, ts: str
) -> tuple[DataFrame, DataFrame]:
    """Next snapshot and the rejected rows. Negative and missing values are rejected; the newest row wins."""
    usable = F.coalesce(F.col(value) >= 0, F.lit(False))
    reason = F.when(F.col(value).isNull(), F.lit("missing quantity")).otherwise(F.lit("negative quantity"))
    rejects = batch.where(~usable).withColumn("reject_reason", reason)
    good = batch.where(usable)
    newest = good.groupBy(*keys).agg(F.max(F.struct(ts, value)).alias("__n")).select(
        *keys, F.col(f"__n.{value}").alias("__value"), F.col(f"__n.{ts}").alias("__ts")
    )
    merged = target.join(newest, keys, "full").select(
        *keys, F.coalesce("__value", value).alias(value), F.coalesce("__ts", ts).alias(ts)
    )
    return merged, rejects


def copy_quantity(products: DataFrame, snapshot: DataFrame, key: str, value: str, into: str) -> DataFrame:
    """Latest quantity of each item copied onto the product table; others keep theirs."""
    return products.join(snapshot.select(key, F.col(value).alias("__q")), key, "left").withColumn(
        into, F.coalesce(F.col("__q"), F.col(into))
    ).drop("__q")


def mark_synced(target: DataFrame, delivered: DataFrame, key: str, at: Column) -> DataFrame:
    done = delivered.select(key).distinct().withColumn("__done", F.lit(True))
    hit = F.col("__done").isNotNull()
    return (
        target.join(done, key, "left")
        .withColumn("synced", F.when(hit, F.lit(True)).otherwise(F.col("synced")))
        .withColumn("synced_at", F.when(hit, at).otherwise(F.col("synced_at")))
        .drop("__done")
    )


def write_snapshot(df: DataFrame, path: str, partitions: list[str] = ()) -> None:
    """Write a new state; refuses to replace an existing path."""
    df.write.mode("errorifexists").partitionBy(*partitions).parquet(path)
