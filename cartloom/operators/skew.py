"""Numbering and joining that hold when one key owns a large share of all rows.

Both work the same way at every size: nothing is looked up while planning, no list of hot keys exists, and the only
things sent to every task are tables whose length is a setting (ranges of a rank, buckets of a salt table).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Sampled rows behind each range boundary of a rank: ranges then differ by a fifth or so.
SAMPLE_PER_RANGE = 32
SAMPLE_SEED = 41
# Buckets of the salt table, and the fact rows that one salt of a bucket should carry.
SALT_BUCKETS = 1 << 14
ROWS_PER_SALT = 1 << 20
# Rows of a key bucket that one task takes at any size of the table.
ROWS_PER_TASK = 1 << 16


def _orderable(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if "map<" not in t and "variant" not in t]


def _boundaries(df: DataFrame, columns: list[str], ranges: int) -> Column:
    """Ordered boundary rows, at most ``ranges``, as one array that Spark computes before the main plan.

    Rows are sampled by a threshold on their hash, set from the row count, so a rerun picks the same ones. Any boundaries
    give exact numbers; good ones make the ranges even. Equal rows count once, so copies cannot swell the sample.
    """
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    wanted = float(ranges * SAMPLE_PER_RANGE)
    share = F.pmod(F.xxhash64(F.lit(SAMPLE_SEED), *columns), F.lit(1 << 31)) / F.lit(float(1 << 31))
    sample = df.select(*columns).where(share * total < F.lit(wanted))
    packed = sample.agg(F.sort_array(F.collect_set(F.struct(*columns))).alias("s"))
    step = F.greatest(F.lit(1), F.ceil(F.size("s") / F.lit(ranges))).cast("int")
    return packed.select(F.filter("s", lambda _, i: i % step == step - 1).alias("s")).scalar()


def _place(df: DataFrame, columns: list[str], bounds: Column, ranges: int) -> DataFrame:
    """Rows with ``__range``, the number of boundaries <= the row, by a binary search unrolled into projections."""
    placed = df.withColumns({"__bounds": bounds, "__here": F.struct(*columns), "__range": F.lit(0)})
    for step in [1 << b for b in range(ranges.bit_length() - 1, -1, -1)]:
        reached = F.get("__bounds", F.col("__range") + F.lit(step - 1)) <= F.col("__here")
        placed = placed.withColumn("__range", F.col("__range") + F.when(reached, F.lit(step)).otherwise(F.lit(0)))
    return placed


def _shifts(placed: DataFrame, keys: list[str], bounds: Column) -> DataFrame:
    """Per range the key of its lower boundary and how many rows of that key lie in earlier ranges; one row a boundary.

    Ranges follow the order (keys, order), so only the boundary's key can have begun before its range, and the earlier
    ranges that hold it have that key at their own upper boundary.
    """
    here = F.struct(*keys) if keys else F.lit(0)
    upper = F.get("__bounds", F.col("__range"))
    above = F.struct(*[upper[k].alias(k) for k in keys]) if keys else F.lit(0)
    ends = placed.groupBy("__range").agg(F.count_if(here == above).alias("__n"))
    one = placed.sparkSession.range(1).select(F.posexplode(bounds).alias("__range", "__bound"))
    key = F.struct(*[F.col("__bound")[k].alias(k) for k in keys]) if keys else F.lit(0)
    run = F.sum("__n").over(Window.partitionBy("__key").orderBy("__range"))
    told = one.select("__range", key.alias("__key")).join(ends, "__range", "left").fillna(0, ["__n"])
    return told.select((F.col("__range") + 1).alias("__r"), "__key", run.alias("__shift")).where("__shift > 0")


def number_rows(df: DataFrame, keys: list[str], order: list[str], name: str, ranges: int | None = None) -> DataFrame:
    """``row_number`` per key (over all rows when ``keys`` is empty), ordered by ``order``, ties by a hash of the row.

    All rows are cut into even ranges of (keys, order), whatever the sizes of the groups: each range is numbered on its
    own, and the key at a range's lower boundary is shifted by its rows in earlier ranges. A key with a third of all rows
    so spreads over a third of the ranges; a small key lies in one or two. ``ranges`` is the session's number of shuffle
    partitions unless given. The input is evaluated four times (count, sample, rows at boundaries, result): settle it if it
    is dear. Rows equal in every column stay in one range.
    """
    ranges = ranges or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    tied = df.withColumn("__tie", F.xxhash64(*[F.col(f"`{c}`") for c in _orderable(df)]))
    columns = [*keys, *order, "__tie"]
    bounds = _boundaries(tied, columns, ranges)
    placed = _place(tied, columns, bounds, ranges)
    local = F.row_number().over(Window.partitionBy(*keys, "__range").orderBy(*order, "__tie"))
    here = F.struct(*keys) if keys else F.lit(0)
    shift = F.when(here == F.col("__key"), F.col("__shift")).otherwise(F.lit(0))
    numbered = placed.drop("__bounds", "__here").withColumn("__local", local).join(
        F.broadcast(_shifts(placed, keys, bounds)), F.col("__range") == F.col("__r"), "left"
    )
    return numbered.withColumn(name, (F.col("__local") + shift).cast("bigint")).select(*[F.col(f"`{c}`") for c in df.columns], name)


def page_rows(
    df: DataFrame, keys: list[str], order: list[str], size: int, page: str = "page", position: str = "position",
    ranges: int | None = None,
) -> DataFrame:
    """Cut every group into pages of at most ``size`` rows, so that later lists stay bounded."""
    numbered = number_rows(df, keys, order, "__rn", ranges)
    return numbered.withColumn(page, F.floor((F.col("__rn") - 1) / F.lit(size)).cast("int") + 1).withColumn(
        position, ((F.col("__rn") - 1) % F.lit(size)).cast("int") + 1
    ).drop("__rn")


def page_small(df: DataFrame, keys: list[str], order: list[str], size: int, page: str = "page", position: str = "position") -> DataFrame:
    """``page_rows`` for keys that each fit a task: one shuffle by key, which later steps by the same key go on using.

    ``order`` must tell all rows apart that differ in what is read of them.
    """
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    numbered = df.withColumn("__at", at)
    return numbered.withColumns(
        {page: F.floor(F.col("__at") / F.lit(size)).cast("int") + 1, position: (F.col("__at") % F.lit(size)).cast("int") + 1}
    ).drop("__at")


def _bucket_rows(facts: DataFrame, on: list[str], buckets: int) -> DataFrame:
    """Rows per key bucket as (__b, __n), one row for every bucket."""
    sizes = facts.groupBy(_bucket(on, buckets).alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
    every = facts.sparkSession.range(buckets).select(F.col("id").alias("__b"))
    return every.join(sizes, "__b", "left").select("__b", F.coalesce("__n", F.lit(0)).alias("__n"))


def salt_table(facts: DataFrame, on: list[str], rows_per_salt: int = ROWS_PER_SALT, buckets: int = SALT_BUCKETS) -> Column:
    """Array of the number of salts per key bucket, computed before the main plan; its length is ``buckets``."""
    salts = F.ceil(F.col("__n") / F.lit(rows_per_salt))
    entry = F.struct("__b", F.greatest(F.lit(1), salts).cast("int").alias("m"))
    listed = _bucket_rows(facts, on, buckets).agg(F.sort_array(F.collect_list(entry)).alias("s"))
    return listed.select(F.transform("s", lambda x: x["m"]).alias("s")).scalar()


def hot_table(facts: DataFrame, on: list[str], rows_per_task: int = ROWS_PER_TASK, buckets: int = SALT_BUCKETS) -> Column:
    """Array that tells per key bucket whether it has too many rows for one task, computed before the main plan.

    Too many is more than an even share of the shuffle partitions and more than ``rows_per_task``. ``is_hot`` reads it, for
    the facts and for whatever meets them by the same key.
    """
    tasks = max(2, int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    entry = F.sort_array(F.collect_list(F.struct("__b", "__n"))).alias("s")
    listed = _bucket_rows(facts, on, buckets).agg(entry, F.sum("__n").alias("__all"))
    most = F.greatest(F.lit(rows_per_task), F.col("__all") / F.lit(tasks))
    return listed.select(F.transform("s", lambda x: x["__n"] > most).alias("s")).scalar()


def is_hot(hot: Column, on: list[str], buckets: int = SALT_BUCKETS) -> Column:
    return F.get(hot, _bucket(on, buckets).cast("int"))


def _bucket(on: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*on), F.lit(buckets))


def lookup_hot(
    facts: DataFrame, dim: DataFrame, on: list[str], how: str = "left", rows_per_salt: int = ROWS_PER_SALT,
    buckets: int = SALT_BUCKETS,
) -> DataFrame:
    """Inner or left join of facts to a dimension when any number of fact keys may be hot.

    Rows per key bucket are counted first; a bucket with more than ``rows_per_salt`` rows gets as many salts. A fact takes
    one salt by the hash of its row, a dimension row is repeated for every salt of its bucket. Both sides read the number
    from the same array, so nobody needs a list of keys and every fact meets each of its dimension rows once. Fact rows
    equal in all columns share a salt.
    """
    if how not in ("left", "inner"):
        raise ValueError("lookup_hot joins left or inner")
    table = salt_table(facts, on, rows_per_salt, buckets)
    salts = F.get(F.col("__salts"), _bucket(on, buckets).cast("int"))
    row = F.xxhash64(F.lit(SAMPLE_SEED), *[F.col(f"`{c}`") for c in _orderable(facts)])
    left = facts.withColumn("__salts", table).withColumn("__salt", F.pmod(row, salts).cast("int")).drop("__salts")
    right = dim.withColumn("__salts", table).withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("__salts")
    return left.join(right, [*on, "__salt"], how).drop("__salt")
