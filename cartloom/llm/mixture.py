"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

A source's target is its weight's share of all sizes, at most ``max_repeats`` times its own size; what a capped source
cannot take is shared out again by weight. The target over the source's size is the expected number of copies of each of
its documents. Documents of a source stand in the order (size, digest of the id, id), so a systematic sample meets every
size in proportion. Expected copies are prefix-summed in that order, one random offset is added, and a document is emitted
once for each whole number that its interval crosses.

The prefix sum is split: positions are counted inside (source, size, first digits of the digest), and the counts of those
groups are summed by two small windows, so a source with a third of all rows is spread over many tasks. Only the table of
source names, one row each, is ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartloom.llm import common as C

MAX_REPEATS = 3
SEED = 17
PREFIX_DIGITS = 3


def word_count(text: Column) -> Column:
    """Number of runs of anything but space and control characters 9 to 13; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def cyclic_weight(rank: Column) -> Column:
    """1, 2, 3, 1, ... for ranks from 1."""
    return (F.pmod(rank - 1, F.lit(3)) + 1).cast("double")


def source_targets(sizes: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size) rows with weight, target and rate, the expected copies of each document.

    Sources are ranked by code point, null last. Capping is a prefix of the order by size over weight: a source is capped
    when the sizes left to share, at the weights left, would give it more than its cap.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sizes.withColumn("rank", F.row_number().over(by_name)).withColumn("weight", cyclic_weight(F.col("rank")))
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("rank"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    shared = ranked.select(
        "source", "source_size", "weight",
        (F.sum("source_size").over(everything) - max_repeats * F.coalesce(F.sum("source_size").over(before), F.lit(0))).alias("left"),
        F.sum("weight").over(after).alias("weights_left"),
        F.row_number().over(by_ratio).alias("place"),
    )
    capped = F.col("weight") * F.col("left") / F.col("weights_left") > max_repeats * F.col("source_size")
    # The first source that stays below its cap sets the level of all after it.
    level = F.min_by(F.struct("left", "weights_left"), F.when(~capped, F.col("place")))
    leveled = shared.withColumn("level", level.over(everything))
    below = F.col("weight") * F.col("level.left") / F.col("level.weights_left")
    target = F.least(F.coalesce(below, F.lit(float("inf"))), (max_repeats * F.col("source_size")).cast("double"))
    return leveled.select(
        "source", "source_size", "weight", target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"),
    )


def _offset(source: Column, seed: int) -> Column:
    """A source's random offset in (0, 1), from the seed and its name."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(source, F.lit("")), F.when(source.isNull(), F.lit("|")).otherwise(F.lit(""))))
    return (F.conv(F.substring(digest, 1, 4), 16, 10).cast("double") + 0.5) / 65536.0


def plan_mix(documents: DataFrame, max_repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """Per row of documents: doc_id, source, size, source_size, target, rate, copies, position (from 1 in its source).

    A null text has size 0; the null source ranks last; documents of a source without words get no copies. Equal rows take
    separate places, in any order among themselves. An empty table gives no rows.
    """
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    base = C.settle(
        documents.select("doc_id", "source", word_count(F.col("text")).alias("size"), digest.alias("digest"))
    )
    return _positions(base, max_repeats, seed).drop("digest")


def _positions(base: DataFrame, max_repeats: int, seed: int) -> DataFrame:
    keyed = base.withColumns({
        "no_source": F.col("source").isNull(), "name": F.coalesce("source", F.lit("")),
        "prefix": F.substring("digest", 1, PREFIX_DIGITS),
    })
    source = ["no_source", "name"]
    groups = keyed.groupBy(*source, "size", "prefix").agg(F.count("*").alias("rows"))
    in_size = groups.groupBy(*source, "size").agg(F.sum("rows").alias("rows"))
    earlier = Window.unboundedPreceding
    offsets = in_size.select(
        *source, "size",
        F.coalesce(F.sum("rows").over(Window.partitionBy(*source).orderBy("size").rowsBetween(earlier, -1)), F.lit(0)).alias("smaller"),
    )
    sizes = in_size.groupBy(*source).agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    targets = source_targets(
        sizes.select(F.when(~F.col("no_source"), F.col("name")).alias("source"), "source_size"), max_repeats
    ).select(
        F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("name"), "source_size", "target", "rate"
    )
    starts = (
        groups.withColumn(
            "start",
            F.coalesce(F.sum("rows").over(Window.partitionBy(*source, "size").orderBy("prefix").rowsBetween(earlier, -1)), F.lit(0)),
        )
        .join(offsets, [*source, "size"])
        .join(targets, source)
        .select(*source, "size", "prefix", (F.col("start") + F.col("smaller")).alias("start"), "source_size", "target", "rate")
    )
    inside = F.row_number().over(Window.partitionBy(*source, "size", "prefix").orderBy("digest", "doc_id"))
    placed = keyed.withColumn("inside", inside).join(starts, [*source, "size", "prefix"])
    position = F.col("start") + F.col("inside")
    offset = _offset(F.col("source"), seed)
    copies = F.floor(position * F.col("rate") + offset) - F.floor((position - 1) * F.col("rate") + offset)
    return placed.select(
        "doc_id", "source", "size", "digest", "source_size", "target", "rate", copies.cast("long").alias("copies"), position.alias("position")
    )


def mix_sources(documents: DataFrame, max_repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """The mix itself: every document row repeated by its copies, all columns kept.

    Rows are told apart by id, source and text; equal ones by a number, so each takes its own copies. The texts move once.
    """
    same = ["doc_id", "source", "__text"]
    numbered = documents.withColumn("__text", F.xxhash64("text"))
    nth = F.row_number().over(Window.partitionBy(*same).orderBy("doc_id"))
    small = numbered.select("doc_id", "source", "__text", word_count(F.col("text")).alias("size")).withColumn("__nth", nth)
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    base = C.settle(small.select(F.struct("doc_id", "__text", "__nth").alias("doc_id"), "source", "size", digest.alias("digest")))
    planned = _positions(base, max_repeats, seed).where("copies > 0")
    copies = planned.select(*[F.col(f"doc_id.{c}").alias(f"{c}_") for c in ("doc_id", "__text", "__nth")], F.col("source").alias("source_"), F.col("copies").alias("__copies"))
    rows = numbered.withColumn("__nth", nth)
    on = [rows[c].eqNullSafe(copies[f"{c}_"]) for c in ("doc_id", "source", "__text", "__nth")]
    mixed = rows.join(copies, on).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return mixed.select(*[F.col(f"`{c}`") for c in documents.columns])


def op1_mix(spark, sf_dir: str) -> DataFrame:
    plan = plan_mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP1_SQL = f"""
WITH base AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS digest
  FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM base GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS rank FROM sizes
), weighed AS (
  SELECT *, ((rank - 1) % 3 + 1)::DOUBLE AS weight FROM ranked
), shared AS (
  SELECT *,
    (sum(source_size) OVER () - {MAX_REPEATS} * coalesce(sum(source_size) OVER (ORDER BY source_size / weight, rank
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS lft,
    sum(weight) OVER (ORDER BY source_size / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wl,
    row_number() OVER (ORDER BY source_size / weight, rank) AS place
  FROM weighed
), level AS (
  SELECT lft, wl FROM shared WHERE NOT weight * lft / wl > {MAX_REPEATS} * source_size ORDER BY place LIMIT 1
), targets AS (
  SELECT s.source, s.source_size,
    least(coalesce(s.weight * l.lft / l.wl, 'inf'::DOUBLE), ({MAX_REPEATS} * s.source_size)::DOUBLE) AS target
  FROM shared s LEFT JOIN level l ON true
), placed AS (
  SELECT b.*, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
    row_number() OVER (PARTITION BY b.source ORDER BY b.size, b.digest, b.doc_id) AS position,
    (('0x' || substr(md5('{SEED}|' || coalesce(b.source, '') || CASE WHEN b.source IS NULL THEN '|' ELSE '' END), 1, 4))::INT
      + 0.5) / 65536.0 AS u
  FROM base b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  ((floor(position * rate + u) - floor((position - 1) * rate + u)) * size)::BIGINT AS taken
FROM placed
"""
