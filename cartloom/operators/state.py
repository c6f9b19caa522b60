"""State tables as buckets of files behind a manifest: an upsert writes only the buckets it changes.

A row's bucket follows from the hash of its key. The manifest of a version names the files of every bucket, with the number
of rows and a digest of what they hold; it is a single small file, so a version exists as a whole or not at all. New files
go to a folder of their own run and no file is ever replaced: a run that is lost leaves the version before it as it was,
and readers of an older version are not disturbed. The driver holds one manifest, one entry a bucket; the number of buckets
is chosen when the state is created.

    folder/manifest/version=N/part-*.parquet
    folder/data/<run>/__bucket=B/part-*.parquet
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartloom.operators.merge import INSERT, KEEP, UPDATE, merge_changed, one_per_key
from cartloom.session import settle

BUCKETS = 64
BUCKET = "__bucket"
DIGEST = ("rows", "xor1", "xor2", "sum1", "sum2")
ENTRY = "bucket int, path string, " + ", ".join(f"{d} long" for d in DIGEST) + ", run string, batch string, meta string"


class StateConflict(RuntimeError):
    """Another run committed the same version first; the state holds that run's work."""


@dataclass
class Manifest:
    version: int
    keys: list[str]
    buckets: int
    schema: StructType
    entries: dict[int, dict] = field(default_factory=dict)
    batches: set[str] = field(default_factory=set)


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _row_hash(columns: list[str], seed: int) -> Column:
    """Hash of typed values that tells a null from an absent neighbour."""
    return F.xxhash64(F.lit(seed), *[part for c in columns for part in (F.col(c).isNull(), F.col(c))])


def bucket_digests(df: DataFrame, columns: list[str], bucket: Column) -> DataFrame:
    """(bucket, rows, xor1, xor2, sum1, sum2): two hashes a row, combined so that order does not matter.

    Exclusive or alone would lose pairs of equal rows; the sums of the hashes' lower halves, and the count, keep them.
    Aggregated map-side: one row a bucket and task is shuffled.
    """
    low = F.lit(0x7FFFFFFF)
    hashed = df.select(bucket.alias("bucket"), _row_hash(columns, 1).alias("h1"), _row_hash(columns, 2).alias("h2"))
    return hashed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor("h1").alias("xor1"), F.bit_xor("h2").alias("xor2"),
        F.sum(F.col("h1").bitwiseAND(low)).alias("sum1"), F.sum(F.col("h2").bitwiseAND(low)).alias("sum2"),
    )


def current(spark: SparkSession, folder: str) -> Manifest | None:
    """Manifest of the newest version, or None where no version was ever committed."""
    try:
        told = spark.read.schema(f"{ENTRY}, version int").parquet(f"{folder}/manifest")
        version = told.agg(F.max("version")).first()[0]
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err):
            raise
        return None
    if version is None:
        return None
    rows = [r.asDict() for r in told.where(F.col("version") == version).collect()]
    winner = min(r["run"] for r in rows if r["bucket"] == -1)
    winners = told.where("bucket = -1").groupBy("version").agg(F.min_by("batch", "run").alias("batch"))
    batches = {r["batch"] for r in winners.where("batch is not null").collect()}
    head = json.loads(next(r["meta"] for r in rows if r["bucket"] == -1 and r["run"] == winner))
    entries = {r["bucket"]: r for r in rows if r["bucket"] >= 0 and r["meta"] == winner}
    return Manifest(version, head["keys"], head["buckets"], StructType.fromJson(head["schema"]), entries, batches)


def read_state(spark: SparkSession, folder: str, buckets: list[int] | None = None, manifest: Manifest | None = None) -> DataFrame:
    """Rows of the newest version; with ``buckets``, only the files of those are opened."""
    manifest = manifest or current(spark, folder)
    if manifest is None:
        raise FileNotFoundError(f"no state in {folder}")
    wanted = manifest.entries if buckets is None else [b for b in buckets if b in manifest.entries]
    paths = [f"{folder}/{manifest.entries[b]['path']}" for b in wanted]
    if not paths:
        return spark.createDataFrame([], manifest.schema)
    return spark.read.schema(manifest.schema).parquet(*paths)


def _write_buckets(df: DataFrame, folder: str, run: str, keys: list[str], buckets: int, touched: int) -> None:
    bucketed = df.withColumn(BUCKET, bucket_of(keys, buckets)).repartition(max(1, touched), BUCKET)
    bucketed.write.mode("errorifexists").partitionBy(BUCKET).parquet(f"{folder}/data/{run}")


def _entries(spark: SparkSession, folder: str, run: str, schema: StructType, keys: list[str], buckets: int) -> dict[int, dict]:
    """Entries of the files a run wrote, with their digests."""
    try:
        written = spark.read.schema(schema).parquet(f"{folder}/data/{run}")
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err):
            raise
        return {}
    digests = bucket_digests(written, schema.names, bucket_of(keys, buckets)).collect()
    return {d["bucket"]: {**d.asDict(), "path": f"data/{run}/{BUCKET}={d['bucket']}", "run": run, "batch": None} for d in digests}


def _commit(spark: SparkSession, folder: str, manifest: Manifest, run: str, batch: str | None) -> None:
    """One file for the whole version; where two runs meet, the smaller run name holds and the other is told."""
    head = json.dumps({"keys": manifest.keys, "buckets": manifest.buckets, "schema": manifest.schema.jsonValue()})
    names = ["bucket", "path", *DIGEST, "run", "batch"]
    rows = [tuple(e[n] for n in names) + (run,) for e in manifest.entries.values()]
    rows.append((-1, None, *[None] * len(DIGEST), run, batch, head))
    made = spark.createDataFrame(rows, ENTRY).withColumn("version", F.lit(manifest.version))
    made.coalesce(1).write.mode("append").partitionBy("version").parquet(f"{folder}/manifest")
    held = spark.read.schema(f"{ENTRY}, version int").parquet(f"{folder}/manifest")
    runs = held.where((F.col("version") == manifest.version) & (F.col("bucket") == -1)).agg(F.min("run")).first()[0]
    if runs != run:
        raise StateConflict(f"version {manifest.version} of {folder} belongs to run {runs}")


def create_state(df: DataFrame, folder: str, keys: list[str], buckets: int = BUCKETS) -> Manifest:
    """First version of a state; one row per key (the smallest by its other columns), rows with a null in the key left out."""
    spark, run = df.sparkSession, uuid.uuid4().hex
    if current(spark, folder) is not None:
        raise FileExistsError(f"{folder} already holds a state")
    rows = one_per_key(df.dropna(subset=keys), keys).select(*df.columns)
    _write_buckets(rows, folder, run, keys, buckets, buckets)
    entries = _entries(spark, folder, run, rows.schema, keys, buckets)
    manifest = Manifest(1, keys, buckets, rows.schema, entries)
    _commit(spark, folder, manifest, run, None)
    return manifest


def _differs(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"__new_{c}")) for c in columns], F.lit(False))


def changed_keys(state: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Source keys that the state lacks or holds with other values; reads only keys and compared columns."""
    new = source.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in columns])
    held = state.select(*keys, *columns).withColumn("__held", F.lit(True))
    return new.join(held, keys, "left").where(F.col("__held").isNull() | _differs(columns)).select(*keys)


def merge_bucketed(
    spark: SparkSession, folder: str, source: DataFrame, compare: list[str], on_change: dict[str, Column], always: list[str] = (),
    batch: str | None = None,
) -> dict[str, int]:
    """Upsert ``source`` into the state; rules as in ``merge_changed``. Returns the counts of the write itself.

    First only keys and compared columns of the touched buckets are read, to see which buckets change; then these, and no
    others, are read whole, merged and written, and one new manifest points to them and to all other files as before.
    Counts (total_rows and kept_rows of the buckets written, new_rows, updated_rows) are observed while writing, so no
    second pass counts them; rejected_rows are source rows with a null in the key. A ``batch`` that the manifest already
    names is not done again, so a run that is repeated after a loss changes nothing. Source rows of one key are reduced to
    one, the smallest by its other columns, and settled, as three steps need them.
    """
    manifest = current(spark, folder)
    if manifest is None:
        raise FileNotFoundError(f"no state in {folder}")
    nothing = {"total_rows": 0, "new_rows": 0, "updated_rows": 0, "kept_rows": 0, "rejected_rows": 0, "buckets_written": 0}
    if batch is not None and batch in manifest.batches:
        return nothing
    keys, buckets = manifest.keys, manifest.buckets
    carried = list(dict.fromkeys([*compare, *always]))
    usable = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    kept = one_per_key(source.where(usable).select(*keys, *carried), keys)
    new = settle(kept.withColumn(BUCKET, bucket_of(keys, buckets)))
    rejected = source.where(~usable).count()
    touched = sorted(r[BUCKET] for r in new.select(BUCKET).distinct().collect())
    narrow = read_state(spark, folder, touched, manifest)
    found = changed_keys(narrow, new, keys, carried).select(bucket_of(keys, buckets).alias("b")).distinct()
    changed = sorted(r["b"] for r in found.collect())
    run = uuid.uuid4().hex
    stats = {**nothing, "rejected_rows": rejected, "buckets_written": len(changed)}
    entries = dict(manifest.entries)
    if changed:
        held = read_state(spark, folder, changed, manifest)
        merged = merge_changed(held, new.where(F.col(BUCKET).isin(changed)).drop(BUCKET), keys, compare, on_change, list(always))
        counted = Observation()
        merged = merged.observe(
            counted, F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col("action") == INSERT).alias("new_rows"),
            F.count_if(F.col("action") == UPDATE).alias("updated_rows"), F.count_if(F.col("action") == KEEP).alias("kept_rows"),
        )
        _write_buckets(merged.drop("action").select(*manifest.schema.names), folder, run, keys, buckets, len(changed))
        stats.update(counted.get)
        entries.update(_entries(spark, folder, run, manifest.schema, keys, buckets))
    elif batch is None:
        return stats
    _commit(spark, folder, Manifest(manifest.version + 1, keys, buckets, manifest.schema, entries), run, batch)
    return stats


def unequal_buckets(spark: SparkSession, folder: str, source: DataFrame, columns: list[str], manifest: Manifest | None = None) -> list[int]:
    """Buckets whose digest in the manifest is not that of the source; the state's files are not opened."""
    manifest = manifest or current(spark, folder)
    told = {r["bucket"]: tuple(r[d] for d in DIGEST) for r in bucket_digests(source, columns, bucket_of(manifest.keys, manifest.buckets)).collect()}
    held = {b: tuple(e[d] for d in DIGEST) for b, e in manifest.entries.items()}
    return sorted(b for b in told.keys() | held.keys() if told.get(b) != held.get(b))


def changed_by_digest(spark: SparkSession, folder: str, source: DataFrame) -> DataFrame:
    """Keys on which the state and a full picture of it differ: ``action`` and, for every column, old_ and new_ values.

    ``action`` is insert (only in the source), delete (only in the state) or update. The source's digests per bucket are
    compared with those of the manifest; equal buckets are neither opened nor joined. The source must have the state's
    columns, one row per key.
    """
    manifest = current(spark, folder)
    keys, names = manifest.keys, manifest.schema.names
    values = [c for c in names if c not in keys]
    typed = source.select(*[F.col(c).cast(manifest.schema[c].dataType) for c in names])
    unequal = unequal_buckets(spark, folder, typed, names, manifest)
    new = typed.where(bucket_of(keys, manifest.buckets).isin(unequal)).select(*keys, *[F.col(c).alias(f"__new_{c}") for c in values], F.lit(True).alias("__told"))
    old = read_state(spark, folder, unequal, manifest).withColumn("__held", F.lit(True))
    both = old.join(new, keys, "full").where(F.col("__held").isNull() | F.col("__told").isNull() | _differs(values))
    action = F.when(F.col("__held").isNull(), F.lit(INSERT)).when(F.col("__told").isNull(), F.lit("delete")).otherwise(F.lit(UPDATE))
    return both.select(
        *keys, action.alias("action"), *[F.col(c).alias(f"old_{c}") for c in values], *[F.col(f"__new_{c}").alias(f"new_{c}") for c in values]
    )
