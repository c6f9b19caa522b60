"""One round of the work queue: due orders become documents, the queue moves on, rejects count an attempt.

The queue is a bucketed state (``operators/state.py``) with the columns of ``QUEUE_SCHEMA`` and the key ``id``. The due rows
are built once; what they lead to is written once, as the partitions ``queue``, ``document`` and ``reject`` of the round's
folder. The queue takes the round over by a merge whose manifest names the batch, so a round that is repeated after a loss
finds its batch there and changes nothing, and one that was lost before is simply done again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.functions.text import log_text
from cartloom.operators import state as bs
from cartloom.plans.queue import id_outcome, pending, step

QUEUE_SCHEMA = "id long, state int, attempts int, document string, out_document string, endpoint string, reason string"
ROUND_SCHEMA = "id long, state int, attempts int, out_document string, endpoint string, reason string, kind string"
FOLLOWED = ["state", "attempts", "out_document", "endpoint", "reason"]
LOG_SCHEMA = (
    "description string, started_at timestamp, ended_at timestamp, success boolean, total_rows long, new_rows long, updated_rows long, "
    "kept_rows long, rejected_rows long, buckets_written long"
)


@dataclass
class Round:
    """What a round left behind; ``done_before`` where its batch had already been taken over."""

    documents: DataFrame
    rejects: DataFrame
    stats: dict[str, int]
    done_before: bool


def fan_out(due: DataFrame, built: DataFrame, endpoint: str, park: bool = False) -> DataFrame:
    """Rows of the round: per due order its next queue row, and its document or its reject.

    ``built`` has id, json and reason, at most one row an id. An order without a document is a reject: it keeps its state and
    counts an attempt, or is parked for good.
    """
    told = due.select("id", "state", "attempts", F.col("endpoint").alias("__endpoint"), F.col("out_document").alias("__out")).join(
        built.select("id", "json", F.col("reason").alias("__reason")), "id", "left"
    )
    outcome = id_outcome(F.col("json"), park)
    moved = step(told, outcome).withColumn("reason", F.when(F.col("json").isNull(), F.coalesce("__reason", F.lit("no document"))))
    ok = F.col("json").isNotNull()

    def row(kind: str):
        return F.struct(
            "id", "state", "attempts", F.coalesce("json", "__out").alias("out_document"),
            F.when(ok, F.lit(endpoint)).otherwise(F.col("__endpoint")).alias("endpoint"), "reason", F.lit(kind).alias("kind"),
        )

    rows = F.array(row("queue"), F.when(ok, row("document")).otherwise(row("reject")))
    return moved.select(F.inline(rows))


def queue_round(
    spark: SparkSession, folder: str, batch: str, build: Callable[[DataFrame], DataFrame], state: int, max_attempts: int, endpoint: str,
    n: int | None = None, park: bool = False,
) -> Round:
    """Build the due orders' documents and move the queue in ``folder`` on; ``batch`` names the round.

    ``build`` gets the due queue rows and returns id, json, reason. With ``n`` only the first due orders by id are taken.
    """
    place = f"{folder}/rounds/{batch}"
    manifest = bs.current(spark, folder)
    done_before = batch in manifest.batches
    stats: dict[str, int] = {}
    if not done_before:
        due = pending(bs.read_state(spark, folder, manifest=manifest), state, max_attempts, n)
        fan_out(due, build(due), endpoint, park).write.mode("overwrite").partitionBy("kind").parquet(place)
        moved = read_round(spark, place, "queue")
        stats = bs.merge_bucketed(spark, folder, moved, FOLLOWED, {}, batch=batch)
    documents = read_round(spark, place, "document").select("id", F.col("out_document").alias("json"), "endpoint")
    rejects = read_round(spark, place, "reject").select("id", "state", "attempts", "reason")
    return Round(documents, rejects, stats, done_before)


def read_round(spark: SparkSession, place: str, kind: str) -> DataFrame:
    return spark.read.schema(ROUND_SCHEMA).parquet(place).where(F.col("kind") == kind).drop("kind")


def log_merge(
    spark: SparkSession, log: str, description: str, started: datetime, ended: datetime, stats: dict[str, int], success: bool = True
) -> None:
    """One log row of a merge, with the counts that its write observed."""
    counts = [stats.get(c, 0) for c in ("total_rows", "new_rows", "updated_rows", "kept_rows", "rejected_rows", "buckets_written")]
    row = spark.createDataFrame([(description, started, ended, success, *counts)], LOG_SCHEMA)
    row.withColumn("description", log_text(F.col("description"))).coalesce(1).write.mode("append").parquet(log)


def read_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(log)
