"""Polling a queue folder: every arriving set of orders becomes documents once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def follow_queue(spark: SparkSession, path: str, schema: str, state: int, max_attempts: int) -> DataFrame:
    """New queue rows as a stream, already gated by state and attempts."""
    rows = spark.readStream.schema(schema).parquet(path)
    return rows.where((F.col("state") == state) & (F.col("attempts") <= max_attempts))


def drain(feed: DataFrame, build: Callable[[DataFrame], DataFrame], out: str, progress: str) -> StreamingQuery:
    """Build and write the documents of everything that has arrived, then stop.

    Each batch owns one folder, so a batch that is run again after a failure replaces its
    own output and nothing else. ``progress`` is a lasting folder of this feed alone: it remembers
    what has been issued, so a restarted feed issues no order twice.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        build(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        feed.writeStream.foreachBatch(write).option("checkpointLocation", progress).trigger(availableNow=True).start()
    )
