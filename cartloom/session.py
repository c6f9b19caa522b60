"""Session settings the dataflows expect, and a local builder for tests and bench."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Results depend on the time zone, so it is set whatever the cluster chose.
TIME_ZONE = ("spark.sql.session.timeZone", "UTC")
# Performance settings; a cluster that already chose a value keeps it.
RUNTIME_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when a later step wants the same partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Fix the time zone and, where nothing is set, let AQE split hot join partitions."""
    spark.conf.set(*TIME_ZONE)
    chosen = spark.conf.getAll
    for key, value in RUNTIME_DEFAULTS.items():
        if key not in chosen:
            spark.conf.set(key, value)
    return spark


def local_session(app: str = "cartloom", cpus: str | int = "*", partitions: int = 8) -> SparkSession:
    """A one-machine session for tests and bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", os.environ.get("CARTLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared checkpoint folder that the cluster names in spark.checkpoint.dir.

    Only a session that runs in one process may do without: it gets a scratch folder of its own.
    """
    folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not re.match(r"local(\[|$)", spark.sparkContext.master):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="cartloom-checkpoints-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Rows written once to the shared checkpoint folder, so later passes do not redo them.

    Survives the loss of executors, which would take local copies with them.
    """
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()
