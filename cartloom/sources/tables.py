"""Reading source tables, queues and document columns."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.operators.temporal import keep_one
from cartloom.session import checkpoint_folder
from cartloom.sources.schemas import fields


def read_source(
    spark: SparkSession, path: str, columns: list[str] | None = None, predicate: Column | None = None,
    fmt: str = "parquet", options: dict | None = None, schema: str | None = None,
) -> DataFrame:
    """A base table with only the needed columns and rows; both reach the scan.

    A declared ``schema`` saves opening file footers before the plan is built.
    ``fmt="jdbc"`` with ``dbtable``, ``query`` or ``partitionColumn`` options reads an ERP
    database the same way, the projection and predicate then run in that database.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load() if fmt == "jdbc" else reader.load(path)
    if predicate is not None:
        df = df.where(predicate)
    return df.select(*columns) if columns else df


def read_queue(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def whole(c: Column) -> Column:
    """Quantity cut to whole units at the source, as a narrower row to move."""
    return c.cast("int")


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def parse_documents(df: DataFrame, column: str, schema: str, into: str = "doc") -> DataFrame:
    """Document text to a typed struct; unreadable text gives a reject reason, not a failure.

    The one-element explode keeps the parse in one place: as a plain projection it would
    be inlined into every later filter and the text parsed again for each.
    """
    parse = F.from_json(
        F.col(column), f"{schema}, _corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"}
    )
    parsed = df.select("*", F.explode(F.array(parse)).alias(into))
    bad = F.col(into).isNull() | F.col(f"{into}._corrupt_record").isNotNull()
    return parsed.withColumn("reject_reason", F.when(bad, F.lit("unreadable document")))


def store_documents(df: DataFrame, column: str, path: str, into: str = "stored") -> DataFrame:
    """Documents parsed once into a VARIANT column, written to ``path`` and read back from there.

    Jobs that read several paths or sections, or the same documents more than once, then take them from the stored form;
    the text is not parsed again and whatever made it does not run again. Unreadable text is kept as a null variant.
    """
    stored = df.withColumn(into, F.try_parse_json(F.col(column))).drop(column)
    stored.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def store_rows(df: DataFrame) -> DataFrame:
    """Rows written once to the shared checkpoint folder as Parquet and read back: what made them runs once for all readers."""
    path = f"{checkpoint_folder(df.sparkSession)}/rows-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def from_stored(df: DataFrame, schema: str, column: str = "stored", into: str = "doc") -> DataFrame:
    """Stored documents as a typed struct of the wanted fields, with the same reject reason as ``parse_documents``.

    Only an object becomes a struct, so the struct itself tells which documents are readable: no schema of the whole document
    is worked out. The one-element explode keeps the read in one place, as in ``parse_documents``.
    """
    shape = ", ".join(f.replace(" ", ": ", 1) for f in fields(schema))
    read = F.try_variant_get(F.col(column), "$", f"struct<{shape}>")
    typed = df.select("*", F.explode(F.array(read)).alias(into))
    return typed.withColumn("reject_reason", F.when(F.col(into).isNull(), F.lit("unreadable document"))).drop(column)


def stored_value(column: str, path: Column | str, kind: str = "string") -> Column:
    """A value of a stored document by a path that may be known only at run time; NULL where the path leads nowhere."""
    return F.try_variant_get(F.col(column), path, kind)


def successful_payments(transactions: DataFrame, order: list[str]) -> DataFrame:
    """One successful payment per order, read from the transaction documents."""
    read = transactions.select(
        "order_id",
        *order,
        F.get_json_object("document", "$.gateway").alias("gateway"),
        F.get_json_object("document", "$.status").alias("status"),
    ).where("status = 'success'")
    return keep_one(read, ["order_id"], [F.col(o) for o in order]).select("order_id", "gateway")


def write_documents(df: DataFrame, path: str, fmt: str = "json") -> None:
    df.write.mode("errorifexists").format(fmt).save(path)
