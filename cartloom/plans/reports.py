"""Sales lines, invoices, customer master, catalogue listings, device transactions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.functions import text as tx
from cartloom.operators.relational import nest, optional_eq
from cartloom.operators.skew import lookup_hot

INWARD = 1


def signed(amount: Column, nature: Column) -> Column:
    """Inward movements (returns) count negative."""
    return amount * F.when(nature == INWARD, F.lit(-1)).otherwise(F.lit(1))


def in_currency(local: Column, other: Column, is_local: Column) -> Column:
    return F.when(is_local, local).otherwise(other)


def document_number(kind: Column, number: Column) -> Column:
    return F.concat(F.rtrim(kind), F.lit("-"), tx.pad_left(number, 8))


def sales_lines(
    movements: DataFrame, documents: DataFrame, items: DataFrame, parties: DataFrame, warehouses: DataFrame
) -> DataFrame:
    """One row per invoiced movement with signed amounts in local currency."""
    is_local = F.col("currency") == F.col("local_currency")
    subtotal = in_currency(
        F.col("gross") - F.col("line_discount"), F.col("gross_alt") - F.col("line_discount_alt"), is_local
    )
    gross = in_currency(F.col("gross"), F.col("gross_alt"), is_local)
    described = lookup_hot(movements, items, ["item_rowid"], "inner")
    return (
        described.join(documents, "doc_id").join(parties, "party_rowid")
        .join(warehouses, "warehouse_rowid")
        .select(
            "doc_id", "line_id", "item_rowid", "warehouse_rowid", document_number(F.col("doc_type"), F.col("doc_number")).alias("document"),
            "party_name", "warehouse", F.rtrim(tx.strip_newlines(F.col("description"))).alias("description"),
            signed(F.col("quantity"), F.col("nature")).cast("decimal(28,4)").alias("quantity"),
            signed(subtotal, F.col("nature")).cast("decimal(28,2)").alias("subtotal"),
            signed(gross, F.col("nature")).cast("decimal(28,4)").alias("gross"),
            signed(F.col("tax"), F.col("nature")).cast("decimal(28,4)").alias("tax"),
            signed(F.col("net"), F.col("nature")).cast("decimal(28,4)").alias("net"),
        )
    )


def invoice_lookup(
    documents: DataFrame, references: DataFrame, stored: DataFrame, reference: str, kinds: list[str] = ()
) -> DataFrame:
    """Invoices by external reference with their stored XML where there is one."""
    rows = documents.join(references, "doc_id").join(stored, "doc_id", "left")
    if kinds:
        rows = rows.where(F.col("doc_type").isin(list(kinds)))
    return optional_eq(rows, "reference", reference, ("", "-1"))


def customer_master(
    parties: DataFrame, contacts: DataFrame, clients: DataFrame, terms: DataFrame, classes: DataFrame,
    party: str = "-1", company: int = -1,
) -> DataFrame:
    """Customers with contact, terms and their classifications as a nested list."""
    rows = optional_eq(optional_eq(parties, "party_id", party), "company_id", company)
    flat = (
        rows.join(contacts, ["contact_rowid", "company_id"]).join(clients, "party_rowid")
        .join(terms, ["terms_id", "company_id"], "left").distinct()
    )
    fields = ["plan_id", "plan_name", "major_id", "major_name"]
    on = ["party_rowid", "branch_id"]
    return nest(flat, classes.select(*on, *fields).distinct(), on, ["plan_id", "major_id"], fields, "classifications")


def entity_catalogue(
    groups: DataFrame, relations: DataFrame, entities: DataFrame, attributes: DataFrame, masters: DataFrame, details: DataFrame
) -> DataFrame:
    """Flat listing group, entity, attribute, master, master detail."""
    return (
        groups.join(relations, "group_id").join(entities, "entity_id").join(attributes, "entity_id")
        .join(masters, "master_id", "left").join(details, "master_id", "left")
    )


def device_transactions(
    tx_log: DataFrame, company: int, method: str, start: Column, end: Column, device: str | None = None, n: int | None = None
) -> DataFrame:
    """Transactions of one payment method in an open interval, newest first."""
    tests = [F.col("company_id") == company, F.col("method") == method, F.col("ts") > start, F.col("ts") < end]
    if device is not None:
        tests.append(F.col("request").contains(device))
    rows = tx_log.where(reduce(lambda a, b: a & b, tests)).orderBy(F.col("id").desc())
    return rows if n is None else rows.limit(n)
