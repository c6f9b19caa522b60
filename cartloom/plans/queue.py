"""Work queue: gate, state changes, documents written back, identity policy, error triage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.config import ERROR_TEXTS
from cartloom.functions import text as tx

# The states of an order and the attempts value that parks it for good.
PENDING, PARTY, ORDER, DONE, LABEL, SHIPPED = 1, 2, 3, 4, 7, 8
PARKED = 99


def pending(queue: DataFrame, state: int, max_attempts: int, n: int | None = None, key: str = "id") -> DataFrame:
    """Rows of one state with attempts left; with ``n``, the first ones by key."""
    due = queue.where((F.col("state") == state) & (F.col("attempts") <= max_attempts))
    return due if n is None else due.orderBy(key).limit(n)


def due_window(queue: DataFrame, created: str, start: Column, switch: Column, early: Column) -> DataFrame:
    """Rows created from ``switch`` on, and those from ``start`` on that satisfy ``early``."""
    at = F.col(created)
    return queue.where(((at >= start) & (at < switch) & early) | (at >= switch))


def expire_old(queue: DataFrame, created: Column, cutoff: Column, state: int, to: int) -> DataFrame:
    """Untried rows of one state created before the cut-off leave the queue."""
    old = (F.col("state") == state) & (F.col("attempts") == 0) & (created < cutoff)
    return queue.withColumn("state", F.when(F.coalesce(old, F.lit(False)), F.lit(to)).otherwise(F.col("state")))


def advance_state(queue: DataFrame, matched: DataFrame, on: list[str], to: Column, when: Column | None = None) -> DataFrame:
    """Rows found in ``matched`` (and satisfying ``when``) move on and start clean."""
    found = matched.select(*on).distinct().withColumn("__found", F.lit(True))
    hit = F.col("__found").isNotNull()
    if when is not None:
        hit = hit & F.coalesce(when, F.lit(False))
    out = queue.join(found, on, "left").withColumn("__hit", hit)
    for c, v in {"attempts": F.lit(0), "out_document": F.lit(None), "endpoint": F.lit(None)}.items():
        if c in queue.columns:
            out = out.withColumn(c, F.when(F.col("__hit"), v).otherwise(F.col(c)))
    return out.withColumn("state", F.when(F.col("__hit"), to).otherwise(F.col("state"))).drop("__found", "__hit")


def attach_document(queue: DataFrame, documents: DataFrame, key: str, endpoint: str, state: int | None = None) -> DataFrame:
    """Write built documents onto their queue rows, tagged with the endpoint, attempts reset."""
    new = documents.select(key, F.col("json").alias("__json"))
    has = F.col("__json").isNotNull()
    out = (
        queue.join(new, key, "left")
        .withColumn("out_document", F.coalesce("__json", "out_document"))
        .withColumn("endpoint", F.when(has, F.lit(endpoint)).otherwise(F.col("endpoint")))
        .withColumn("attempts", F.when(has, F.lit(0)).otherwise(F.col("attempts")))
    )
    if state is not None:
        out = out.withColumn("state", F.when(has, F.lit(state)).otherwise(F.col("state")))
    return out.drop("__json")


def step(queue: DataFrame, outcome: Column, pass_without_id: bool = False) -> DataFrame:
    """Next state and attempts from the outcome of one run.

    ``ok`` moves on; ``no_id`` moves on or counts an attempt, by policy; ``parked`` is never
    tried again; anything else counts an attempt.
    """
    moves = outcome == "ok"
    if pass_without_id:
        moves = moves | (outcome == "no_id")
    attempts = (
        F.when(moves, F.lit(0)).when(outcome == "parked", F.lit(PARKED)).otherwise(F.col("attempts") + 1)
    )
    return queue.withColumn("state", F.when(moves, F.col("state") + 1).otherwise(F.col("state"))).withColumn(
        "attempts", attempts.cast("int")
    )


def party_id(billing: Column, customer: Column, fallback: str | None = None) -> Column:
    """First of the two ids that holds digits, with digits and hyphens only; else the fallback."""
    def usable(c: Column) -> Column:
        return F.when(tx.digits_only(c).try_cast("decimal(30,0)").isNotNull(), tx.digits_hyphen(c))

    return F.coalesce(usable(billing), usable(customer), F.lit(fallback).cast("string"))


def id_outcome(c: Column, park: bool = False) -> Column:
    """Outcome of the identity check: orders without an id are parked or retried."""
    return F.when(c.isNotNull() & (c != ""), F.lit("ok")).otherwise(F.lit("parked" if park else "no_id"))


def reconcile_created(queue: DataFrame, erp: DataFrame, key: str, reference: str, state: int, max_attempts: int) -> DataFrame:
    """Queue rows whose expected reference already exists in the ERP advance one state."""
    known = erp.select(F.col(reference).alias(key))
    due = (F.col("state") == state) & (F.col("attempts") <= max_attempts)
    return advance_state(queue, known, [key], F.col("state") + 1, due)


def triage_errors(df: DataFrame, log: str, rules: dict[str, str] | None = None) -> DataFrame:
    """One row per (order, error category); other logs that mention an error are ``other``."""
    rules = rules or ERROR_TEXTS
    named = F.array(*[F.when(tx.ci(F.col(log)).contains(t.lower()), F.lit(k)) for k, t in rules.items()])
    hits = F.filter(named, lambda x: x.isNotNull())
    other = F.when((F.size(hits) == 0) & tx.ci(F.col(log)).contains("error"), F.array(F.lit("other")))
    return df.withColumn("category", F.explode(F.coalesce(other, hits)))
