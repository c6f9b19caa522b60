"""Queue rounds: documents, next state and rejects; repeated and lost rounds."""

import json

import pytest
from pyspark.sql import functions as F

from cartloom.config import PartyConfig
from cartloom.operators import state as bs
from cartloom.plans import rounds as rd
from cartloom.plans.parties import build_party_docs
from cartloom.sources.schemas import ORDER_A
from cartloom.sources.tables import parse_documents
from tests.test_hazards import order, places


def queue(spark, folder, rows):
    full = [(i, s, a, d, None, None, None) for i, s, a, d in rows]
    bs.create_state(spark.createDataFrame(full, rd.QUEUE_SCHEMA), folder, ["id"], 4)


def party_builder(spark):
    """The shop's order texts to party documents; unreadable ones and those without an identity are rejects."""

    def build(due):
        read = parse_documents(due.select(F.col("id"), F.col("id").cast("string").alias("order_id"), "document"), "document", ORDER_A)
        docs = build_party_docs(read.where("reject_reason is null"), places(spark), PartyConfig())
        keyed = read.select("id", "reject_reason", F.col("doc.name").alias("name"))
        return keyed.join(docs.select(F.col("idOrden").alias("name"), "json"), "name", "left").select(
            "id", "json", F.when(F.col("json").isNull(), F.coalesce("reject_reason", F.lit("no identity"))).alias("reason")
        )

    return build


def state_of(spark, folder):
    return {r["id"]: (r["state"], r["attempts"], r["endpoint"], r["reason"]) for r in bs.read_state(spark, folder).collect()}


def test_round_from_order_texts_to_queue(spark, tmp_path):
    folder = str(tmp_path / "queue")
    nobody = order("#2")
    for part in (nobody["customer"]["default_address"], nobody["billing_address"]):
        part["company"] = ""
    queue(spark, folder, [
        (1, 1, 2, json.dumps(order("#1"))), (2, 1, 0, json.dumps(nobody)), (3, 1, 1, "{broken"), (4, 1, 4, json.dumps(order("#4"))), (5, 2, 0, None)])
    done = rd.queue_round(spark, folder, "b1", party_builder(spark), 1, 3, "party")
    assert state_of(spark, folder) == {
        1: (2, 0, "party", None), 2: (1, 1, None, "no identity"), 3: (1, 2, None, "unreadable document"), 4: (1, 4, None, None), 5: (2, 0, None, None)}
    docs = done.documents.collect()
    assert [d["id"] for d in docs] == [1] and "Terceros" in json.loads(docs[0]["json"])
    assert sorted((r["id"], r["attempts"], r["reason"]) for r in done.rejects.collect()) == [(2, 1, "no identity"), (3, 2, "unreadable document")]
    assert done.stats["updated_rows"] == 3 and not done.done_before
    again = rd.queue_round(spark, folder, "b1", party_builder(spark), 1, 3, "party")
    assert again.done_before and state_of(spark, folder)[2] == (1, 1, None, "no identity") and again.documents.count() == 1
    rd.queue_round(spark, folder, "b2", party_builder(spark), 1, 3, "party", park=True)
    assert state_of(spark, folder)[2][1] == 99 and state_of(spark, folder)[1][0] == 2


def test_a_lost_round_is_done_again(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "queue")
    queue(spark, folder, [(i, 1, 0, "x") for i in range(20)])
    build = lambda due: due.select("id", F.when(F.col("id") % 2 == 0, F.lit("{}")).alias("json"), F.lit(None).cast("string").alias("reason"))
    before = state_of(spark, folder)

    def lost(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(bs, "merge_bucketed", lost)
        with pytest.raises(RuntimeError):
            rd.queue_round(spark, folder, "b1", build, 1, 3, "party", n=10)
    assert state_of(spark, folder) == before
    done = rd.queue_round(spark, folder, "b1", build, 1, 3, "party", n=10)
    assert sorted(r["id"] for r in done.documents.collect()) == [0, 2, 4, 6, 8]
    assert {i: s[:2] for i, s in state_of(spark, folder).items() if i < 11} == {i: (2, 0) if i % 2 == 0 else (1, 1) for i in range(10)} | {10: (1, 0)}


def test_log_rows_keep_the_counts_of_the_write(spark, tmp_path):
    from datetime import datetime

    log, t = str(tmp_path / "log"), datetime(2024, 2, 1, 10)
    for k in range(2):
        rd.log_merge(spark, log, "stock\n<b>", t, t, {"total_rows": 5, "new_rows": k})
    told = rd.read_log(spark, log).orderBy("new_rows").collect()
    assert [(r["total_rows"], r["new_rows"], r["updated_rows"], r["success"]) for r in told] == [(5, 0, 0, True), (5, 1, 0, True)]
    assert "\n" not in told[0]["description"]
