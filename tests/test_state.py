"""Bucketed state: what is written, what survives a lost run, digests, repeated batches."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cartloom.operators import merge as mg
from cartloom.operators import state as bs

KEYS = ["item", "warehouse", "policy"]
SCHEMA = "item long, warehouse string, policy string, available long, note string, synced boolean, at timestamp"


def state_rows(n=400):
    return [(i, f"w{i % 3}", "ab"[i % 2], i * 10, None if i % 5 == 0 else "x", True, datetime(2024, 1, 1)) for i in range(n)]


@pytest.fixture
def folder(spark, tmp_path):
    path = str(tmp_path / "state")
    bs.create_state(spark.createDataFrame(state_rows(), SCHEMA), path, KEYS, 16)
    return path


def source(spark, rows):
    return spark.createDataFrame(rows, "item long, warehouse string, policy string, available long, note string")


def on_change():
    return {"synced": F.lit(False), "at": F.lit(None).cast("timestamp")}


def files(folder):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(f"{folder}/data") for f in names if f.startswith("part-")}


def rows_of(df):
    return sorted(map(repr, df.collect()))


def changes():
    return [(3, "w0", "b", 31, "x"), (4, "w1", "a", 40, "x"), (5, "w2", "b", 50, "y"), (900, "w0", "a", 1, None), (900, "w0", "a", 1, None)]


def test_merge_equals_a_full_merge(spark, folder):
    state = spark.createDataFrame(state_rows(), SCHEMA)
    want = mg.merge_changed(state, source(spark, changes()), KEYS, ["available"], on_change(), ["note"])
    stats = bs.merge_bucketed(spark, folder, source(spark, [*changes(), (None, "w0", "a", 5, "x"), (7, None, "a", 5, "x")]), ["available"], on_change(), ["note"])
    assert rows_of(bs.read_state(spark, folder)) == rows_of(want.drop("action"))
    assert (stats["new_rows"], stats["updated_rows"], stats["rejected_rows"]) == (1, 1, 2)
    assert stats["total_rows"] == stats["new_rows"] + stats["updated_rows"] + stats["kept_rows"] < 401


def test_only_changed_buckets_are_written(spark, folder):
    before = files(folder)
    old = bs.current(spark, folder)
    bs.merge_bucketed(spark, folder, source(spark, [(3, "w0", "b", 31, "x"), (4, "w1", "a", 40, "x")]), ["available"], on_change(), ["note"])
    after, new = files(folder), bs.current(spark, folder)
    assert new.version == old.version + 1
    moved = [b for b in new.entries if new.entries[b]["path"] != old.entries[b]["path"]]
    hit = spark.createDataFrame([(3, "w0", "b")], KEYS).select(bs.bucket_of(KEYS, 16).alias("b")).first()["b"]
    assert moved == [hit]
    assert all(after[f] == before[f] for f in before) and len(after) == len(before) + 1


def test_no_change_writes_nothing(spark, folder):
    before, old = files(folder), bs.current(spark, folder)
    same = source(spark, [(i, f"w{i % 3}", "ab"[i % 2], i * 10, None if i % 5 == 0 else "x") for i in range(400)])
    stats = bs.merge_bucketed(spark, folder, same, ["available"], on_change(), ["note"])
    assert stats["buckets_written"] == 0 and files(folder) == before and bs.current(spark, folder).version == old.version
    empty = bs.merge_bucketed(spark, folder, source(spark, []), ["available"], on_change(), ["note"])
    assert empty["buckets_written"] == 0


def test_a_lost_run_leaves_the_old_state(spark, folder, monkeypatch):
    before = rows_of(bs.read_state(spark, folder))

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(bs, "_commit", lost)
        with pytest.raises(RuntimeError):
            bs.merge_bucketed(spark, folder, source(spark, changes()), ["available"], on_change())
    assert rows_of(bs.read_state(spark, folder)) == before
    bs.merge_bucketed(spark, folder, source(spark, changes()), ["available"], on_change())
    assert bs.read_state(spark, folder).count() == 401


def test_a_repeated_batch_changes_nothing(spark, folder):
    first = bs.merge_bucketed(spark, folder, source(spark, changes()), ["available"], on_change(), batch="b1")
    told = rows_of(bs.read_state(spark, folder))
    again = bs.merge_bucketed(spark, folder, source(spark, [(3, "w0", "b", 77, "x")]), ["available"], on_change(), batch="b1")
    assert first["new_rows"] == 1 and again["buckets_written"] == 0 and rows_of(bs.read_state(spark, folder)) == told
    bs.merge_bucketed(spark, folder, source(spark, []), ["available"], on_change(), batch="b2")
    assert bs.current(spark, folder).batches == {"b1", "b2"}


def test_two_runs_of_one_version(spark, folder):
    manifest = bs.current(spark, folder)
    after = bs.Manifest(manifest.version + 1, manifest.keys, manifest.buckets, manifest.schema, manifest.entries)
    bs._commit(spark, folder, after, "a" * 32, "mine")
    with pytest.raises(bs.StateConflict):
        bs._commit(spark, folder, after, "b" * 32, "other")
    assert bs.current(spark, folder).batches == {"mine"}


def test_digests_find_every_kind_of_change(spark, folder):
    state = spark.createDataFrame(state_rows(), SCHEMA)
    assert bs.unequal_buckets(spark, folder, state.repartition(7), state.columns) == []
    told = state.where("item <> 8").withColumn("available", F.when(F.col("item") == 9, -1).otherwise(F.col("available"))).withColumn(
        "note", F.when(F.col("item") == 11, F.lit(None)).otherwise(F.col("note"))
    ).unionByName(state.where("item = 1").withColumn("item", F.lit(5000).cast("long")))
    got = bs.changed_by_digest(spark, folder, told)
    assert sorted((r["item"], r["action"]) for r in got.collect()) == [(8, "delete"), (9, "update"), (11, "update"), (5000, "insert")]
    opened = {f.split(bs.BUCKET)[1].split("/")[0] for f in got.inputFiles()}
    assert 1 <= len(opened) <= 4


def test_pairs_of_equal_rows_do_not_cancel(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "k long, v string")
    b = spark.createDataFrame([(1, "y"), (1, "y")], "k long, v string")
    digest = lambda df: bs.bucket_digests(df, ["k", "v"], F.lit(0)).collect()
    assert digest(a) != digest(b)
    swapped = spark.createDataFrame([(None, 1), (1, None)], "k long, v long")
    one, two = (bs.bucket_digests(swapped.where(c), ["k", "v"], F.lit(0)).collect() for c in ("k is null", "v is null"))
    assert one != two


def test_a_state_is_created_once_and_must_exist(spark, folder, tmp_path):
    with pytest.raises(FileExistsError):
        bs.create_state(spark.createDataFrame(state_rows(1), SCHEMA), folder, KEYS)
    with pytest.raises(FileNotFoundError):
        bs.read_state(spark, str(tmp_path / "none"))
