"""Memory of Python workers: what a unit of texts takes, and how much text Spark hands over at a time."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cartloom.llm import common as C
from cartloom.llm import repeats, suffixes
from tests.llm.fixtures import prose


def _peak(work) -> float:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_rolling_hashes_agree_across_blocks():
    codes = C.seeded(3 * C.ROLL + 17, 5)
    rolling = C.Rolling(codes)
    rng = random.Random(1)
    start = np.array([rng.randrange(len(codes)) for _ in range(200)] + [0, C.ROLL - 1, C.ROLL, len(codes)])
    end = np.minimum(start + np.array([rng.randrange(2 * C.ROLL) for _ in start]), len(codes))
    alone = [int(C.Rolling(codes[a:b]).slices(np.array([0]), np.array([b - a]))[0]) for a, b in zip(start, end)]
    assert rolling.slices(start, end).tolist() == alone
    symbols = np.frombuffer(b"some bytes " * 9000, np.uint8)
    assert (C.Rolling(symbols, C.BYTE_CODE).prefix == C.Rolling(C.BYTE_CODE[symbols]).prefix).all()


def test_a_unit_takes_little_more_than_its_prefixes():
    """Eight bytes a symbol for the prefixes; powers, codes and covered windows as long as the text came on top of them."""
    line = prose(60_000, 8)
    rows = [line, line, line]
    method = suffixes.byte_method()
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2, 3], pa.int64()), "text": rows})
    data, offsets = C.buffers(batch.column(1))
    start, count, left, right = method.anchors(data, None, offsets)
    anchors = repeats.pack([
        np.diff(start, prepend=0).astype(np.uint32), count.astype(np.uint8), (left - start).astype(np.int16), (right - left).astype(np.uint16),
    ])
    blob = repeats._store(batch)
    unit = lambda: repeats.Unit(blob, anchors, method, "text", "doc_id")
    assert _peak(unit) < 20 * len(data)
    u = unit()
    answer = lambda n, v: [{"bucket": 0, "blob": repeats.pack([np.full(n, v, np.uint8)])}]
    keys, _, _ = repeats._anchor_records(u.anchor_keys(), u.order(u.parsed.start), False)
    replies = [answer(len(keys), 1), answer(len(keys), 0), answer(0, 0)]
    done = []
    assert _peak(lambda: done.append(repeats.Rounds(u, replies).removed())) < 16 * len(data)
    assert done[0].tolist() == [False] * len(line) + [True] * (2 * len(line))


def test_texts_come_in_small_batches_and_leave_full_units(spark):
    key = C.BATCH_BYTES[0]
    chosen = spark.conf.getAll.get(key)
    spark.conf.unset(key)
    try:
        rows = spark.range(3000, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ten bytes "), 1000).alias("text"))
        suffixes.remove_repeated_bytes(rows.limit(3))

        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"size": pa.array([batch.nbytes], pa.int64())})

        got = [r["size"] for r in rows.mapInArrow(sizes, "size long").collect()]
        assert sum(got) > 30e6 and max(got) < 10e6
        spark.conf.set(key, "1000000")
        C.small_batches(spark)
        assert spark.conf.get(key) == "1000000"
    finally:
        spark.conf.set(key, chosen) if chosen else spark.conf.unset(key)
    pieces = [pa.RecordBatch.from_pydict({"text": pa.array(["x" * 30] * n, pa.string())}) for n in (5, 0, 1, 7, 12)]
    filled = list(repeats._filled(iter(pieces), "text", 120))
    assert [b.num_rows for b in filled] == [4, 4, 4, 4, 4, 4, 1]
    assert list(repeats._filled(iter([]), "text", 120)) == []
