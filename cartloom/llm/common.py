"""Shared helpers of the training-data operators: Arrow text buffers, word splitting and rolling hashes in numpy."""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

from cartloom.session import checkpoint_folder, settle  # noqa: F401

U64 = np.uint64
CHUNK_BYTES = 1 << 21
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 23))
LONG_WORD = 256


def bits(*ranges: tuple[int, int]) -> np.ndarray:
    """Byte table that is False inside the given closed ranges."""
    table = np.ones(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = False
    return table


# Words as runs of anything but space and the control characters 9 to 13.
SPACED = bits((0x20, 0x20), (0x09, 0x0D))
# Words as runs of digits, letters and everything beyond ASCII.
ALNUM = bits((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
SAME = np.arange(256, dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on 64-bit values."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values, the same in every process."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * U64(0x9E3779B97F4A7C15) + U64(seed))


BYTE_CODE = seeded(256, 11)
BASE = 0xD6E8FEB86659FD93


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers of a number modulo 2^64."""
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out)


ROLL = 1 << 16
UP, DOWN = powers(BASE, ROLL), powers(pow(BASE, -1, 1 << 64), ROLL)


class Rolling:
    """Polynomial prefix hashes: the hash of any slice depends on its content only.

    Made block by block, so that besides the prefixes nothing is as long as the text. Symbols may be numbers that ``table``
    has the codes of.
    """

    def __init__(self, codes: np.ndarray, table: np.ndarray | None = None):
        n = len(codes)
        self.prefix = np.zeros(n + 1, dtype=np.uint64)
        for a in range(0, n, ROLL):
            part = codes[a : a + ROLL] if table is None else table[codes[a : a + ROLL]]
            part = part * UP[: len(part)] * U64(pow(BASE, a, 1 << 64))
            out = self.prefix[a + 1 : a + 1 + len(part)]
            np.cumsum(part, out=out)
            out += self.prefix[a]
        self.blocks = powers(pow(BASE, -ROLL, 1 << 64), n // ROLL + 1)

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        down = DOWN[start & (ROLL - 1)] * self.blocks[start // ROLL]
        return mix((self.prefix[end] - self.prefix[start]) * down + (end - start).astype(np.uint64))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and its n+1 offsets; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], dtype=np.int64, count=n + 1, offset=column.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(raw[2], dtype=np.uint8) if raw[2] is not None and raw[2].size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(data: np.ndarray, offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows of about ``limit`` bytes; a longer text stands alone."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words and, per text, the offset of its first word (n+1 values)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    flag = inside[data]
    before = np.empty(len(data), dtype=bool)
    before[0] = False
    before[1:] = flag[:-1]
    edges = offsets[offsets < len(data)]
    before[edges] = False
    starts = np.flatnonzero(flag & ~before)
    after = np.empty(len(data), dtype=bool)
    after[-1] = False
    after[:-1] = flag[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(flag & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_codes(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, fold: np.ndarray):
    """64-bit code of every word, its byte span, and the word offsets of the texts.

    Polynomials modulo 2^64 collide on certain strings of 1024 and more symbols whatever the base, so long words take a
    keyed digest of their bytes instead.
    """
    starts, ends, at = words(data, offsets, inside)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends, at
    folded = fold[data]
    codes = Rolling(folded, BYTE_CODE).slices(starts, ends)
    for k in np.flatnonzero(ends - starts >= LONG_WORD).tolist():
        codes[k] = int.from_bytes(blake2b(folded[starts[k] : ends[k]].tobytes(), digest_size=8, key=b"words").digest(), "little")
    return codes, starts, ends, at


def ngram_codes(codes: np.ndarray, n: int) -> np.ndarray:
    """Code of every n consecutive words; len(codes) - n + 1 values."""
    m = max(len(codes) - n + 1, 0)
    out = np.zeros(m, dtype=np.uint64)
    factor = 1
    for j in range(n):
        out += codes[j : j + m] * U64(factor)
        factor = factor * BASE % (1 << 64)
    return mix(out)


def small_batches(spark: SparkSession) -> None:
    """Rows with whole texts go to Python some megabytes at a time; a session that chose a size keeps it.

    At Spark's 10,000 rows or 64 MB, each task holds several copies of such a batch, most of them outside the heap.
    """
    if BATCH_BYTES[0] not in spark.conf.getAll:
        spark.conf.set(*BATCH_BYTES)


def release(spark: SparkSession, rounds: int = 2, wait: float = 0.7) -> None:
    """Let Spark's cleaner drop shuffle files of finished rounds; they would stay until the driver happens to collect.

    Event queues keep the last query until another one comes, so a tiny job goes first. What the first collection frees on
    the Python side is seen by the JVM in the second; the cleaner works on its own thread, hence the short wait.
    """
    spark.range(1).count()
    for _ in range(rounds):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(wait)
