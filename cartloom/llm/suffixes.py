"""Suffix-array dedup: remove bytes covered by a 50-byte string that also starts in a document with a smaller id.

Only suffixes that can matter are sorted. Content-defined anchors (the least hash among the 32-byte strings of a window)
tell which windows may repeat at all and settle those that repeat together with their surroundings; the suffixes left, at
the borders of repeats, are range-partitioned by splitters sampled from all texts, sorted in their bucket by multikey
quicksort - by their leading four bytes, then, where these tie, by the digest of the other 46 - and compared with their
neighbours. Splitters are whole keys, so a run of equal suffixes is never cut by a bucket border and leading bytes that are
very common spread over several buckets.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cartloom.llm import common as C
from cartloom.llm import repeats as R

WINDOW = 50
GRAM = 32
LEAD = 4
SAMPLES_PER_BUCKET = 20


def _byte_symbols(data, offsets):
    return data, offsets, None


def _priority(data: np.ndarray, size: int) -> np.ndarray:
    """32-bit hash of every string of ``size`` bytes, by doubling."""
    code = (C.BYTE_CODE >> C.U64(32)).astype(np.uint32)
    part, length, out, have = code[data], 1, None, 0
    rest = size
    while rest:
        if rest & 1:
            if out is None:
                out, have = part, length
            else:
                n = len(data) - have - length + 1
                out = out[:n] * np.uint32(pow(0x2C1B3C6D, length, 1 << 32)) + part[have : have + n]
                have += length
        rest >>= 1
        if rest:
            n = len(part) - length
            part = part[:n] * np.uint32(pow(0x2C1B3C6D, length, 1 << 32)) + part[length : length + n]
            length *= 2
    out = (out ^ (out >> np.uint32(15))) * np.uint32(0x297A2D39)
    return out ^ (out >> np.uint32(15))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    length = 1
    while 2 * length <= width:
        values = np.minimum(values[:-length], values[length:])
        length *= 2
    return values if length == width else np.minimum(values[: len(values) - (width - length)], values[width - length :])


def byte_anchors(window: int, gram: int, data: np.ndarray, offsets: np.ndarray):
    """Ranges of windows and their anchor strings, document chunk by document chunk."""
    parts = []
    base = 0
    for _, _, part, offs in C.chunks(data, offsets, 1 << 18):
        if len(part) >= window:
            key = (_priority(part, gram).astype(np.uint64) << C.U64(32)) | np.arange(len(part) - gram + 1, dtype=np.uint64)
            anchor = (_sliding_min(key, window - gram + 1) & C.U64(0xFFFFFFFF)).astype(np.int64)
            valid = R.windows_inside(offs, len(part), window)[: len(anchor)]
            start, count = R._ranges(valid, anchor)
            parts.append((start + base, count, anchor[start] + base))
        base += len(part)
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    start, count, left = (np.concatenate(p) for p in zip(*parts))
    return start, count, left, left + gram


def leading(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The four bytes from each position as a number that sorts like them."""
    out = np.zeros(len(at), np.uint64)
    for j in range(LEAD):
        out = (out << C.U64(8)) | data[at + j]
    return out


def byte_method(window: int = WINDOW, gram: int = GRAM) -> R.Method:
    return R.Method(
        window=window, symbols=_byte_symbols, codes=C.BYTE_CODE, anchors=lambda data, codes, at: byte_anchors(window, gram, data, at), by_place=False,
        window_keys=lambda p, at, data: (leading(data, at), p.rolling.slices(at + LEAD, at + window)),
    )


def sample_splitters(window: int, text: str):
    """Splitters of the suffix order from evenly spread windows of all stored texts."""

    def splitters(stored: DataFrame, buckets: int):
        units = stored.select("unit", "blob")
        count = max(units.count(), 1)
        each = -(-SAMPLES_PER_BUCKET * buckets // count)

        def run(batches):
            for batch in batches:
                for blob in batch.column(1):
                    piece = R._load(blob.as_py())
                    data, offs = C.buffers(piece.column(piece.schema.names.index(text)))
                    inside = np.maximum(np.diff(offs) - (window - 1), 0)
                    before = np.r_[0, np.cumsum(inside)]
                    at = np.linspace(0, before[-1] - 1, min(each, before[-1])).astype(np.int64) if before[-1] else np.zeros(0, np.int64)
                    of = np.searchsorted(before, at, side="right") - 1
                    at = offs[of] + at - before[of]
                    minor = [int(C.Rolling(data[p + LEAD : p + window], C.BYTE_CODE).slices(np.array([0]), np.array([window - LEAD]))[0]) for p in at]
                    major = leading(data, at)
                    yield pa.RecordBatch.from_pydict({
                        "major": pa.array(major.view(np.int64)), "minor": pa.array(np.array(minor, np.uint64).view(np.int64)),
                    })

        rows = units.mapInArrow(run, "major long, minor long").toPandas()
        major, minor = rows["major"].to_numpy(np.int64).view(np.uint64), rows["minor"].to_numpy(np.int64).view(np.uint64)
        order = np.lexsort((minor, major))
        pick = order[np.linspace(0, len(order), buckets + 1).astype(np.int64)[1:-1]] if len(order) else order
        return major[pick], minor[pick]

    return splitters


NEW = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeated_bytes(
    documents: DataFrame, text: str = "text", ident: str = "doc_id", window: int = WINDOW, gram: int = GRAM, rewrite: bool = False,
    unit_bytes: int = R.UNIT_BYTES, bucket_bytes: int = R.BUCKET_BYTES,
) -> DataFrame:
    """All rows of documents plus n_bytes, n_removed, n_spans and kept_sha256; with ``rewrite`` the text is what is left.

    A null text is empty and stays null when rewritten; a null id counts as the smallest. Rows with the same id are one
    document as to "smaller": they do not remove each other's bytes. Where a cut leaves part of a character, that part is
    dropped from a rewritten text (the digest is of the exact bytes). Result columns replace columns of their name.
    """
    names = [f.split()[0] for f in NEW.split(", ")]
    docs = documents.drop(*names)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [NEW])

    def finish(u: R.Unit, removed: np.ndarray) -> pa.RecordBatch:
        total, gone, spans, digest, left = [], [], [], [], []
        for i in range(len(u.offsets) - 1):
            part, cut = u.data[u.offsets[i] : u.offsets[i + 1]], removed[u.offsets[i] : u.offsets[i + 1]]
            kept = part[~cut].tobytes()
            total.append(len(part))
            gone.append(int(cut.sum()))
            spans.append(int((np.diff(np.r_[0, cut.view(np.int8)]) == 1).sum()))
            digest.append(hashlib.sha256(kept).hexdigest())
            if rewrite:
                left.append(kept.decode("utf-8", "ignore"))
        columns = list(u.batch.columns)
        if rewrite:
            at = u.batch.schema.names.index(text)
            nulls = columns[at].is_null().to_numpy(False)
            columns[at] = pa.array([None if n else t for n, t in zip(nulls, left)], columns[at].type)
        return pa.RecordBatch.from_arrays(
            columns + [pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest)],
            names=u.batch.schema.names + names,
        )

    return R.find_repeats(
        docs, byte_method(window, gram), finish, schema, text, ident, unit_bytes, bucket_bytes, sample_splitters(window, text)
    )


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeated_bytes(docs).drop("text")
