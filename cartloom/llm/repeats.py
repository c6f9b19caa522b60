"""Shared machinery of the two exact repeat removers: packed units, bucketed rounds and replies.

Texts travel in *units* of a few megabytes, stored once as compressed Arrow batches. In every round a unit sends its
distinct keys, sorted and packed, to key ranges (buckets); a bucket sees one record per key and unit, however often the
unit holds the key, and answers with one bit per record. So a passage that a third of all documents share costs one record
per unit. The rounds:

1. *anchors*: every window belongs to one anchor that depends on the window's content only. Anchors seen once are dropped.
2. *ranges*: the windows of an anchor form one range. Where all places of an anchor agree on the whole range, its first
   place decides all windows at once.
3. *windows*: where they differ, at the borders of repeats, single windows are compared.

Then each unit marks the covered symbols. Nothing is sampled away: the rounds only avoid sending windows whose answer is
already known. Keys are 64-bit digests (anchors 48: a chance hit there only costs a comparison later).
"""

from __future__ import annotations

import io
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm import common as C

UNIT_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
NULL_ID = np.iinfo(np.int64).min


@dataclass
class Parsed:
    """Symbols of a unit's texts with their anchors. Ranges are consecutive windows that share an anchor."""

    at: np.ndarray  # first symbol of each text, and the end
    rolling: C.Rolling
    start: np.ndarray  # first window of each range
    count: np.ndarray  # its number of windows
    left: np.ndarray  # anchor content: symbols left to right
    right: np.ndarray
    spans: tuple | None = None  # byte starts and ends of symbols, if they are not bytes


@dataclass
class Method:
    """What the two removers differ in."""

    window: int
    symbols: Callable  # text column -> (codes, at, spans); with a table of codes, the numbers to look up there
    anchors: Callable  # (data, codes, at) -> (start, count, left, right)
    by_place: bool  # an earlier place in the same document counts, not only a smaller document
    window_keys: Callable  # (Parsed, window starts, data) -> (major, minor) keys
    codes: np.ndarray | None = None


def pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays as bytes, same-order bytes of all values together, compressed."""
    head = struct.pack("<B", len(arrays)) + b"".join(struct.pack("<2sq", a.dtype.str[1:].encode(), len(a)) for a in arrays)
    body = b"".join(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in map(np.ascontiguousarray, arrays))
    return head + zstandard.ZstdCompressor(level=1).compress(body)


def unpack(blob: bytes) -> list[np.ndarray]:
    n = blob[0]
    kinds = [struct.unpack_from("<2sq", blob, 1 + 10 * i) for i in range(n)]
    body = zstandard.ZstdDecompressor().decompress(blob[1 + 10 * n :])
    out, at = [], 0
    for kind, size in kinds:
        width = int(kind[1:])
        raw = np.frombuffer(body, np.uint8, count=size * width, offset=at).reshape(width, size)
        out.append(np.ascontiguousarray(raw.T).reshape(-1).view(np.dtype("<" + kind.decode())))
        at += size * width
    return out


def _store(batch: pa.RecordBatch) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 9))) as out:
        out.write_batch(batch)
    return sink.getvalue()


def _load(blob: bytes) -> pa.RecordBatch:
    return next(iter(pa.ipc.open_stream(blob)))


def _slices(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches cut to at most ``limit`` bytes of text, a longer text alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = C.buffers(batch.column(batch.schema.names.index(text)))
        row = 0
        while row < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
            end = min(max(end, row + 1), batch.num_rows)
            yield batch.slice(row, end - row)
            row = end


def _filled(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """As _slices, but what a batch leaves over is filled up from the next."""
    rest = []
    for batch in batches:
        pieces = list(_slices(pa.Table.from_batches([*rest, batch]).combine_chunks().to_batches(), text, limit))
        yield from pieces[:-1]
        rest = pieces[-1:]
    yield from rest


def _ranges(valid: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and length of runs of valid windows with one anchor."""
    at = np.flatnonzero(valid)
    if not len(at):
        return at, at
    new = np.r_[True, (np.diff(at) != 1) | (np.diff(anchor[at]) != 0)]
    first = np.flatnonzero(new)
    return at[first], np.diff(np.r_[first, len(at)])


def windows_inside(at: np.ndarray, n: int, window: int) -> np.ndarray:
    """Which symbol positions start a window that stays in its text."""
    edge = np.zeros(n + 1, dtype=np.int32)
    np.add.at(edge, np.maximum(at[:-1], at[1:] - (window - 1)), 1)
    np.add.at(edge, at[1:], -1)
    return np.cumsum(edge[:-1], out=edge[:-1]) == 0


def _bucket_rows(unit: int, bucket: np.ndarray, arrays: list[np.ndarray]) -> dict[str, list]:
    """One packed row per bucket of records that are sorted by bucket."""
    cuts = np.flatnonzero(np.r_[True, np.diff(bucket) != 0]) if len(bucket) else np.zeros(0, np.int64)
    ends = np.r_[cuts[1:], len(bucket)].astype(np.int64)
    return {
        "unit": [unit] * len(cuts), "bucket": [int(bucket[c]) for c in cuts],
        "blob": [pack([a[c:e] for a in arrays]) for c, e in zip(cuts, ends)],
    }


STORED = pa.schema([("unit", pa.int64()), ("blob", pa.binary()), ("anchors", pa.binary())])
STORED_SQL = "unit long, blob binary, anchors binary"
ROWS = pa.schema([("unit", pa.int64()), ("bucket", pa.int32()), ("blob", pa.binary())])
ROWS_SQL = "unit long, bucket int, blob binary"


def hash_bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    """Equal key ranges; in key order."""
    return ((key >> C.U64(32)) * C.U64(buckets) >> C.U64(32)).astype(np.int32)


def _firsts(key: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, each occurrence's place among them, and the least order of each."""
    by = np.argsort(key, kind="stable")
    sorted_key = key[by]
    new = np.r_[True, sorted_key[1:] != sorted_key[:-1]] if len(by) else np.zeros(0, bool)
    group = np.empty(len(by), np.int64)
    group[by] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    least = np.minimum.reduceat(order[by], first) if len(first) else np.zeros(0, np.int64)
    return sorted_key[first], group, least


class Unit:
    """A stored unit with its texts parsed again and the order of its places."""

    def __init__(self, blob: bytes, anchors: bytes, method: Method, text: str, ident: str):
        self.method = method
        self.batch = _load(blob)
        names = self.batch.schema.names
        self.data, self.offsets = C.buffers(self.batch.column(names.index(text)))
        codes, at, spans = method.symbols(self.data, self.offsets)
        gap, count, left, width = unpack(anchors)
        start = np.cumsum(gap.astype(np.int64))
        first = start + left.astype(np.int64)
        self.parsed = Parsed(at, C.Rolling(codes, method.codes), start, count.astype(np.int64), first, first + width.astype(np.int64), spans)
        ids = self.batch.column(names.index(ident)).cast(pa.int64())
        self.ids = np.where(ids.is_null().to_numpy(False), NULL_ID, ids.fill_null(0).to_numpy(False))
        self.distinct, self.rank = np.unique(self.ids, return_inverse=True)

    def order(self, at: np.ndarray) -> np.ndarray:
        """Place of symbols in the order of the whole corpus, as far as it matters inside the unit."""
        text = np.searchsorted(self.parsed.at, at, side="right") - 1
        inside = at - self.parsed.at[text] if self.method.by_place else 0
        return (self.rank[text].astype(np.int64) << 36) + inside

    def place(self, order: np.ndarray) -> list[np.ndarray]:
        """The same order as document id and offset, to compare between units."""
        return [self.distinct[order >> 36], (order & ((1 << 36) - 1))]

    def anchor_keys(self) -> np.ndarray:
        return self.parsed.rolling.slices(self.parsed.left, self.parsed.right) >> C.U64(16) << C.U64(16)


def _anchor_records(keys: np.ndarray, order: np.ndarray, by_place: bool):
    """Distinct anchors, each occurrence's place among them, and whether the unit alone repeats it."""
    distinct, group, least = _firsts(keys, order)
    if by_place:
        again = np.bincount(group, minlength=len(distinct)) > 1
    else:
        most = np.full(len(distinct), -1, np.int64)
        np.maximum.at(most, group, order)
        again = most != least
    return distinct, group, again


def build_units(docs: DataFrame, method: Method, text: str, unit_bytes: int) -> DataFrame:
    """Units: packed rows and the anchors of their texts."""

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        for piece in _filled(batches, text, unit_bytes):
            data, offsets = C.buffers(piece.column(piece.schema.names.index(text)))
            codes, at, _ = method.symbols(data, offsets)
            start, count, left, right = method.anchors(data, codes, at)
            anchors = pack([
                np.diff(start, prepend=0).astype(np.uint32), count.astype(np.uint8 if method.window < 256 else np.uint32),
                (left - start).astype(np.int16), (right - left).astype(np.uint16),
            ])
            yield pa.RecordBatch.from_pydict({"unit": [(part << 28) + seq], "blob": [_store(piece)], "anchors": [anchors]}, STORED)
            seq += 1

    return docs.mapInArrow(run, STORED_SQL)


def anchor_records(units: DataFrame, method: Method, text: str, ident: str, buckets: int) -> DataFrame:
    """Round 1: the distinct anchors of every unit."""

    def run(batches):
        for batch in batches:
            for unit, blob, anchors in zip(*(batch.column(i).to_pylist() for i in range(3))):
                u = Unit(blob, anchors, method, text, ident)
                keys, _, again = _anchor_records(u.anchor_keys(), u.order(u.parsed.start), method.by_place)
                rows = _bucket_rows(unit, hash_bucket(keys, buckets), [(keys >> C.U64(16)), again.astype(np.uint8)])
                yield pa.RecordBatch.from_pydict(rows, ROWS)

    return units.mapInArrow(run, ROWS_SQL)


def reply(records: DataFrame, judge: Callable) -> DataFrame:
    """Every bucket's records judged together; one byte per record goes back to its unit."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack(b) for b in pdf["blob"]]
        sizes = [len(p[0]) for p in parts]
        verdict = judge(*[np.concatenate(a) for a in zip(*parts)]).astype(np.uint8)
        cut = np.split(verdict, np.cumsum(sizes)[:-1])
        return pd.DataFrame({"unit": pdf["unit"], "bucket": pdf["bucket"], "blob": [pack([c]) for c in cut]})

    return records.groupBy("bucket").applyInPandas(run, ROWS_SQL)


def judge_anchors(key: np.ndarray, again: np.ndarray) -> np.ndarray:
    """Shared: repeated inside a unit, or sent by more than one."""
    _, group, _ = _firsts(key, np.zeros(len(key), np.int64))
    count = np.bincount(group)
    inside = np.zeros(len(count), np.int64)
    np.maximum.at(inside, group, again)
    return (count[group] > 1) | (inside[group] > 0)


def _earlier(group: np.ndarray, doc: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Which records have a smaller (doc, offset) in their group."""
    by = np.lexsort((offset, doc, group))
    first = np.flatnonzero(np.r_[True, np.diff(group[by]) != 0])
    least = np.repeat(by[first], np.diff(np.r_[first, len(by)]))
    out = np.empty(len(by), bool)
    out[by] = (doc[least] != doc[by]) | (offset[least] != offset[by])
    return out


def judge_ranges(key: np.ndarray, kind: np.ndarray, doc: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Bit 2: places of the anchor differ in their range; bit 1: the first place is in another unit."""
    _, group, _ = _firsts(key, np.zeros(len(key), np.int64))
    n = int(group.max()) + 1 if len(group) else 0
    low, high = np.full(n, np.iinfo(np.uint64).max, np.uint64), np.zeros(n, np.uint64)
    np.minimum.at(low, group, kind)
    np.maximum.at(high, group, kind)
    mixed = (low != high) | (low == 0)
    return mixed[group] * 2 + _earlier(group, doc, offset)


def judge_windows(major: np.ndarray, minor: np.ndarray, doc: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Bit 1: the window's first place is in another unit."""
    group = sorted_runs(major, minor)
    return _earlier(group, doc, offset)


def sorted_runs(major: np.ndarray, minor: np.ndarray) -> np.ndarray:
    """Group numbers by multikey sort: first by the leading key, then ties of it by the next.

    As in multikey quicksort only rows that tie on the leading key are compared by the following one; each run of ties is
    then cut where a neighbour differs.
    """
    n = len(major)
    by = np.argsort(major, kind="stable")
    lead = major[by]
    new = np.r_[True, lead[1:] != lead[:-1]] if n else np.zeros(0, bool)
    run = np.cumsum(new) - 1
    tied = np.bincount(run, minlength=1)[run] > 1 if n else np.zeros(0, bool)
    at = np.flatnonzero(tied)
    if len(at):
        inner = at[np.lexsort((minor[by[at]], run[at]))]
        by[at] = by[inner]
        second = minor[by]
        new[1:] |= (run[1:] == run[:-1]) & (second[1:] != second[:-1])
    group = np.empty(n, np.int64)
    group[by] = np.cumsum(new) - 1
    return group


def _verdicts(raw: list | None) -> np.ndarray:
    """Replies of all buckets in key order."""
    parts = [unpack(b)[0] for _, b in sorted((r["bucket"], r["blob"]) for r in raw or [])]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint8)


def _range_keys(u: Unit, at: np.ndarray) -> np.ndarray:
    """Digest of a range's whole content and of where its anchor lies; never 0."""
    p = u.parsed
    start, count = p.start[at], p.count[at]
    whole = p.rolling.slices(start, start + count - 1 + u.method.window)
    return C.mix(whole + (p.left[at] - start).astype(np.uint64)) | C.U64(1)


class Rounds:
    """A unit's own side of the rounds; each step repeats the deterministic steps before it."""

    def __init__(self, u: Unit, replies: list[list]):
        self.u = u
        p = u.parsed
        self.covered = []  # first and last window of ranges whose windows all start earlier
        self.step, self.records = 1, None
        order = u.order(p.start)
        keys = u.anchor_keys()
        _, group, _ = _anchor_records(keys, order, u.method.by_place)
        shared = np.flatnonzero(_verdicts(replies[0])[group] > 0) if len(group) else group
        # Round 2: one record per shared anchor.
        order, keys = order[shared], keys[shared]
        kinds = _range_keys(u, shared)
        distinct, group, least = _firsts(keys, order)
        low = np.full(len(distinct), np.iinfo(np.uint64).max, np.uint64)
        high = np.zeros(len(distinct), np.uint64)
        np.minimum.at(low, group, kinds)
        np.maximum.at(high, group, kinds)
        kind = np.where(low == high, low, C.U64(0))
        self.records = (distinct, [distinct >> C.U64(16), kind, *u.place(least)])
        if len(replies) < 2:
            return
        verdict = _verdicts(replies[1])
        mine = verdict[group] if len(group) else np.zeros(0, np.uint8)
        agreed = (mine & 2) == 0
        later = agreed & (((mine & 1) > 0) | (order > least[group]))
        self.covered.append((p.start[shared[later]], p.start[shared[later]] + p.count[shared[later]] - 1))
        # Round 3: single windows of the other anchors.
        open_ = shared[~agreed]
        at, _ = _expand(p.start[open_], p.count[open_])
        major, minor = u.method.window_keys(u.parsed, at, u.data)
        group = sorted_runs(major, minor)
        n = int(group.max()) + 1 if len(group) else 0
        order = u.order(at)
        least = np.full(n, np.iinfo(np.int64).max, np.int64)
        np.minimum.at(least, group, order)
        pick = np.empty(n, np.int64)
        pick[group] = np.arange(len(group))
        self.records = ((major[pick], minor[pick]), [major[pick], minor[pick], *u.place(least)])
        if len(replies) < 3:
            return
        verdict = _verdicts(replies[2])
        later = (verdict[group] > 0) | (order > least[group]) if len(group) else np.zeros(0, bool)
        self.covered.append((at[later], at[later]))

    def removed(self) -> np.ndarray:
        """Which symbols lie in a covered window."""
        edge = np.zeros(int(self.u.parsed.at[-1]) + 1, np.int32)
        for first, end in self.covered:
            np.add.at(edge, first, 1)
            np.add.at(edge, end + self.u.method.window, -1)
        return np.cumsum(edge[:-1], out=edge[:-1]) > 0


def _expand(start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows of ranges, and the range of each."""
    of = np.repeat(np.arange(len(start)), count)
    return start[of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count), of


def _each_unit(batches, method: Method, text: str, ident: str, rounds: int):
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(j)[i].as_py() for j, n in enumerate(batch.schema.names)}
            u = Unit(row["blob"], row["anchors"], method, text, ident)
            yield row["unit"], Rounds(u, [row[f"reply{k}"] for k in range(1, rounds + 1)])


def _round(units: DataFrame, replies: list[DataFrame]) -> DataFrame:
    """Units with what the buckets answered them so far."""
    out = units
    for k, r in enumerate(replies, 1):
        out = out.join(r.groupBy("unit").agg(F.collect_list(F.struct("bucket", "blob")).alias(f"reply{k}")), "unit", "left")
    return out


def find_repeats(
    docs: DataFrame, method: Method, finish: Callable, schema: str, text: str = "text", ident: str = "doc_id",
    unit_bytes: int = UNIT_BYTES, bucket_bytes: int = BUCKET_BYTES, splitters: Callable | None = None,
) -> DataFrame:
    """Rows of ``finish(unit, removed symbols)`` for all units; a null id counts as the smallest."""
    spark = docs.sparkSession
    C.small_batches(spark)
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    units = C.settle(build_units(docs, method, text, unit_bytes))
    cuts = splitters(units, buckets) if splitters else None

    replies = [C.settle(reply(anchor_records(units, method, text, ident, buckets), judge_anchors))]
    C.release(spark)

    def ranges(batches):
        for unit, r in _each_unit(batches, method, text, ident, 1):
            keys, arrays = r.records
            yield pa.RecordBatch.from_pydict(_bucket_rows(unit, hash_bucket(keys, buckets), arrays), ROWS)

    replies.append(C.settle(reply(_round(units, replies).mapInArrow(ranges, ROWS_SQL), judge_ranges)))
    C.release(spark)

    def windows(batches):
        for unit, r in _each_unit(batches, method, text, ident, 2):
            (major, minor), arrays = r.records
            bucket = hash_bucket(major, buckets) if cuts is None else key_bucket(major, minor, cuts)
            yield pa.RecordBatch.from_pydict(_bucket_rows(unit, bucket, arrays), ROWS)

    replies.append(C.settle(reply(_round(units, replies).mapInArrow(windows, ROWS_SQL), judge_windows)))
    C.release(spark)

    def last(batches):
        for _, r in _each_unit(batches, method, text, ident, 3):
            yield finish(r.u, r.removed())

    return _round(units, replies).mapInArrow(last, schema)


def key_bucket(major: np.ndarray, minor: np.ndarray, cuts: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Range of each of the sorted two-part keys among sorted splitters; equal keys are never parted."""
    low, high = np.searchsorted(major, cuts[0], side="left"), np.searchsorted(major, cuts[0], side="right")
    borders = [a + np.searchsorted(minor[a:b], m, side="left") for a, b, m in zip(low, high, cuts[1])]
    return np.searchsorted(np.array(borders, np.int64), np.arange(len(major)), side="right").astype(np.int32)
