"""Document fingerprints from content-defined chunks.

A gear hash runs over the bytes of a text; a chunk ends where the hash meets a mask, a strict one before the normal chunk
length and a loose one after it, so lengths stay near the normal one while boundaries still depend on the last few bytes
only. An insertion or a cut changes the chunks around it and no others. A fingerprint is the set of chunk digests, each
weighted by the bytes it stands for; the likeness of two fingerprints is the weight they share over the larger total, that
is, the lesser of the two containments.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.llm import common as C

LEAST, NORMAL, MOST = 24, 48, 192
STRICT, LOOSE = np.uint32(0b1111110 << 24), np.uint32(0b1111 << 27)
GEAR = (C.seeded(256, 303) >> C.U64(32)).astype(np.uint32)
BATCH_BYTES = 1 << 20


def _gear(data: np.ndarray) -> np.ndarray:
    """Gear hash of the last 16 bytes at each position, by doubling the reach."""
    h = GEAR[data]
    for reach in (1, 2, 4, 8):
        nxt = h.copy()
        nxt[reach:] += h[:-reach] << np.uint32(reach)
        h = nxt
    return h


def boundaries(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, start and end of every chunk; all texts advance side by side."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    h = _gear(data) if len(data) > 8 else GEAR[data]
    strict, loose = np.flatnonzero((h & STRICT) == 0), np.flatnonzero((h & LOOSE) == 0)
    strict, loose = np.append(strict, len(data) * 2), np.append(loose, len(data) * 2)
    text = np.flatnonzero(np.diff(offsets) > 0)
    pos, stop = offsets[text], offsets[text + 1]
    out = []
    while len(pos):
        first = strict[np.searchsorted(strict, pos + LEAST - 1)] + 1
        late = loose[np.searchsorted(loose, pos + NORMAL)] + 1
        end = np.where(first <= pos + NORMAL, first, np.minimum(late, pos + MOST))
        end = np.minimum(end, stop)
        out.append((text, pos, end))
        going = end < stop
        text, pos, stop = text[going], end[going], stop[going]
    text, start, end = (np.concatenate(x) for x in zip(*out))
    order = np.argsort(start, kind="stable")
    return text[order], start[order], end[order]


@dataclass
class Fingerprint:
    """Sorted chunk digests (48 bits) and the bytes each stands for."""

    digests: np.ndarray
    weights: np.ndarray

    def text(self) -> str:
        row = np.empty((len(self.digests), 10), np.uint8)
        row[:, :6] = self.digests.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]
        row[:, 6:] = self.weights.astype(">u4").view(np.uint8).reshape(-1, 4)
        return row.tobytes().hex()

    def likeness(self, other: Fingerprint) -> float:
        """0 to 1; two empty texts are alike."""
        total = max(int(self.weights.sum()), int(other.weights.sum()))
        if not total:
            return 1.0
        _, a, b = np.intersect1d(self.digests, other.digests, assume_unique=True, return_indices=True)
        return float(np.minimum(self.weights[a], other.weights[b]).sum()) / total


def fingerprints(texts: list[bytes]) -> list[Fingerprint]:
    out = []
    row = 0
    while row < len(texts):
        end, size = row, 0
        while end < len(texts) and (end == row or size + len(texts[end]) <= BATCH_BYTES):
            size += len(texts[end])
            end += 1
        part = texts[row:end]
        data = np.frombuffer(b"".join(part), np.uint8)
        offsets = np.r_[0, np.cumsum([len(t) for t in part])].astype(np.int64)
        text, start, stop = boundaries(data, offsets)
        digest = C.Rolling(data, C.BYTE_CODE).slices(start, stop) >> C.U64(16) if len(data) else np.zeros(0, np.uint64)
        order = np.lexsort((digest, text))
        text, digest, size_ = text[order], digest[order], (stop - start)[order]
        new = np.r_[True, (text[1:] != text[:-1]) | (digest[1:] != digest[:-1])] if len(text) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        weight = np.add.reduceat(size_, first) if len(first) else size_
        text, digest = text[first], digest[first]
        cut = np.searchsorted(text, np.arange(len(part) + 1))
        out += [Fingerprint(digest[a:b], weight[a:b]) for a, b in zip(cut[:-1], cut[1:])]
        row = end
    return out


def edited(text: str, following: str) -> str:
    """The last third of a text replaced by as much of the beginning of the next."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def with_next(documents: DataFrame, text: str, ident: str) -> DataFrame:
    """(bucket, tail, id, text): documents dealt out by ranges of falling id, each range closed by the document after it.

    Ranges come from quantiles of the ids alone. The document that follows a range is the first of the next one (of the
    last range: of the first), added as a row with ``tail`` set; so no neighbour is ever looked up across tasks, and only
    one text per range travels twice. Equal ids are ordered by text, null ids and texts last and first.
    """
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = documents.select(F.col(ident).cast("long").alias("id"), F.col(text).alias("text"))
    shares = [i / parts for i in range(1, parts)]
    # Borders in falling order; an id belongs to the range after every border above it.
    borders = sorted(set(docs.approxQuantile("id", shares, 0.1 / parts)), reverse=True) if shares else []
    rising = np.array(borders[::-1], dtype=np.int64)

    @F.pandas_udf(T.IntegerType())
    def bucket(ids: pd.Series) -> pd.Series:
        above = len(rising) - np.searchsorted(rising, ids.fillna(0).to_numpy(np.int64), side="right")
        return pd.Series(np.where(ids.isna(), len(rising), above).astype(np.int32))

    placed = docs.withColumn("bucket", bucket("id"))
    tops = {r["bucket"]: r["top"] for r in docs.select("id").withColumn("bucket", bucket("id")).groupBy("bucket").agg(F.max("id").alias("top")).collect()}
    order = sorted(tops)
    before = {b: order[i - 1] for i, b in enumerate(order)}  # the first range follows the last
    pairs = spark.createDataFrame([(tops[b], b, before[b]) for b in order], "top long, own int, closes int")
    firsts = (
        docs.join(F.broadcast(pairs), docs["id"].eqNullSafe(pairs["top"]))
        .groupBy("top", "own", "closes").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
        .select(F.col("closes").alias("bucket"), F.lit(True).alias("tail"), F.col("top").alias("id"), "text")
    )
    return placed.select("bucket", F.lit(False).alias("tail"), "id", F.coalesce("text", F.lit("")).alias("text")).union(firsts)


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def fingerprint_documents(documents: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Fingerprint of every document and of its edited text, and its likeness to that and to the next document.

    A null text is empty; an empty text has an empty fingerprint, alike to another empty one only. Repeated ids and rows each
    count as documents; a document alone is its own next.
    """
    ranged = with_next(documents, text, ident)
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = ranged.repartition(parts, "bucket").sortWithinPartitions("bucket", "tail", F.col("id").desc_nulls_last(), "text")

    def run(batches):
        held = None  # the last row so far, whose next document is still to come
        for batch in batches:
            # Small slices keep memory bounded whatever the batch holds.
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                rows = list(zip(*(piece.column(i).to_pylist() for i in range(4))))
                rows = ([held] if held else []) + rows
                held = rows[-1]
                pairs = [(a, b) for a, b in zip(rows, rows[1:]) if a[0] == b[0]]
                if pairs:
                    yield _compare(pairs)

    return dealt.mapInArrow(run, RESULT)


def _compare(pairs: list) -> pa.RecordBatch:
    changed = [edited(a[3], b[3]).encode() for a, b in pairs]
    n = len(pairs)
    prints = fingerprints([a[3].encode() for a, _ in pairs] + changed + [b[3].encode() for _, b in pairs])
    own, other, following = prints[:n], prints[n : 2 * n], prints[2 * n :]
    return pa.RecordBatch.from_arrays([
        pa.array([a[2] for a, _ in pairs], pa.int64()), pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
        pa.array([hashlib.sha256(c).hexdigest() for c in changed]), pa.array([p.text() for p in own], pa.string()),
        pa.array([p.text() for p in other], pa.string()), pa.array([p.likeness(q) for p, q in zip(own, other)], pa.float64()),
        pa.array([p.likeness(q) for p, q in zip(own, following)], pa.float64()),
    ], names=[f.split()[0] for f in RESULT.split(", ")])


def op9_fingerprint(spark, sf_dir: str) -> DataFrame:
    return fingerprint_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
