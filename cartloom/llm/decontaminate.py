"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Every run of ten benchmark words is a pattern. For each pattern length a shift table says, for a block of two words, how
far the search may move because no pattern can end earlier; text positions whose block is unknown are skipped nine words
at a time. Where the shift is zero, the hash of the pattern's last block selects a bucket of patterns, and the words
themselves are compared. Every document is searched in its own task, so no key is shuffled and none can be hot.

Patterns are broadcast in blocks of at most ``block_bytes`` of benchmark text; a larger benchmark takes more passes, with
the hits so far written to the checkpoint folder between them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm import common as C

WINDOW = 10
BLOCK_BYTES = 16 << 20


class Patterns:
    """Search tables for the windows of one block of benchmark items that have the same number of words."""

    def __init__(self, length: int, windows: dict[tuple, set[str]]):
        self.length = length
        self.block = min(2, length)
        self.texts = list(windows)
        self.items = [sorted(windows[t]) for t in self.texts]
        known = sorted({w for t in self.texts for w in t})
        place = {w: k for k, w in enumerate(known)}
        codes = _codes(known)[[place[w] for t in self.texts for w in t]].reshape(-1, length)
        pairs = self._blocks(codes.reshape(-1), len(self.texts), length)
        # Shift of a block: words between its last occurrence in any pattern and the pattern's end.
        reach = np.broadcast_to(np.arange(length - self.block, -1, -1), pairs.shape)
        order = np.lexsort((reach.ravel(), pairs.ravel()))
        keys = pairs.ravel()[order]
        first = np.r_[True, keys[1:] != keys[:-1]] if len(keys) else np.zeros(0, bool)
        self.keys, self.shifts = keys[first], reach.ravel()[order][first].astype(np.int64)
        suffix = pairs[:, -1]
        self.by_suffix = np.argsort(suffix, kind="stable")
        self.suffix = suffix[self.by_suffix]
        self.codes = codes

    def _blocks(self, codes: np.ndarray, rows: int, length: int) -> np.ndarray:
        table = codes.reshape(rows, length)
        if self.block == 1:
            return table
        return C.mix(table[:, :-1] * C.U64(C.BASE) + table[:, 1:])

    @property
    def skip(self) -> int:
        return self.length - self.block + 1

    def shift_of(self, blocks: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(blocks), self.skip)
        at = np.minimum(np.searchsorted(self.keys, blocks), len(self.keys) - 1)
        return np.where(self.keys[at] == blocks, self.shifts[at], self.skip)

    def search(self, codes: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int]]:
        """(start word, pattern) of every place where all word codes agree."""
        m, b = self.length, self.block
        if len(codes) < m:
            return
        ends = codes if b == 1 else np.r_[np.zeros(1, np.uint64), C.mix(codes[:-1] * C.U64(C.BASE) + codes[1:])]
        # Every text is cut into strides of the largest shift; all strides are searched side by side.
        sizes = np.maximum(np.diff(at) - m + 1, 0)
        strides = -(-sizes // self.skip)
        text = np.repeat(np.arange(len(sizes)), strides)
        rank = np.arange(len(text)) - np.repeat(np.cumsum(strides) - strides, strides)
        pos = at[text] + m - 1 + rank * self.skip
        stop = np.minimum(pos + self.skip, at[text + 1])
        while len(pos):
            shift = self.shift_of(ends[pos])
            hit = pos[shift == 0]
            if len(hit):
                low = np.searchsorted(self.suffix, ends[hit], side="left")
                high = np.searchsorted(self.suffix, ends[hit], side="right")
                place = np.repeat(hit, high - low) - m + 1
                step = np.arange(len(place)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
                pattern = self.by_suffix[np.repeat(low, high - low) + step]
                same = np.ones(len(place), bool)
                for j in range(m):
                    same[same] = codes[place[same] + j] == self.codes[pattern[same], j]
                yield from zip(place[same].tolist(), pattern[same].tolist())
            pos = pos + np.maximum(shift, 1)
            going = pos < stop
            pos, stop = pos[going], stop[going]


def _codes(words: list[bytes]) -> np.ndarray:
    """Codes of words, the same as those of the words of a text."""
    joined = np.frombuffer(b" ".join(words), np.uint8)
    return C.word_codes(joined, np.array([0, len(joined)]), C.SPACED, C.SAME)[0]


def item_words(text: str | None) -> list[bytes]:
    data = C.LOWER[np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)]
    starts, ends, _ = C.words(data, np.array([0, len(data)]), C.ALNUM)
    raw = data.tobytes()
    return [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist())]


def compile_block(rows: list[tuple[str, str]], window: int) -> list[Patterns]:
    by_length: dict[int, dict[tuple, set[str]]] = {}
    for item, text in rows:
        found = item_words(text)
        size = min(window, len(found))
        for i in range(len(found) - size + 1 if size else 0):
            by_length.setdefault(size, {}).setdefault(tuple(found[i : i + size]), set()).add(item)
    return [Patterns(n, w) for n, w in sorted(by_length.items())]


def blocks_of(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """Benchmark rows in blocks of bounded text, streamed partition by partition."""
    block, size = [], 0
    for row in benchmark.where(F.col(text).isNotNull()).select(F.col(item_id).cast("string"), text).toLocalIterator():
        if block and size + len(row[1]) > block_bytes:
            yield block
            block, size = [], 0
        block.append(("" if row[0] is None else row[0], row[1]))
        size += len(row[1])
    if block:
        yield block


def _search_batch(tables: list[Patterns], column: pa.Array):
    """Per text: number of words, hit spans (start, end) and item ids."""
    data, offsets = C.buffers(column)
    counts, spans, items = [], [], []
    for _, _, part, offs in C.chunks(data, offsets):
        folded = C.LOWER[part]
        codes, starts, ends, at = C.word_codes(folded, offs, C.ALNUM, C.SAME)
        found_spans: dict[int, list[tuple[int, int]]] = {}
        found_items: dict[int, set[str]] = {}
        for table in tables:
            for place, pattern in table.search(codes, at):
                exact = all(
                    folded[starts[place + j] : ends[place + j]].tobytes() == w for j, w in enumerate(table.texts[pattern])
                )
                if exact:
                    doc = int(np.searchsorted(at, place, side="right")) - 1
                    found_spans.setdefault(doc, []).append((place - int(at[doc]), place - int(at[doc]) + table.length))
                    found_items.setdefault(doc, set()).update(table.items[pattern])
        counts.append(np.diff(at))
        for i in range(len(offs) - 1):
            spans.append(found_spans.get(i, []))
            items.append(found_items.get(i, set()))
    return (np.concatenate(counts) if counts else np.zeros(0, np.int64)), spans, items


def find_benchmark_words(
    documents: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """All columns of ``documents`` plus n_words, hit_words (word positions), hit_items (ids as text, in order).

    Null or empty texts and items have no words; an item with fewer than ``window`` words is one pattern. Repeated rows are
    kept and answered one by one; equal item ids count once, a null item id is the empty id. Columns of documents with a
    result's name are replaced by the result.
    """
    spark = documents.sparkSession
    names = ("n_words", "hit_words", "hit_items")
    kept = documents.drop(*names)
    result = kept.withColumns({"n_words": F.lit(0).cast("long"), "hit_words": F.array().cast("array<long>"), "hit_items": F.array().cast("array<string>")})
    first = True
    for rows in blocks_of(benchmark, item_id, item_text, block_bytes):
        tables = spark.sparkContext.broadcast(compile_block(rows, window))
        if not first:
            result = C.settle(result)
        first = False
        result = result.mapInArrow(_pass(tables, text), result.schema)
    if first:
        result = result.mapInArrow(_pass(spark.sparkContext.broadcast([]), text), result.schema)
    return result


def _pass(tables, text: str):
    def run(batches):
        for batch in batches:
            counts, spans, items = _search_batch(tables.value, batch.column(batch.schema.names.index(text)))
            names = batch.schema.names
            old_words, old_items = batch.column(names.index("hit_words")), batch.column(names.index("hit_items"))
            hit_words, hit_items = [], []
            for i, (s, it) in enumerate(zip(spans, items)):
                known = old_words[i].as_py() if len(old_words[i]) else []
                if s:
                    hit = set(known)
                    for a, b in s:
                        hit.update(range(a, b))
                    known = sorted(hit)
                hit_words.append(known)
                ids = old_items[i].as_py() if len(old_items[i]) else []
                hit_items.append(sorted(set(ids) | it) if it else ids)
            made = {
                "n_words": pa.array(counts, pa.int64()), "hit_words": pa.array(hit_words, pa.list_(pa.int64())),
                "hit_items": pa.array(hit_items, pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_arrays([made.get(n, batch.column(i)) for i, n in enumerate(names)], names=names)

    return run


def item_digest(ids):
    """Hex digest of item ids in text order, joined by commas."""
    return F.sha2(F.concat_ws(",", F.array_sort(ids)), 256)


def op10_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_benchmark_words(docs, bench)
    return found.select(
        "doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        item_digest(F.col("hit_items")).alias("items_sha256"), (F.size("hit_words") > 0).alias("contaminated"),
    )
