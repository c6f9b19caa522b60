"""Language-model scores of whole documents.

Word counts come from all training documents: each unit of a few megabytes sends its distinct words with their counts to
key ranges and gets the corpus counts of just these words back. The model is a gated recurrent network over 256 symbols:
the most frequent words, and 64 groups of all other words by their last letters. A word outside the frequent ones has the
probability of its group times its share of the group's counts, so every text has a proper probability, unknown words
included. The network is warmed up on a bounded start, then every Spark partition trains a copy on all its training
documents, and the copies are averaged by their tokens. A small part of the unigram model is mixed in.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm import common as C
from cartloom.llm import gru
from cartloom.llm import repeats as R

TAILS = 64
FREQUENT = gru.SYMBOLS - TAILS
END = np.uint64(0x00E0D00E0D00E0D1)
FOLDS, HELD_FOLD = 7, 2
NETWORK_SHARE = 0.95
WARM_UNITS = 4
WARM_RATE, RATE = 0.02, 0.005
FLUSH_TOKENS = 8_000_000


def remainder(ident, divisor: int) -> int:
    """crc32 of the id as text, modulo the divisor; a null id is the empty text."""
    return zlib.crc32(b"" if ident is None else str(ident).encode()) % divisor


class Tokens:
    """A unit's tokens: its words in order, each document closed by the end token.

    Texts are split and their words sorted once; units travel as the distinct words, and for each token the place of its
    word among them, so that training and scoring read these and never a text.
    """

    def __init__(self, batch: pa.RecordBatch):
        data, offsets = C.buffers(batch.column(1))
        codes, starts, ends, at = C.word_codes(data, offsets, C.SPACED, C.LOWER)
        self.ids = batch.column(0).to_pylist()
        docs = len(self.ids)
        self.held = np.array([remainder(i, FOLDS) == HELD_FOLD for i in self.ids], bool)
        self.at = at + np.arange(docs + 1)
        all_codes = np.empty(len(codes) + docs, np.uint64)
        is_end = np.zeros(len(all_codes), bool)
        is_end[self.at[1:] - 1] = True
        all_codes[is_end], all_codes[~is_end] = END, codes
        last = C.LOWER[data]
        tail = np.zeros(len(all_codes), np.uint8)
        two = last[ends - 1].astype(np.uint64) | (last[np.maximum(ends - 2, starts)].astype(np.uint64) << C.U64(8)) if len(codes) else np.zeros(0, np.uint64)
        tail[~is_end] = (C.mix(two + C.U64(1)) % C.U64(TAILS)).astype(np.uint8)
        self.words, first, self.back = np.unique(all_codes, return_index=True, return_inverse=True)
        self.tail = tail[first]
        learn = np.repeat(~self.held, np.diff(self.at))
        self.count = np.bincount(self.back[learn], minlength=len(self.words)).astype(np.uint32)

    def store(self) -> bytes:
        none = np.array([i is None for i in self.ids], np.uint8)
        ids = np.array([0 if i is None else i for i in self.ids], np.int64)
        return R.pack([ids, none, self.held.astype(np.uint8), self.at.astype(np.int64), self.words, self.tail, self.back.astype(np.uint32)])

    @classmethod
    def load(cls, blob: bytes) -> Tokens:
        t = cls.__new__(cls)
        ids, none, held, t.at, t.words, t.tail, t.back = R.unpack(blob)
        t.ids = [None if n else i for i, n in zip(ids.tolist(), none.tolist())]
        t.held = held.astype(bool)
        return t


def _build(docs: DataFrame, unit_bytes: int, buckets: int) -> DataFrame:
    """Stored units (no bucket) and their word counts by bucket."""

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        for piece in R._slices(batches, "text", unit_bytes):
            unit = (part << 28) + seq
            seq += 1
            t = Tokens(piece)
            rows = R._bucket_rows(unit, R.hash_bucket(t.words, buckets), [t.words, t.count, t.tail])
            yield pa.RecordBatch.from_pydict(
                {"unit": rows["unit"] + [unit], "bucket": rows["bucket"] + [None], "blob": rows["blob"] + [t.store()]}, R.ROWS
            )

    return docs.mapInArrow(run, R.ROWS_SQL)


def _count(records: DataFrame) -> DataFrame:
    """Corpus counts back to every unit, and one row of statistics per bucket (unit -1)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [R.unpack(b) for b in pdf["blob"]]
        words, count, tail = (np.concatenate(a) for a in zip(*parts))
        distinct, first, back = np.unique(words, return_index=True, return_inverse=True)
        total = np.bincount(back, count, len(distinct)).astype(np.uint64)
        cut = np.split(total[back], np.cumsum([len(p[0]) for p in parts])[:-1])
        known = total > 0
        groups = np.bincount(tail[first][known], (total[known] + C.U64(1)).astype(float), TAILS).astype(np.uint64)
        top = np.lexsort((distinct, -total.astype(np.int64)))[:FREQUENT]
        stats = R.pack([np.array([known.sum(), total.sum()], np.uint64), groups, distinct[top], total[top], tail[first][top]])
        return pd.DataFrame({
            "unit": [*pdf["unit"], -1], "bucket": [*pdf["bucket"], pdf["bucket"].iat[0]], "blob": [*[R.pack([c]) for c in cut], stats],
        })

    return records.groupBy("bucket").applyInPandas(run, R.ROWS_SQL)


class Vocabulary:
    """Corpus totals, the frequent words in symbol order, and the share of every group."""

    def __init__(self, counts: DataFrame):
        stats = counts.where("unit = -1").select("blob")

        def sums(batches):
            for batch in batches:
                for blob in batch.column(0):
                    n, groups, *_ = R.unpack(blob.as_py())
                    yield pa.RecordBatch.from_pydict({"k": pa.array(np.arange(2 + TAILS), pa.int32()), "v": pa.array(np.r_[n, groups].astype(np.int64))})

        def tops(batches):
            for batch in batches:
                for blob in batch.column(0):
                    _, _, word, count, tail = R.unpack(blob.as_py())
                    yield pa.RecordBatch.from_pydict({"word": pa.array(word.view(np.int64)), "count": pa.array(count.astype(np.int64)), "tail": pa.array(tail.astype(np.int32))})

        total = {r["k"]: r["v"] for r in stats.mapInArrow(sums, "k int, v long").groupBy("k").agg(F.sum("v").alias("v")).collect()}
        self.distinct, self.tokens = total.get(0, 0), total.get(1, 0)
        rows = stats.mapInArrow(tops, "word long, count long, tail int").orderBy(F.col("count").desc(), "word").limit(FREQUENT).collect()
        rows = [r for r in rows if r["count"] > 0]
        end = int(END.view(np.int64))
        if all(r["word"] != end for r in rows):  # the end token is always a symbol of its own
            rows = rows[: FREQUENT - 1]
            word = np.array([r["word"] for r in rows] + [end], np.int64).view(np.uint64)
        else:
            word = np.array([r["word"] for r in rows], np.int64).view(np.uint64)
        self.order = np.argsort(word)
        self.word = word[self.order]
        self.symbol = np.arange(len(word))[self.order]
        groups = np.array([total.get(2 + k, 0) for k in range(TAILS)], float)
        self.counts = np.zeros(gru.SYMBOLS)
        for s, r in enumerate(rows):
            groups[r["tail"]] -= r["count"] + 1
            self.counts[s] = r["count"]
        self.counts[FREQUENT:] = np.maximum(groups, 0)
        self.groups = np.maximum(groups, 0) + 1  # one for the words that training never saw

    def symbols(self, t: Tokens, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol of each distinct word and the log of its share in the symbol."""
        at = np.minimum(np.searchsorted(self.word, t.words), len(self.word) - 1)
        frequent = self.word[at] == t.words
        symbol = np.where(frequent, self.symbol[at], FREQUENT + t.tail.astype(np.int64))
        share = np.where(frequent, 0.0, np.log((count + 1) / self.groups[t.tail]))
        return symbol.astype(np.int16), share


def _units(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            t = Tokens.load(batch.column(1)[i].as_py())
            count = R._verdicts(batch.column(2)[i].as_py()).astype(np.float64)
            yield t, count


def _training(units, vocabulary: Vocabulary):
    """Symbols and offsets of training documents, in pieces of bounded size."""
    parts, sizes, have = [], [], 0
    for t, count in units:
        symbol, _ = vocabulary.symbols(t, count)
        keep = np.repeat(~t.held, np.diff(t.at))
        parts.append(symbol[t.back[keep]])
        sizes.append(np.diff(t.at)[~t.held])
        have += int(keep.sum())
        if have >= FLUSH_TOKENS:
            yield np.concatenate(parts), np.r_[0, np.cumsum(np.concatenate(sizes))]
            parts, sizes, have = [], [], 0
    if have:
        yield np.concatenate(parts), np.r_[0, np.cumsum(np.concatenate(sizes))]


def _average(joined: DataFrame, vocabulary, start, rate: float) -> np.ndarray | None:
    """Copies trained on all partitions, averaged by tokens; sums are added up in Spark, a parameter a row."""

    def run(batches):
        p, tokens = gru.Params.of(start.value), 0
        for symbols, at in _training(_units(batches), vocabulary.value):
            gru.learn(p, symbols, at, rate)
            tokens += len(symbols)
        if tokens:
            flat = p.flat().astype(np.float64) * tokens
            yield pa.RecordBatch.from_pydict({"k": pa.array(np.arange(-1, len(flat)), pa.int32()), "v": pa.array(np.r_[float(tokens), flat])})

    rows = joined.mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).toPandas().sort_values("k")
    if not len(rows):
        return None
    values = rows["v"].to_numpy()
    return (values[1:] / values[0]).astype(np.float32)


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(
    documents: DataFrame, text: str = "text", ident: str = "doc_id", unit_bytes: int = R.UNIT_BYTES, bucket_bytes: int = R.BUCKET_BYTES
) -> DataFrame:
    """One row per document with its unigram score and the network's score, both log10 probabilities of the whole text.

    A null or empty text is the end token alone; a null id is in no held-out fold; repeated rows count each. Without any
    training document both scores fall back to the counts, which are then all 0.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col(ident).cast("long").alias("doc_id"), F.col(text).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    stored = C.settle(_build(docs, unit_bytes, max(1, -(-total // bucket_bytes))))
    counts = C.settle(_count(stored.where("bucket is not null")))
    C.release(spark)
    vocabulary = Vocabulary(counts)
    shipped = spark.sparkContext.broadcast(vocabulary)
    bodies, answers = stored.where("bucket is null").select("unit", "blob"), counts.where("unit >= 0")

    def answered(units: DataFrame, answers: DataFrame) -> DataFrame:
        replies = answers.groupBy("unit").agg(F.collect_list(F.struct("bucket", "blob")).alias("reply"))
        return units.join(replies, "unit").select("unit", "blob", "reply")

    joined = answered(bodies, answers)
    first = spark.sparkContext.broadcast(gru.Params.start(vocabulary.counts).flat())
    start_units = bodies.select("unit").orderBy(F.xxhash64("unit"), "unit").limit(WARM_UNITS)
    flat = first.value
    # At most WARM_UNITS units and their replies, one copy.
    few = F.broadcast(start_units)
    warm = _average(answered(bodies.join(few, "unit"), answers.join(few, "unit", "left_semi")).coalesce(1), shipped, first, WARM_RATE)
    C.release(spark)
    if warm is not None:
        flat = _average(joined, shipped, spark.sparkContext.broadcast(warm), RATE)
    C.release(spark)
    params = spark.sparkContext.broadcast(flat)

    def run(batches):
        held, size = [], 0
        for t, count in _units(batches):
            held.append((t, count))
            size += len(t.back)
            if size >= FLUSH_TOKENS:
                yield _scores(held, shipped.value, gru.Params.of(params.value))
                held, size = [], 0
        if held:
            yield _scores(held, shipped.value, gru.Params.of(params.value))

    return joined.mapInArrow(run, RESULT)


def _scores(units: list, vocabulary: Vocabulary, p: gru.Params) -> pa.RecordBatch:
    symbols, shares, base, known, sizes, ids, held = [], [], [], [], [], [], []
    whole = np.log(vocabulary.tokens + vocabulary.distinct + 1)
    for t, count in units:
        symbol, share = vocabulary.symbols(t, count)
        symbols.append(symbol[t.back])
        shares.append(share[t.back])
        base.append((np.log(count + 1) - whole)[t.back])
        known.append((count > 0)[t.back])
        sizes.append(np.diff(t.at))
        ids += t.ids
        held.append(t.held)
    symbols, shares, base, known, sizes = (np.concatenate(x) for x in (symbols, shares, base, known, sizes))
    at = np.r_[0, np.cumsum(sizes)]
    network = gru.log_probs(p, symbols, at) + shares
    mixed = np.logaddexp(network + np.log(NETWORK_SHARE), base + np.log(1 - NETWORK_SHARE))
    tenth = 1 / np.log(10)
    add = lambda x: np.add.reduceat(x, at[:-1])
    n = len(ids)
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array(np.concatenate(held)), pa.array(sizes.astype(np.int64)), pa.array(add(known.astype(np.int64))),
        pa.array(np.full(n, vocabulary.tokens, np.int64)), pa.array(add(base) * tenth), pa.array(add(mixed) * tenth),
    ], names=[f.split()[0] for f in RESULT.split(", ")])


def op4_lm_score(spark, sf_dir: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
