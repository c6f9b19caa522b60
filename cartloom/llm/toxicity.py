"""Toxicity by class-conditional Kneser-Ney models over the bytes of words.

Two models, one of toxic and one of ordinary text, give the likelihood of every word byte by byte. Long contexts are
counted per class; below them both back off to the same continuation counts, so an expression that neither class knows
well says nothing. A document's features are the length-normalised difference of the two log-likelihoods and how far its
most telling words go; a logistic fit on documents that the models did not see turns them into a probability.

The classifier is fitted on at most ``sample_rows`` labelled documents of each class, chosen by a hash of their id; all
documents are scored on their whole texts, each in its own task.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.llm import common as C

SAMPLE_ROWS = 2500
ORDER = 6
CLASS_FROM = 4
DISCOUNT = 0.75
THRESHOLD = 0.7
WORD_BYTES = 64  # symbols of one piece; longer words are scored piece by piece
FEATURES = 6


def _pieces(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all words with marks before and after, the word of each, and the place in the word."""
    size = np.array([len(w) + 2 for w in words], np.int32)
    symbols = np.frombuffer(b"".join([b"\x02" + w + b"\x03" for w in words]), np.uint8)
    of = np.repeat(np.arange(len(words), dtype=np.int32), size)
    place = np.arange(len(symbols), dtype=np.int32) - np.repeat((np.cumsum(size) - size).astype(np.int32), size)
    return symbols, of, place


def _grams(symbols: np.ndarray, n: int) -> np.ndarray:
    """The last n bytes at each position as one number, the length in its top byte."""
    out = np.zeros(len(symbols), np.uint64)
    for j in range(n):
        out[n - 1 :] |= symbols[n - 1 - j : len(symbols) - j].astype(np.uint64) << C.U64(8 * j)
    return out


class Table:
    """Sorted keys with values; unknown keys give 0."""

    def __init__(self, keys: np.ndarray, **values: np.ndarray):
        self.keys, self.values = keys, {k: v.astype(np.float32) for k, v in values.items()}

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys


def _level(keys: np.ndarray, weight: np.ndarray) -> tuple[Table, Table]:
    """Counts of one order: of strings, and of contexts their total and number of continuations."""
    gram, back = np.unique(keys, return_inverse=True)
    count = np.bincount(back, weight, len(gram))
    context, back = np.unique(gram >> C.U64(8), return_inverse=True)
    total = np.bincount(back, count, len(context))
    kinds = np.bincount(back, minlength=len(context))
    return Table(gram, count=count), Table(context, total=total, kinds=kinds)


@dataclass
class KneserNey:
    """Shared continuation counts for short contexts and counts per class for long ones."""

    shared: list[tuple[Table, Table]]
    per_class: list[list[tuple[Table, Table]]]

    @staticmethod
    def fit(words: list[bytes], ordinary: np.ndarray, toxic: np.ndarray) -> KneserNey:
        symbols, of, place = _pieces(words)
        shared = []
        for n in range(1, CLASS_FROM):
            # A continuation counts once for each different symbol before it.
            at = np.flatnonzero(place >= max(n, 1))
            longer = np.unique(_grams(symbols, n + 1)[at])
            shared.append(_level(longer & C.U64((1 << (8 * n)) - 1), np.ones(len(longer))))
        per_class = []
        for weight in (ordinary, toxic):
            levels = []
            for n in range(CLASS_FROM, ORDER + 1):
                at = np.flatnonzero((place >= n - 1) & (weight[of] > 0))
                levels.append(_level(_grams(symbols, n)[at], weight[of[at]].astype(float)))
            per_class.append(levels)
        return KneserNey(shared, per_class)

    def _raise(self, p: np.ndarray, level: tuple[Table, Table], keys: np.ndarray, usable: np.ndarray) -> np.ndarray:
        grams, contexts = level
        at, known = contexts.get(keys >> C.U64(8))
        known &= usable
        if not known.any():
            return p
        total, kinds = contexts.values["total"][at], contexts.values["kinds"][at]
        g, seen = grams.get(keys)
        count = np.where(seen, grams.values["count"][g], 0.0)
        safe = np.where(known, total, 1.0)
        return np.where(known, np.maximum(count - DISCOUNT, 0.0) / safe + DISCOUNT * kinds / safe * p, p)

    def ratio(self, words: list[bytes]) -> np.ndarray:
        """Toxic minus ordinary log-likelihood of each word."""
        if not words:
            return np.zeros(0)
        symbols, of, place = _pieces(words)
        base = np.full(len(symbols), 1 / 256)
        for n, level in enumerate(self.shared, 1):
            base = self._raise(base, level, _grams(symbols, n), place >= max(n - 1, 1))
        logs = []
        for levels in self.per_class:
            p = base
            for n, level in enumerate(levels, CLASS_FROM):
                p = self._raise(p, level, _grams(symbols, n), place >= n - 1)
            logs.append(np.log(p))
        return np.bincount(of, np.where(place > 0, logs[1] - logs[0], 0.0), len(words))


class WordRatios:
    """Ratios of the words met so far, so that a task scores each different word once; beyond ``room`` words it starts anew."""

    def __init__(self, model: KneserNey, room: int = 1 << 20):
        self.model, self.room = model, room
        self.codes, self.ratios = np.zeros(0, np.uint64), np.zeros(0)

    def of(self, codes: np.ndarray, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Ratio of every word, given its code and its place in raw."""
        kinds, first, back = np.unique(codes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.codes, kinds)
        new = np.ones(len(kinds), bool)
        within = at < len(self.codes)
        new[within] = self.codes[at[within]] != kinds[within]
        ratio = np.zeros(len(kinds))
        ratio[~new] = self.ratios[at[~new]]
        words, owner = [], []
        for k, (s, e) in enumerate(zip(starts[first[new]].tolist(), ends[first[new]].tolist())):
            for j in range(s, e, WORD_BYTES):
                words.append(raw[j : min(j + WORD_BYTES, e)])
                owner.append(k)
        if words:
            ratio[new] = np.bincount(owner, self.model.ratio(words), int(new.sum()))
            if len(self.codes) + len(words) > self.room:
                self.codes, self.ratios = kinds, ratio
            else:
                self.codes = np.insert(self.codes, at[new], kinds[new])
                self.ratios = np.insert(self.ratios, at[new], ratio[new])
        return ratio[back]


def text_features(column: pa.Array, ratios: WordRatios) -> np.ndarray:
    """Features of every text; texts without words have none but the constant."""
    data, offsets = C.buffers(column)
    out = []
    for _, _, part, offs in C.chunks(data, offsets):
        codes, starts, ends, at = C.word_codes(part, offs, C.SPACED, C.LOWER)
        ratio = ratios.of(codes, C.LOWER[part].tobytes(), starts, ends)
        size = np.diff(at)
        doc = np.repeat(np.arange(len(size)), size)
        bytes_ = np.bincount(doc, (ends - starts) + 1.0, len(size))
        some = np.maximum(size, 1)
        order = np.lexsort((-ratio, doc))
        rank = np.arange(len(order)) - np.repeat(at[:-1], size)
        top = [np.bincount(doc[order][rank == k], ratio[order][rank == k], len(size)) for k in range(3)]
        f = np.ones((len(size), FEATURES))
        f[:, 1] = np.bincount(doc, ratio, len(size)) / np.maximum(bytes_, 1)
        f[:, 2] = np.clip(top[0], 0, 20) / 5
        f[:, 3] = np.clip(top[1], 0, 20) / 5
        f[:, 4] = np.clip(top[2], 0, 20) / 5
        f[:, 5] = np.bincount(doc, np.clip(ratio, 0, 20), len(size)) / np.sqrt(some)
        f[size == 0, 1:] = 0
        out.append(f)
    return np.concatenate(out) if out else np.zeros((0, FEATURES))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, decay: float = 1.0) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), decay)
    ridge[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9)
        step = np.linalg.solve(hess, grad)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def id_remainder(ident: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo the divisor; null ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def training_rows(documents: DataFrame, labels: DataFrame, text: str, ident: str, label: str, rows: int) -> tuple[DataFrame, dict]:
    """At most ``rows`` labelled documents of each class in hash order, and the class sizes."""
    known = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    known = known.groupBy("id").agg(F.max("y").alias("y")).where(id_remainder(F.col("id"), 3) != 1)
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    by_hash = [F.xxhash64(F.col("id")), F.col("id")]
    picked = known.where("y = 1").orderBy(*by_hash).limit(rows).union(known.where("y = 0").orderBy(*by_hash).limit(rows))
    docs = documents.select(F.col(ident).alias("id"), F.col(text).alias("text"))
    joined = docs.join(F.broadcast(picked), "id").select("id", "y", F.pmod(F.xxhash64(F.col("id"), F.lit(1)), F.lit(2)).cast("int").alias("fold"), "text")
    return joined, sizes


def _count_words(rows: DataFrame) -> DataFrame:
    """Distinct words of the sample with their counts by fold and class."""

    def run(batches):
        for batch in batches:
            y, fold = batch.column(0).to_numpy(False), batch.column(1).to_numpy(False)
            data, offsets = C.buffers(batch.column(2))
            folded = C.LOWER[data]
            starts, ends, at = C.words(data, offsets, C.SPACED)
            raw = folded.tobytes()
            doc = np.repeat(np.arange(len(y)), np.diff(at))
            cell = (fold * 2 + y)[doc]
            words = pd.Series([raw[s : min(e, s + WORD_BYTES)] for s, e in zip(starts.tolist(), ends.tolist())], dtype=object)
            counted = pd.DataFrame({"word": words, "cell": cell}).value_counts().reset_index(name="n")
            yield pa.RecordBatch.from_arrays(
                [pa.array(counted["word"].tolist(), pa.binary()), pa.array(counted["cell"].to_numpy(np.int32), pa.int32()), pa.array(counted["n"].to_numpy(np.int64), pa.int64())],
                names=["word", "cell", "n"],
            )

    counted = rows.select("y", "fold", "text").mapInArrow(run, "word binary, cell int, n long")
    return counted.groupBy("word").agg(*[F.sum(F.when(F.col("cell") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(4)])


# Cells (ordinary, toxic) that each model learns from: all of the sample, its second half, its first half.
MODEL_CELLS = [((0, 2), (1, 3)), ((2,), (3,)), ((0,), (1,))]


def _fit_models(table: DataFrame) -> list[bytes]:
    """The three models, each fitted in a task of its own on the words of the sample and handed on pickled, some 10 MB."""

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        which = int(pdf["model"].iat[0])
        pdf = pdf.sort_values("word")
        ordinary, toxic = (sum(pdf[f"n{k}"].to_numpy(np.int64) for k in cells) for cells in MODEL_CELLS[which])
        return pd.DataFrame({"model": [which], "blob": [pickle.dumps(KneserNey.fit([bytes(w) for w in pdf["word"]], ordinary, toxic))]})

    spread = table.withColumn("model", F.explode(F.array(*[F.lit(k) for k in range(len(MODEL_CELLS))])))
    fitted = {r["model"]: bytes(r["blob"]) for r in spread.groupBy("model").applyInPandas(fit, "model int, blob binary").collect()}
    none = np.zeros(0, np.int64)
    return [fitted.get(k) or pickle.dumps(KneserNey.fit([], none, none)) for k in range(len(MODEL_CELLS))]


@dataclass
class Classifier:
    model: KneserNey
    weights: np.ndarray

    def score(self, column: pa.Array, ratios: WordRatios) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(text_features(column, ratios) @ self.weights, -30, 30)))


def train(documents: DataFrame, labels: DataFrame, text: str = "text", ident: str = "doc_id", label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Classifier:
    """Fit on labelled rows whose id's crc32 modulo 3 is not 1; without both classes every score is the share of label 1."""
    C.small_batches(documents.sparkSession)
    rows, sizes = training_rows(documents, labels, text, ident, label, sample_rows)
    rows = C.settle(rows)
    whole, *parts = _fit_models(_count_words(rows))
    # Features of each half come from models of the other half.
    halves = rows.sparkSession.sparkContext.broadcast(parts)

    def run(batches):
        ratios = [WordRatios(pickle.loads(m)) for m in halves.value]
        for batch in batches:
            fold = batch.column(1).to_numpy(False)
            both = [text_features(batch.column(2), r) for r in ratios]
            f = np.where((fold == 0)[:, None], both[0], both[1])
            yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(f[:, j]) for j in range(FEATURES)], names=["y"] + [f"f{j}" for j in range(FEATURES)])

    fields = ", ".join(f"f{j} double" for j in range(FEATURES))
    seen = rows.select("y", "fold", "text").mapInArrow(run, f"y int, {fields}").toPandas()
    halves.destroy()
    y = seen["y"].to_numpy(float)
    weights = np.zeros(FEATURES)
    total = sum(sizes.values())
    share = np.clip(sizes.get(1, 0) / total, 1e-3, 1 - 1e-3) if total else 1e-3
    if len(set(y.tolist())) < 2:
        weights[0] = np.log(share / (1 - share))
    else:
        # Each class weighs as much as it has labelled rows.
        weight = np.where(y == 1, sizes[1] / (y == 1).sum(), sizes[0] / (y == 0).sum())
        weights = _logistic(seen.drop(columns="y").to_numpy(float), y, weight * len(y) / weight.sum())
    return Classifier(pickle.loads(whole), weights)


def score_toxicity(documents: DataFrame, classifier: Classifier, text: str = "text", score: str = "score") -> DataFrame:
    """All rows of documents plus their score between 0 and 1; null and empty texts score as texts without words."""
    C.small_batches(documents.sparkSession)
    shipped = documents.sparkSession.sparkContext.broadcast(classifier)
    docs = documents.drop(score)
    at = docs.columns.index(text)

    def run(batches):
        ratios = WordRatios(shipped.value.model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(batch.columns + [pa.array(shipped.value.score(batch.column(at), ratios))], names=batch.schema.names + [score])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"`{score}` double"])
    return docs.mapInArrow(run, schema)


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    classifier = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_toxicity(docs, classifier)
    return scored.select(
        "doc_id", (id_remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
