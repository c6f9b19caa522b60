"""Language identification by compression: the language whose dictionary shortens a text most.

Each language has a raw-content zstandard dictionary of at most ``DICT_BYTES`` bytes, made of pieces of sampled training
texts. A text, lower-cased and reduced to its letters and single spaces, is encoded in blocks of ``BLOCK_BYTES`` with every
dictionary, so that the dictionary matters as much at the end of a long text as at its beginning, and the sizes of all
blocks are summed. The smallest sum wins; a narrow margin to the second marks the answer as rejected.

Bounds: the fit reads one piece of at most ``SAMPLE_ROWS`` training documents a language, those with the smallest hashes.
Dictionaries go to the tasks ``BLOCK_LANGUAGES`` at a time, at most 4 MB, however many languages there are.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartloom.llm import common as C

SAMPLE_ROWS = 400
PIECE_CHARS = 512
DICT_BYTES = 1 << 16
BLOCK_BYTES = 1 << 12
BLOCK_LANGUAGES = 64
# Relative difference of the two smallest sizes below which an answer is rejected, and the scale of the score.
MIN_MARGIN = 0.01
SCALE = 0.02
UNKNOWN = "und"
PARAMETERS = dict(
    window_log=18, hash_log=16, chain_log=16, search_log=3, min_match=3, target_length=16, strategy=zstandard.STRATEGY_GREEDY,
    write_content_size=False,
)
# Coders of the blocks that this process used last.
_coders: dict[str, list] = {}
CODERS_KEPT = 4


def letters(text: Column) -> Column:
    """Lower-cased letters, everything else as one blank; empty where a text has no letter, null for null."""
    return F.trim(F.regexp_replace(F.lower(text), "[^\\p{L}]+", " "))


def dictionaries(training: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """(lang, dictionary) rows learned from the given rows, by language.

    Rows without a language or without letters teach nothing. The piece of a text starts where its hash says. Rows are
    ordered by the hash of their key, then by key and piece, so reruns agree; repeated rows count as often as they occur.
    """
    spread = F.greatest(F.length(text) - 2 * PIECE_CHARS, F.lit(0)) + 1
    start = F.pmod(F.xxhash64(F.lit(3), key), spread) + 1
    pieces = training.where(F.col(lang).isNotNull() & F.col(text).rlike("\\p{L}")).select(
        F.col(lang).alias("__lang"), F.xxhash64(F.lit(5), key).alias("__order"), F.col(key).alias("__key"),
        F.substr(F.col(text), start.cast("int"), F.lit(2 * PIECE_CHARS)).alias("__piece"),
    )
    place = F.row_number().over(Window.partitionBy("__lang").orderBy("__order", "__key", "__piece"))
    sample = pieces.withColumn("__at", place).where(F.col("__at") <= SAMPLE_ROWS)
    cut = sample.select("__lang", F.struct("__at", F.left(letters(F.col("__piece")), F.lit(PIECE_CHARS)).alias("p")).alias("__p"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("__p")), lambda x: x["p"]), " ")
    whole = cut.groupBy("__lang").agg(F.encode(joined, "UTF-8").alias("__all"))
    return whole.select(F.col("__lang").alias("lang"), F.substring("__all", 1, DICT_BYTES).alias("dictionary"))


def blocks(learned: DataFrame) -> Iterator[list[tuple[str, bytes]]]:
    """Dictionaries by language, ``BLOCK_LANGUAGES`` at a time; the driver holds one block."""
    block: list[tuple[str, bytes]] = []
    for row in learned.orderBy("lang").toLocalIterator():
        block.append((row["lang"], bytes(row["dictionary"])))
        if len(block) == BLOCK_LANGUAGES:
            yield block
            block = []
    if block:
        yield block


def _coders_of(block: list[tuple[str, bytes]], key: str) -> list:
    if key not in _coders:
        made = []
        for lang, content in block:
            parameters = zstandard.ZstdCompressionParameters(**PARAMETERS)
            shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            shared.precompute_compress(compression_params=parameters)
            made.append((lang, zstandard.ZstdCompressor(dict_data=shared, compression_params=parameters)))
        while len(_coders) >= CODERS_KEPT:
            _coders.pop(next(iter(_coders)))
        _coders[key] = made
    return _coders[key]


def sizes_of(text: str, coders: list) -> list[int]:
    """Encoded bytes of the whole text under each dictionary."""
    raw = text.encode()
    parts = [raw[k : k + BLOCK_BYTES] for k in range(0, len(raw), BLOCK_BYTES)]
    return [sum(len(coder.compress(p)) for p in parts) for _, coder in coders]


def _best_two(shipped, key: str):
    """Column function: the two smallest (size, language) of a text within one block of dictionaries."""

    @F.pandas_udf("size1 long, lang1 string, size2 long, lang2 string")
    def score(texts: pd.Series) -> pd.DataFrame:
        coders = _coders_of(shipped.value, key)
        out = []
        for text in texts:
            if not text:
                out.append((None, None, None, None))
                continue
            ranked = sorted(zip(sizes_of(text, coders), (lang for lang, _ in coders)))[:2]
            second = ranked[1] if len(ranked) > 1 else (None, None)
            out.append((*ranked[0], *second))
        frame = pd.DataFrame(out, columns=["size1", "lang1", "size2", "lang2"])
        return frame.astype({"size1": "Int64", "size2": "Int64", "lang1": "object", "lang2": "object"})

    return score


def identify(documents: DataFrame, learned: DataFrame, text: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """All columns of ``documents`` plus lang_pred, score (0 to 1), margin and rejected.

    Null texts and texts without a letter are ``und`` with score 0 and rejected; so is everything where no language was
    learned. Equal sizes go to the smaller language name and count as rejected. With a single language the score is 1.
    Columns of documents with a result's name are replaced; repeated rows are answered one by one.
    """
    spark = documents.sparkSession
    learned = C.settle(learned)
    kept = documents.drop("lang_pred", "score", "margin", "rejected")
    kept = kept.withColumn("__letters", letters(F.col(text)))
    found = []
    for i, block in enumerate(blocks(learned)):
        kept = kept.withColumn(f"__b{i}", _best_two(spark.sparkContext.broadcast(block), uuid.uuid4().hex)(F.col("__letters")))
        found.append(f"__b{i}")
    if not found:
        told = kept.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "margin": F.lit(0.0), "rejected": F.lit(True)})
        return told.drop("__letters")
    pairs = F.array(*[F.struct(F.col(f"{b}.size{k}").alias("size"), F.col(f"{b}.lang{k}").alias("lang")) for b in found for k in (1, 2)])
    ranked = F.sort_array(F.filter(pairs, lambda p: p["lang"].isNotNull()))
    kept = kept.withColumns({"__first": F.get(ranked, F.lit(0)), "__second": F.get(ranked, F.lit(1))})
    known = F.col("__first").isNotNull()
    margin = F.coalesce((F.col("__second.size") - F.col("__first.size")) / F.col("__first.size"), F.lit(float("inf")))
    kept = kept.withColumn("margin", F.when(known, margin).otherwise(F.lit(0.0)))
    return kept.withColumns({
        "lang_pred": F.when(known, F.col("__first.lang")).otherwise(F.lit(UNKNOWN)),
        "score": F.when(known, 1.0 / (1.0 + F.exp(-F.col("margin") / SCALE))).otherwise(F.lit(0.0)),
        "rejected": F.col("margin") < min_margin,
    }).drop("__letters", "__first", "__second", *found)


def op12_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    learned = dictionaries(docs.where(~held_out))
    told = identify(docs.drop("lang"), learned)
    return told.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected")
