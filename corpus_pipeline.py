"""From raw documents to a training mix: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm.decontaminate import find_benchmark_words
from cartloom.llm.minhash import near_duplicates
from cartloom.llm.mixture import mix_sources
from cartloom.llm.suffixes import remove_repeated_bytes
from cartloom.llm.toxicity import THRESHOLD, score_toxicity, train
from cartloom.session import checkpoint_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold, learned from the labels of the documents given."""
    classifier = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_toxicity(docs, classifier, score="__score")
    return scored.where(F.col("__score") < THRESHOLD).drop("__score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id, one row of each repeated row."""
    kept = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("__kept")).distinct()
    chosen = docs.join(kept, docs["doc_id"].eqNullSafe(kept["__kept"]), "left_semi")
    return chosen.withColumn("__text", F.xxhash64("text")).dropDuplicates(["doc_id", "__text"]).drop("__text")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that a document with a smaller id has as well; n_chars follows the text."""
    cut = remove_repeated_bytes(docs, rewrite=True)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten consecutive words of a benchmark item."""
    found = find_benchmark_words(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(F.size("hit_words") == 0).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by what the weights of their sources ask for."""
    return mix_sources(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("repeated substrings", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("source mix", mix),
]

# No SQL: the toxicity stage is a trained classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what lies between goes to the shared checkpoint folder."""
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
