"""Languages by compressed size: a plain loop with the same dictionaries, held-out accuracy, awkward rows."""

import pytest
import zstandard
from pyspark.sql import functions as F

from cartloom.llm import language as L

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def told(spark):
    df = L.op12_language(spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id").alias("id"), "lang", "text")
    return df.join(truth, df["doc_id"] == truth["id"]).drop("id").collect()


def test_held_out_accuracy(told):
    unseen = [r for r in told if r["held_out"] and r["lang"] is not None and r["lang_pred"] != "und"]
    assert len(unseen) > 250
    assert sum(r["lang"] == r["lang_pred"] for r in unseen) / len(unseen) > 0.97
    sure = [r for r in unseen if not r["rejected"]]
    assert len(sure) > 0.9 * len(unseen) and sum(r["lang"] == r["lang_pred"] for r in sure) / len(sure) > 0.98


def test_contract(told, spark):
    assert len(told) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in told:
        has_letter = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not has_letter) and 0 <= r["score"] <= 1


def rows():
    en, de = "the cat and the house are there with the other ones ", "der hund und das haus stehen nicht weit von den anderen "
    out = [(i, en * (1 + i % 3), "en") for i in range(20)] + [(100 + i, de * (1 + i % 3), "de") for i in range(20)]
    out += [(200, None, "en"), (201, "", "en"), (202, " 12 !! ", "de"), (203, en, None), (204, de * 3000, None), (None, en, "en"), (3, en, "en")]
    return out


def plain(texts, learned):
    out = {}
    for key, text in texts:
        best = []
        for lang, content in learned:
            p = zstandard.ZstdCompressionParameters(**L.PARAMETERS)
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw = text.encode()
            best.append((sum(len(zstandard.ZstdCompressor(dict_data=d, compression_params=p).compress(raw[k : k + L.BLOCK_BYTES])) for k in range(0, len(raw), L.BLOCK_BYTES)), lang))
        out[key] = min(best)[1]
    return out


@pytest.mark.parametrize("per_block", [64, 1])
def test_answers_equal_a_plain_loop(spark, monkeypatch, per_block):
    monkeypatch.setattr(L, "BLOCK_LANGUAGES", per_block)
    df = spark.createDataFrame(rows(), SCHEMA).withColumns({"score": F.lit("x"), "lang1": F.lit("kept")})
    learned = L.dictionaries(df)
    got = L.identify(df.drop("lang"), learned).withColumn("clean", L.letters(F.col("text"))).collect()
    assert len(got) == len(rows()) and {r["lang1"] for r in got} == {"kept"}
    content = [(r["lang"], bytes(r["dictionary"])) for r in learned.orderBy("lang").collect()]
    want = plain([(r["text"], r["clean"]) for r in got if r["clean"]], content)
    for r in got:
        assert r["lang_pred"] == (want[r["text"]] if r["clean"] else "und")
        if r["lang_pred"] == "und":
            assert r["score"] == 0 and r["rejected"]
    assert {r["doc_id"]: r["lang_pred"] for r in got}[204] == "de"


def test_dictionaries_are_bounded_and_repeatable(spark):
    df = spark.createDataFrame([(i, "la casa blanca " * 400, "es") for i in range(600)], SCHEMA)
    first, again = L.dictionaries(df).collect(), L.dictionaries(df.repartition(7)).collect()
    assert [tuple(r) for r in first] == [tuple(r) for r in again] and len(first[0]["dictionary"]) <= L.DICT_BYTES


def test_no_rows_no_languages_one_language(spark):
    empty = spark.createDataFrame([], SCHEMA)
    df = spark.createDataFrame(rows(), SCHEMA)
    assert L.identify(empty, L.dictionaries(df)).collect() == []
    assert {(r["lang_pred"], r["score"]) for r in L.identify(df, L.dictionaries(empty)).collect()} == {("und", 0.0)}
    only = L.identify(df, L.dictionaries(df.where("lang = 'en'"))).collect()
    assert {r["lang_pred"] for r in only} == {"en", "und"} and {r["score"] for r in only} == {0.0, 1.0}
