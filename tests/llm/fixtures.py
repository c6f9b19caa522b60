"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

import random

SYLLABLES = "an the er ing ou ti con de la mo re st ve li qu ar".split()


def prose(words: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words))


def texts() -> list[tuple]:
    """(doc_id, text, source) rows."""
    base, shared = prose(120, 1), prose(60, 2)
    near = base.split()
    near[60] = "changed"
    words = prose(90, 5)
    return [
        (7, base, "b"), (3, base, "a"), (11, " ".join(near), None), (12, base.upper(), "b"),
        (20, prose(40, 3) + " " + shared + " " + prose(30, 4), "a"), (21, shared, "a"), (22, shared + " tail", "c"),
        (23, prose(10, 9) + "\n" + shared[:200] + "x" + shared[:200], "b"),
        (30, None, "a"), (31, "", "b"), (32, " \t\n", None), (33, "one", "a"), (34, "one", "b"), (35, "two words", "a"),
        (40, "la " * 300, "a"), (41, "la " * 80 + "end", "b"), (42, words + " " + words, "c"),
        (50, "ñandú été " * 40 + "😀 <|im_end|>", "b"), (51, prose(4000, 6), "a"), (52, prose(4000, 6)[:9000], "a"),
        (60, "x" * 400, "a"), (61, "x" * 400 + "y", "a"), (62, "The Cat sat on the mat, and THE dog too", "b"),
    ]


def documents(spark, rows=None, extra: str = ""):
    rows = texts() if rows is None else rows
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for name in extra.split():
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit("kept"))
    return df


def by_id(df) -> dict:
    return {r["doc_id"]: r.asDict() for r in df.collect()}
