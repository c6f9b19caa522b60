"""Hard negatives by maximum inner product search: cover trees over blocks of candidates, anchors in blocks beside them.

Every task turns the rows it scans into cover trees of at most ``TREE_ROWS`` rows. Trees and anchors meet in a grid: a tree
belongs to one group of trees, an anchor to one block of anchors, and each cell of the grid searches its trees for its
anchors, best bound first. The sides of the grid grow with the tables, so a cell stays bounded. A first pass finds each
anchor's positives; their scores open the windows of the second. Cells hand on at most k rows a window, and the best of all
cells are kept by a rank that Spark also applies before the shuffle.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartloom.llm import common as C
from cartloom.llm import covertree as T

TREE_ROWS = 2048
TREES_PER_GROUP = 4
# Anchor blocks are the square root of anchors over this number: both what trees and what anchors are copied grows evenly.
ANCHORS_PER_BLOCK = 32
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
SCALE = 256

TREE_SCHEMA = "dim int, rows int, " + ", ".join(f"{name} binary" for name in T.CoverTree.FIELDS)
FOUND_SCHEMA = "anchor long, nth int, place int, id long, score long, looked long"


def quantised(vectors: DataFrame, vec_id: str, label: Column, vector: str, scale: int) -> DataFrame:
    """(id, label, q) of the rows that take part: nothing null, every component finite; q = floor(scale * x) as doubles."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    usable = F.col(vec_id).isNotNull() & label.isNotNull() & F.col(vector).isNotNull() & finite
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("double"))
    return vectors.where(F.coalesce(usable, F.lit(False))).select(
        F.col(vec_id).cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("q")
    )


def _grow(batches):
    """Cover trees of the rows of one task, one row a tree; vectors of different lengths go to different trees."""
    waiting: dict[int, list] = {}
    held = 0

    def plant(dim):
        kept = waiting.pop(dim)
        vectors = np.array([q for _, _, q in kept], dtype=np.float64).reshape(len(kept), dim)
        tree = T.CoverTree.build(vectors, np.array([i for i, _, _ in kept], np.int64), np.array([y for _, y, _ in kept], np.int64))
        made = {"dim": [dim], "rows": [len(kept)], **{k: [v] for k, v in tree.pack().items()}}
        kinds = [pa.int32(), pa.int32()] + [pa.binary()] * len(T.CoverTree.FIELDS)
        names = ["dim", "rows", *T.CoverTree.FIELDS]
        return pa.RecordBatch.from_arrays([pa.array(made[n], k) for n, k in zip(names, kinds)], names=names)

    for batch in batches:
        ids, labels = batch.column("id").to_pylist(), batch.column("label").to_pylist()
        column = batch.column("q")
        flat, ends = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False).cumsum()
        for i, y, end, size in zip(ids, labels, ends, column.value_lengths().to_pylist()):
            waiting.setdefault(size, []).append((i, y, flat[end - size : end]))
            held += 1
            if len(waiting[size]) == TREE_ROWS:
                held -= TREE_ROWS
                yield plant(size)
            if held >= 4 * TREE_ROWS:
                for dim in list(waiting):
                    yield plant(dim)
                held = 0
    for dim in list(waiting):
        yield plant(dim)


def _searcher(same: bool, k: int):
    """Cell search: the first k rows of the anchor's label (other ids) or of other labels, per anchor and window."""

    def search(trees: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        asked = [
            (int(a.id), int(a.nth), int(a.label), np.asarray(a.q, dtype=np.float64), [T.Window(lo, hi, k) for lo, hi in zip(a.lows, a.highs)], [0])
            for a in anchors.itertuples(index=False)
        ]
        for row in trees.to_dict("records"):
            tree = T.CoverTree.unpack({n: row[n] for n in T.CoverTree.FIELDS}, int(row["dim"]))
            for own, _, label, q, windows, looked in asked:
                if len(q) != row["dim"]:
                    continue
                wanted = (tree.labels == label) & (tree.ids != own) if same else tree.labels != label
                looked[0] += tree.descend(q, wanted, windows)
        out = [
            (own, nth, place, i, s, looked[0])
            for own, nth, _, _, windows, looked in asked for place, w in enumerate(windows) for i, s in zip(w.ids.tolist(), w.exact().tolist())
        ]
        return pd.DataFrame(out, columns=["anchor", "nth", "place", "id", "score", "looked"])

    return search


def _best(cells: DataFrame, k: int) -> DataFrame:
    """First k distinct (score, id) of all cells per anchor and window, with their rank."""
    turn = Window.partitionBy("anchor", "nth", "place").orderBy(F.col("score").desc(), "id")
    ranked = cells.drop("looked").withColumn("rank", F.dense_rank().over(turn)).where(F.col("rank") <= k)
    return ranked.dropDuplicates(["anchor", "nth", "place", "rank"])


def grow_trees(rows: DataFrame) -> DataFrame:
    """Cover trees over all given (id, label, q) rows, each with a number."""
    return C.settle(rows.mapInArrow(_grow, TREE_SCHEMA)).withColumn("tree", F.monotonically_increasing_id())


def search_cells(trees: DataFrame, anchors: DataFrame, groups: int, blocks: int, same: bool, k: int) -> DataFrame:
    """What each cell of the grid found for its anchors (id, nth, label, q, lows, highs)."""
    left = trees.withColumns({"group": F.pmod(F.xxhash64("tree"), F.lit(groups)), "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
    right = anchors.withColumns({"block": F.pmod(F.xxhash64("id", "nth"), F.lit(blocks)), "group": F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))})
    key = [F.col("group").cast("int"), F.col("block").cast("int")]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_searcher(same, k), FOUND_SCHEMA)


def mine_negatives(
    vectors: DataFrame, anchor: Column, vec_id: str = "vec_id", label: Column | None = None, vector: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows flagged by ``anchor``.

    Scores are inner products of floor(scale * x), exact below 2^53. A positive is one of an anchor's first rows of its own
    label with another id; its negatives are the first rows of other labels whose score lies between ``low`` and ``high``
    per cent of the positive's. Rows with a null id, label, vector or component, or a component that is not finite, take no
    part; vectors of different lengths never meet. Repeated rows count once, and so do rows of one id with equal scores.
    Anchors without positives, and windows without rows, give no rows; an empty table gives none.
    """
    label = F.col("label") if label is None else label
    rows = quantised(vectors, vec_id, label, vector, scale)
    marked = quantised(vectors.where(anchor), vec_id, label, vector, scale).dropDuplicates(["id", "label", "q"])
    nth = F.row_number().over(Window.partitionBy("id").orderBy("label", "q"))
    anchors = C.settle(marked.withColumn("nth", nth))
    trees = grow_trees(rows)
    groups = max(1, math.ceil(trees.count() / TREES_PER_GROUP))
    blocks = max(1, math.ceil(math.sqrt(anchors.count() / ANCHORS_PER_BLOCK)))
    every = F.array(F.lit(float("-inf"))), F.array(F.lit(float("inf")))
    near = search_cells(trees, anchors.withColumns({"lows": every[0], "highs": every[1]}), groups, blocks, True, positives)
    chosen = C.settle(_best(near, positives).withColumns({
        "low": F.ceil(F.col("score").cast("decimal(20,0)") * low / 100), "high": F.floor(F.col("score").cast("decimal(20,0)") * high / 100),
        "place": F.col("rank") - 1,
    }))
    edges = F.sort_array(F.collect_list(F.struct("place", "low", "high")))
    opened = chosen.groupBy(F.col("anchor").alias("id"), "nth").agg(edges.alias("w")).withColumns({
        "lows": F.transform("w", lambda x: x["low"].cast("double")), "highs": F.transform("w", lambda x: x["high"].cast("double"))
    }).drop("w")
    far = search_cells(trees, anchors.join(opened, ["id", "nth"]), groups, blocks, False, negatives)
    best = _best(far, negatives).select("anchor", "nth", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    known = chosen.select("anchor", "nth", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return known.join(best, ["anchor", "nth", "place"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    noisy = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return mine_negatives(vectors, F.col("vec_id") % 100 == 0, label=noisy)


OP11_SQL = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS y, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.id AS a, b.id AS b, a.y = b.y AS same, list_dot_product(a.q, b.q)::BIGINT AS s FROM v a JOIN v b ON a.id % 100 = 0 AND a.id <> b.id
),
pos AS (
  SELECT a, b, s FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5
)
SELECT p.a AS anchor_id, p.b AS positive_id, row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.b)::INTEGER AS rank,
  n.b AS negative_id, p.s AS positive_score, n.s AS negative_score
FROM pos p JOIN scored n ON n.a = p.a AND NOT n.same AND 30 * p.s <= 100 * n.s AND 100 * n.s <= 90 * p.s
QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.b) <= 10
"""
