"""Merkle manifest of a dataset: one tree of digests per source, one tree over the sources, and a proof for every row.

Rows are numbered inside their tree by a distributed rank. At each level, runs of 16 consecutive nodes are windows: lag and
lead columns at the fixed offsets 1 to 15, masked by the node's slot in its run and by the run's length, hold a node's
siblings, and the first row of a run hashes the whole run into its parent. A window never holds more than one run, so a
source with a third of all rows is spread like any other. Going down again, each node hands the siblings of its ancestors to
the 16 nodes below it; rows meet only the node above them.

Nothing but the largest number of leaves of a tree, which fixes the number of levels, reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartloom.llm import common as C
from cartloom.operators.skew import lookup_hot, number_rows

FANOUT = 16
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_STEPS = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts in a row; a null part counts as empty."""
    return F.sha2(F.concat_ws("", *parts), 256)


def encode(value: Column) -> Column:
    """UTF-8 byte count, colon, value; null is a hyphen."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: list[Column]) -> Column:
    return digest(*[encode(v) for v in values])


def fold(leaf: Column, steps: Column) -> Column:
    """Root that a leaf and the siblings of each level lead to."""
    return F.aggregate(steps, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_digest(steps: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """Nodes (__tree, __at, __hash) with their run, slot, the run's length and the siblings before and after them."""
    run = Window.partitionBy("__tree", "__run")
    inside = run.orderBy("__at")
    slotted = nodes.withColumn("__run", F.floor(F.col("__at") / FANOUT)).withColumn("__slot", F.pmod("__at", F.lit(FANOUT)))
    slotted = slotted.withColumn("__length", F.count(F.lit(1)).over(run))
    before = [F.when(F.col("__slot") >= k, F.lag("__hash", k).over(inside)) for k in range(FANOUT - 1, 0, -1)]
    after = [F.when(F.col("__slot") + k < F.col("__length"), F.lead("__hash", k).over(inside)) for k in range(1, FANOUT)]
    return slotted.withColumns({"__left": F.concat_ws("", *before), "__right": F.concat_ws("", *after)})


def _step() -> Column:
    return F.struct(F.col("__left").alias("left"), F.col("__right").alias("right"))


def _parents(level: DataFrame, *more: Column) -> DataFrame:
    """One node per run, made by the run's first row."""
    return level.where("__slot = 0").select("__tree", F.col("__run").alias("__at"), digest(F.col("__hash"), F.col("__right")).alias("__hash"), *more)


def climb(nodes: DataFrame) -> DataFrame:
    """Per run of the lowest level: __tree, __run, __alone (its tree has one leaf), __steps above the run, __top (the root).

    ``nodes`` has __tree (not null), __at from 0 without gaps, __hash. A tree of one leaf is its own root.
    """
    first = _parents(
        _with_siblings(nodes.select("__tree", "__at", "__hash")), F.col("__length").alias("__leaves"), F.col("__hash").alias("__child")
    )
    sizes = first.groupBy("__tree").agg(F.sum("__leaves").alias("__n"))
    bottom = C.settle(lookup_hot(first.drop("__leaves"), sizes, ["__tree"], "inner"))
    most = bottom.agg(F.max("__n")).first()[0] or 0
    levels, here, span = [], bottom.drop("__child"), FANOUT
    tops = bottom.where(F.col("__n") <= span).select("__tree", "__at", F.when(F.col("__n") == 1, F.col("__child")).otherwise(F.col("__hash")).alias("__top"))
    while span < most:
        levels.append(C.settle(_with_siblings(here.where(F.col("__n") > span))))
        here = _parents(levels[-1], F.col("__n"))
        span *= FANOUT
        tops = tops.unionByName(here.where(F.col("__n") <= span).select("__tree", "__at", F.col("__hash").alias("__top")))
    # Down again. A tree ends at the level where one node remains; from there its steps grow towards the leaves.
    none = F.array().cast(NO_STEPS)
    above = tops.withColumn("__steps", none) if not levels else None
    for depth in range(len(levels) - 1, -1, -1):
        span = FANOUT ** (depth + 2)
        upper = tops_of(tops, bottom, span) if above is None else above.unionByName(tops_of(tops, bottom, span))
        upper = upper.select("__tree", F.col("__at").alias("__run"), "__top", "__steps")
        above = levels[depth].join(upper, ["__tree", "__run"]).select(
            "__tree", "__at", "__top", F.concat(F.array(_step()), F.col("__steps")).alias("__steps")
        )
    if levels:
        above = above.unionByName(tops_of(tops, bottom, FANOUT))
    alone = bottom.select("__tree", "__at", (F.col("__n") == 1).alias("__alone"))
    return alone.join(above, ["__tree", "__at"]).withColumnRenamed("__at", "__run")


def tops_of(tops: DataFrame, bottom: DataFrame, span: int) -> DataFrame:
    """Roots of the trees that end at the level where ``span`` leaves fit under one node."""
    low = F.lit(0) if span == FANOUT else F.lit(span // FANOUT)
    ending = bottom.where((F.col("__at") == 0) & (F.col("__n") <= span) & (F.col("__n") > low)).select("__tree")
    return tops.join(ending, "__tree", "left_semi").withColumn("__steps", F.array().cast(NO_STEPS))


def build_manifest(
    rows: DataFrame, tree: str = "source", order: str = "doc_id", columns: tuple[str, ...] = LEAF_COLUMNS, claimed: Column | None = None
) -> DataFrame:
    """Per row: its ``order`` and ``tree`` columns, leaf, claimed, steps (siblings by level), subroot and root.

    ``claimed`` is the leaf that someone presents for the row, by default the row's own. Trees ascend by name, null first;
    rows ascend by ``order``, null first, equal ones by their leaf. Repeated rows are leaves of their own. An empty table
    gives no rows. Other columns of the table play no part.
    """
    name = F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit(""))
    leaf = leaf_of([F.col(c) for c in columns])
    leaves = C.settle(rows.select(
        F.col(order).alias("__id"), name.alias("__tree"), leaf.alias("__hash"), (F.lit(None).cast("string") if claimed is None else claimed).alias("__claim")
    ))
    numbered = number_rows(leaves, ["__tree"], ["__id", "__hash"], "__n")
    nodes = C.settle(numbered.withColumn("__at", F.col("__n") - 1).drop("__n"))
    runs = C.settle(climb(nodes))
    subroots = runs.where("__run = 0").select(F.col("__tree").alias("__name"), F.col("__top").alias("__hash"))
    ranked = number_rows(subroots, [], ["__name"], "__n")
    tops = C.settle(ranked.select(F.lit("").alias("__tree"), (F.col("__n") - 1).alias("__at"), "__hash", "__name"))
    over = climb(tops).select("__run", F.col("__alone").alias("__one"), F.col("__steps").alias("__rest"), F.col("__top").alias("__root"))
    last = F.when(F.col("__one"), F.col("__rest")).otherwise(F.concat(F.array(_step()), F.col("__rest")))
    roots = _with_siblings(tops).join(over, "__run").select(F.col("__name").alias("__tree"), last.alias("__last"), "__root")
    known = lookup_hot(runs, roots, ["__tree"], "inner")
    own = F.when(F.col("__alone"), F.array().cast(NO_STEPS)).otherwise(F.array(_step()))
    return _with_siblings(nodes).join(known, ["__tree", "__run"]).select(
        F.col("__id").alias(order), F.when(F.col("__tree") != "", F.substring("__tree", 2, 1 << 30)).alias(tree),
        F.col("__hash").alias("leaf"), F.coalesce("__claim", "__hash").alias("claimed"),
        F.concat(own, "__steps", "__last").alias("steps"), F.col("__top").alias("subroot"), F.col("__root").alias("root"),
    )


def op13_merkle(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*LEAF_COLUMNS)
    changed = [F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in LEAF_COLUMNS]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    told = build_manifest(docs, claimed=F.when(tampered, leaf_of(changed)))
    folded = told.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("steps")).alias("proof_sha256"), fold(F.col("claimed"), F.col("steps")).alias("folded_root")
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


OP13_SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256))::BIGINT AS i)
),
docs AS (
  SELECT *, row_number() OVER () AS rid, coalesce('=' || source, '') AS tree, xor(list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS crc
  FROM documents, crc_table
),
shown AS (
  SELECT *, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS lowered
  FROM (SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head FROM docs)
),
placed AS (
  SELECT rid, doc_id, tree, leaf, CASE WHEN crc % 5 = 0 THEN lowered ELSE leaf END AS claim,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM shown
),
nodes AS (
  SELECT 0 AS lvl, tree, pos, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM placed
  UNION ALL
  SELECT lvl + 1, tree, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 15) // 16)
  FROM nodes WHERE n > 1 GROUP BY lvl, tree, pos // 16
),
subroots AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, pos, h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 15) // 16) FROM tops WHERE n > 1 GROUP BY lvl, pos // 16
),
every AS (
  SELECT lvl, tree, pos, h FROM nodes WHERE n > 1
  UNION ALL
  SELECT 1000 + lvl, '', pos, h FROM tops WHERE n > 1
),
siblings AS (
  SELECT a.lvl, a.tree, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
  FROM every a JOIN every b ON a.lvl = b.lvl AND a.tree = b.tree AND a.pos // 16 = b.pos // 16 GROUP BY a.lvl, a.tree, a.pos
),
walk AS (
  SELECT rid, tree AS name, 0 AS lvl, tree, pos, claim AS f, '' AS proof FROM placed
  UNION ALL
  SELECT w.rid, w.name, CASE WHEN s.pos IS NULL THEN 1000 ELSE w.lvl + 1 END, CASE WHEN s.pos IS NULL THEN '' ELSE w.tree END,
    CASE WHEN s.pos IS NULL THEN u.pos ELSE w.pos // 16 END,
    CASE WHEN s.pos IS NULL THEN w.f ELSE sha256(s.l || w.f || s.r) END, CASE WHEN s.pos IS NULL THEN w.proof ELSE w.proof || s.l || s.r END
  FROM walk w LEFT JOIN siblings s ON s.lvl = w.lvl AND s.tree = w.tree AND s.pos = w.pos JOIN subroots u ON u.tree = w.name
  WHERE s.pos IS NOT NULL OR w.lvl < 1000
),
ends AS (SELECT rid, arg_max(f, lvl) AS folded_root, arg_max(proof, lvl) AS proof FROM walk WHERE lvl >= 1000 GROUP BY rid)
SELECT p.doc_id, p.leaf, u.h AS subroot, t.h AS root, sha256(e.proof) AS proof_sha256, e.folded_root, e.folded_root = t.h AS verified
FROM placed p JOIN ends e ON e.rid = p.rid JOIN subroots u ON u.tree = p.tree JOIN (SELECT h FROM tops WHERE n = 1) t ON true
"""
