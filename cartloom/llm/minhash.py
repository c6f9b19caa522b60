"""MinHash near-dedup: universal hash minima, banding, signature verification, exact confirmation, connected components.

Texts become sets of five-word shingles. Texts with equal sets are one *set* from then on, so thousands of copies cost one
row. Each set gets 128 minima of multiply-add hashes; 32 bands of four minima put sets with similarity 0.75 into a common
bucket but for five chances in a million. Inside a bucket all pairs are never listed:

* Every set is first compared with two sets only: the set of its buckets that shares most buckets overall (in a family of
  near copies, the original), and a random one. Estimated similarity from the signatures drops clear misses, then full
  sets decide. Connected components of these links come from alternating large-star and small-star rounds.
* Only buckets that still hold several components are looked at again, in square blocks of bounded size. Each member
  brings its signature and its full set into the block. There, pairs of different components are compared in the first
  bucket they share and nowhere else: signature first, full sets at once. A link joins its two components inside the block,
  so a block hands on fewer links than it has members, and no unconfirmed pair ever leaves a task.

So no link between different texts of a bucket is lost, whatever the bucket's size, and the rows of every step grow with the
number of sets, not of pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartloom.llm import common as C

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 32, 4
SLACK = 5.0  # standard deviations below the threshold at which a signature is still confirmed
# Most sets, and most bytes of sets, in one side of a block.
BLOCK = 1024
BLOCK_BYTES = 1 << 23
FACTORS = (C.seeded(BANDS * ROWS, 101) >> C.U64(32)).astype(np.uint32) | np.uint32(1)
SHIFTS = (C.seeded(BANDS * ROWS, 202) >> C.U64(32)).astype(np.uint32)


def shingle_sets(column: pa.Array, size: int):
    """Per text, the sorted distinct shingle codes; a shorter text is one shingle, a text without words has none."""
    data, offsets = C.buffers(column)
    for _, _, part, offs in C.chunks(data, offsets):
        codes, _, _, at = C.word_codes(part, offs, C.SPACED, C.LOWER)
        grams = C.ngram_codes(codes, size)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a >= size:
                yield np.unique(grams[a : b - size + 1])
            elif b > a:
                yield C.mix(C.ngram_codes(codes[a:b], b - a) + C.U64(b - a))
            else:
                yield np.zeros(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    low = (shingles >> C.U64(32)).astype(np.uint32)
    best = np.full(len(FACTORS), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 512):
        hashed = FACTORS[:, None] * low[None, i : i + 512] + SHIFTS[:, None]
        np.minimum(best, hashed.min(axis=1), out=best)
    return best


def _set_id(shingles: np.ndarray) -> int:
    """Digest of a whole set."""
    total = C.mix(shingles + C.U64(77)).sum(dtype=np.uint64) + C.U64(len(shingles))
    return int(C.mix(np.array([total]))[0].view(np.int64))


SIGNED = "doc_id long, n_shingles long, node long, sig binary, bands array<long>"


def sign(documents: DataFrame, text: str, ident: str, size: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            n, node, sigs, bands = [], [], [], []
            for s in shingle_sets(batch.column(1), size):
                n.append(len(s))
                if not len(s):
                    node.append(None), sigs.append(None), bands.append(None)
                    continue
                sig = signature(s)
                node.append(_set_id(s))
                sigs.append((sig >> np.uint32(16)).astype(np.uint16).tobytes())
                rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
                key = C.mix(np.arange(BANDS, dtype=np.uint64) + C.U64(1))
                for j in range(ROWS):
                    key = C.mix(key * C.U64(C.BASE) + rows[:, j])
                bands.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(sigs, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "node", "sig", "bands"],
            )

    return documents.select(ident, text).mapInArrow(run, SIGNED)


def _agreement(percent: int) -> int:
    """Least number of agreeing minima for a pair to be confirmed on its full sets."""
    n, p = BANDS * ROWS, percent / 100
    return int(n * p - SLACK * (n * p * (1 - p)) ** 0.5)


def likely(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose signatures agree often enough."""
    least = _agreement(percent)
    left = signatures.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"))
    right = signatures.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"))

    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for i in (2, 3))
            yield batch.select([0, 1]).filter(pa.array((x == y).sum(axis=1) >= least))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity."""
    left = sets.select(F.col("node").alias("a"), F.col("codes").alias("codes_a"))
    right = sets.select(F.col("node").alias("b"), F.col("codes").alias("codes_b"))

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "codes_a", "codes_b").mapInArrow(run, "a long, b long")


def full_sets(documents: DataFrame, members: DataFrame, text: str, ident: str, size: int) -> DataFrame:
    """(node, codes) of the sets in ``members`` (doc_id, node), read again from whole texts."""

    def run(batches):
        for batch in batches:
            node, codes = [], []
            for want, s in zip(batch.column(1).to_pylist(), shingle_sets(batch.column(2), size)):
                if len(s) and _set_id(s) == want:
                    node.append(want), codes.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(codes, pa.binary())], names=["node", "codes"])

    docs = documents.select(F.col(ident).alias("doc_id"), F.col(text).alias("text"))
    found = docs.join(members, docs["doc_id"].eqNullSafe(members["member"])).select("doc_id", "node", "text")
    return found.mapInArrow(run, "node long, codes binary").dropDuplicates(["node"])


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes in links (a, b), by alternating large-star and small-star until nothing changes.

    Large-star: every node sends its larger neighbours to its least one. Small-star: every node sends its smaller
    neighbours and itself to the least of them. Both need only a minimum per node, aggregated before the shuffle, so a node
    with very many neighbours costs one row per task. Each round is written to the checkpoint folder.
    """
    spark = links.sparkSession

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.union(edges.select(F.col("b"), F.col("a"))) if large else edges
        least = both.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("least"))
        joined = both.join(least, both["a"] == least["k"])
        if large:
            # (u, v) with v > u goes to (v, min of u's neighbours and u).
            return joined.where("b > a").select(F.col("b").alias("a"), F.least("a", "least").alias("b")).where("a <> b").distinct()
        sent = joined.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        return sent.union(least.select(F.col("k").alias("a"), F.col("least").alias("b"))).where("a <> b").distinct()

    def state(edges: DataFrame):
        return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    # Edges run from the larger to the smaller node.
    edges = C.settle(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before = state(edges)
    while before[0]:
        edges = C.settle(star(star(edges, True), False))
        after = state(edges)
        if after == before:
            break
        before = after
    C.release(spark)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    ).distinct()


class _Overlaps:
    """Sizes of the intersections of one set with all sets of a block, from postings made on first use."""

    def __init__(self, sets: list[np.ndarray]):
        self.cuts = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
        _, self.code = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), np.diff(self.cuts))
        turn = np.argsort(self.code, kind="stable")
        self.members = owner[turn]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(self.code))])

    def of(self, i: int) -> np.ndarray:
        codes = self.code[self.cuts[i] : self.cuts[i + 1]]
        first, count = self.starts[codes], self.starts[codes + 1] - self.starts[codes]
        places = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(int(count.sum()))
        return np.bincount(self.members[places], minlength=len(self.cuts) - 1)


def block_links(pdf: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Confirmed links between different components of one block, as few as join them."""
    if pdf["component"].nunique() < 2:
        return []
    least, n = _agreement(percent), len(pdf)
    sig = np.frombuffer(b"".join(pdf["sig"]), np.uint16).reshape(n, -1)
    bands = np.array(pdf["bands"].tolist(), dtype=np.int64)
    here = int(np.flatnonzero(bands[0] == pdf["band"].iat[0])[0])
    sets = [np.frombuffer(x, np.uint64) for x in pdf["codes"]]
    size = np.array([len(x) for x in sets])
    node, side = pdf["node"].to_numpy(), pdf["own"].to_numpy()
    _, part = np.unique(pdf["component"].to_numpy(), return_inverse=True)
    square, overlaps, links = pdf["row"].iat[0] != pdf["col"].iat[0], None, []
    for i in range(n - 1):
        other = np.arange(i + 1, n)
        fits = (part[i + 1 :] != part[i]) & (100 * np.minimum(size[i + 1 :], size[i]) >= percent * np.maximum(size[i + 1 :], size[i]))
        if square:
            fits &= side[i + 1 :] != side[i]
        other = other[fits]
        other = other[(sig[other] == sig[i]).sum(axis=1) >= least]
        other = other[(bands[other] == bands[i]).argmax(axis=1) == here]
        if not len(other):
            continue
        overlaps = overlaps or _Overlaps(sets)
        common = overlaps.of(i)[other]
        for j in other[100 * common >= percent * (size[i] + size[other] - common)]:
            if part[j] != part[i]:
                links.append((int(node[i]), int(node[j])))
                part[part == part[j]] = part[i]
    return links


def _block_links(groups: DataFrame, percent: int) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(block_links(pdf, percent), columns=["a", "b"], dtype=np.int64)

    return groups.groupBy("band", "row", "col").applyInPandas(run, "a long, b long")


def near_duplicates(
    documents: DataFrame, text: str = "text", ident: str = "doc_id", size: int = SHINGLE, percent: int = PERCENT,
    block: int = BLOCK,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of documents.

    Documents without words, null texts included, are linked with nothing. A null id takes part like any other and is kept
    only where its whole component has no id. Rows that share an id share its links only through equal texts.
    """
    spark = documents.sparkSession
    C.small_batches(spark)
    signed = C.settle(sign(documents, text, ident, size))
    sets = signed.where("node is not null")
    # One signature row per set: any copy of the set has the same.
    distinct = C.settle(
        sets.groupBy("node").agg(F.min("doc_id").alias("member"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    )
    members = distinct.select(F.explode("bands").alias("band"), "node", "n")
    busy = members.groupBy("band").agg(F.count("*").alias("size"), F.sum("n").alias("shingles")).where("size > 1")
    members = C.settle(members.join(busy, "band").drop("n"))
    C.release(spark)
    signatures = distinct.select("node", "sig")
    score = members.groupBy("node").agg(F.sum("size").alias("score"))
    # Two candidates a set: the best-connected set of its buckets, and the set of them with the least digest.
    centres = members.join(score, "node").groupBy("band").agg(F.max(F.struct("score", "node")).alias("best"), F.min("node").alias("least"))
    offered = members.select("band", "node").join(centres, "band")
    chosen = offered.groupBy("node").agg(
        F.max(F.when(F.col("best.node") != F.col("node"), F.col("best"))).getField("node").alias("hub"),
        F.min(F.when(F.col("least") != F.col("node"), F.col("least"))).alias("spare"),
    )
    star = chosen.select("node", F.explode(F.array_distinct(F.array("hub", "spare"))).alias("centre")).where("centre is not null").select(
        F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")
    ).distinct()
    tried = likely(star, signatures, percent)
    busy_nodes = members.select("node").distinct()
    whole = C.settle(full_sets(documents, distinct.select("node", "member").join(busy_nodes, "node"), text, ident, size))
    links = C.settle(confirm(tried, whole, percent))
    C.release(spark)
    first = C.settle(components(links))
    # Buckets that still hold several components.
    placed = members.join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_ = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("band")
    blocks = F.greatest(F.ceil(F.col("size") / block), F.ceil(F.col("shingles") * 8 / BLOCK_BYTES)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = placed.join(open_, "band").withColumn("blocks", blocks).withColumn("own", own)
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    groups = placed.select("band", "node", "component", "own", F.least("own", "other").alias("row"), F.greatest("own", "other").alias("col"))
    brought = distinct.select("node", "sig", "bands").join(whole, "node")
    links = links.union(C.settle(_block_links(groups.join(brought, "node"), percent)))
    final = components(links)
    named = sets.select("doc_id", "node").join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    ids = distinct.select("node").join(final, "node", "left").select("node", F.coalesce("component", "node").alias("component")).join(lowest, "component")
    result = signed.select("doc_id", "n_shingles", "node").join(ids.select("node", "component_id"), "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def op3_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
