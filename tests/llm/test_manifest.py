"""Merkle manifest against a plain loop."""

import hashlib

import pytest
from pyspark.sql import functions as F

from cartloom.llm import manifest as M

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_tree(hashes):
    """Root and, per leaf, the (left, right) siblings of each level."""
    steps, groups, level = [[] for _ in hashes], [[i] for i in range(len(hashes))], list(hashes)
    while len(level) > 1:
        up, joined = [], []
        for s in range(0, len(level), 16):
            run = level[s : s + 16]
            for k in range(len(run)):
                for leaf in groups[s + k]:
                    steps[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(sha(*run))
            joined.append([leaf for g in groups[s : s + 16] for leaf in g])
        level, groups = up, joined
    return (level[0] if level else None), steps


def plain(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[1], []).append((r[0], sha(*[enc(v) for v in r])))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for n in names:
        trees[n].sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
    subs = {n: plain_tree([h for _, h in trees[n]]) for n in names}
    root, over = plain_tree([subs[n][0] for n in names])
    return sorted(
        repr((i, h, subs[n][0], root, sha(*[a + b for a, b in subs[n][1][k] + over[j]])))
        for j, n in enumerate(names) for k, (i, h) in enumerate(trees[n])
    )


def rows():
    out = [(i, "big", "en", 3, f"text {i}") for i in range(300)]
    out += [(i, f"s{i:03d}", None, None, "ñ😀") for i in range(1000, 1030)]
    out += [(i, None, "de", 0, None) for i in range(17)] + [(2000 + i, "", "fr", 1, "") for i in range(16)]
    out += [(None, "big", "en", 2, "no id"), (7, "big", "en", 3, "text 7"), (7, "big", "en", 3, "other"), (5000, "Z", "x:y", -4, "A" * 50000)]
    return out


@pytest.mark.parametrize("part", [slice(None), slice(0, 1), slice(0, 2), slice(299, 318)])
def test_digests_equal_a_plain_loop(spark, part):
    wanted = rows()[part]
    df = spark.createDataFrame(wanted, SCHEMA).withColumns({"leaf": F.lit("kept"), "__tree": F.lit(1), "steps": F.lit(0)})
    got = M.build_manifest(df).select("doc_id", "leaf", "subroot", "root", M.proof_digest(F.col("steps")).alias("p"), M.fold(F.col("claimed"), F.col("steps")).alias("f"))
    told = got.collect()
    assert sorted(repr(tuple(r)[:5]) for r in told) == plain(wanted)
    assert all(r["f"] == r["root"] for r in told)


def test_a_changed_row_does_not_fold_to_the_root(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    forged = M.leaf_of([F.col(c) if c != "text" else F.concat("text", F.lit("!")) for c in M.LEAF_COLUMNS])
    told = M.build_manifest(df, claimed=F.when(F.col("doc_id") == 40, forged))
    for r in told.select("doc_id", "source", "root", M.fold(F.col("claimed"), F.col("steps")).alias("f")).collect():
        assert (r["f"] == r["root"]) == (r["doc_id"] != 40)


def test_empty_table(spark):
    assert M.build_manifest(spark.createDataFrame([], SCHEMA)).collect() == []
