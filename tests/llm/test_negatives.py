"""Cover tree invariants, and hard negatives against all inner products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartloom.llm import covertree as T
from cartloom.llm import negatives as N

SCHEMA = "vec_id long, embedding array<float>, label int"


def clustered(n, dim, seed, spread=3.0):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-200, 200, (6, dim))
    return np.floor(centres[rng.integers(0, 6, n)] + rng.normal(0, spread, (n, dim)))


@pytest.mark.parametrize("n,dim", [(1, 3), (2, 1), (300, 4), (500, 64), (64, 0)])
def test_tree_covers_every_row_once(n, dim):
    v = clustered(n, dim, n)
    if n > 100:
        v[50:120] = v[50]
    tree = T.CoverTree.build(v, np.arange(n), np.zeros(n, int))
    assert sorted(tree.order.tolist()) == list(range(n))
    norms = (v * v).sum(1)
    extra = np.sqrt(norms.max() - norms)
    augmented = np.column_stack([v, extra])

    def rows_below(node):
        first, count = tree.first[node], tree.count[node]
        if tree.leaf[node]:
            return tree.order[first : first + count].tolist()
        return [r for child in range(first, first + count) for r in rows_below(child)]

    for node in range(len(tree.centre)):
        below = rows_below(node)
        assert below
        away = np.linalg.norm(augmented[below] - augmented[tree.centre[node]], axis=1)
        assert away.max() <= tree.radius[node] + 1e-6
    assert sorted(rows_below(0)) == list(range(n))


def test_bounds_skip_most_of_clustered_vectors():
    v = clustered(2000, 16, 5)
    ids, labels = np.arange(2000), np.arange(2000) % 3
    tree = T.CoverTree.build(v, ids, labels)
    again = T.CoverTree.unpack(tree.pack(), 16)
    looked = []
    for a in range(0, 2000, 100):
        scores = v @ v[a]
        for low, high in ((-math.inf, math.inf), (0.3 * scores.max(), 0.9 * scores.max())):
            w = T.Window(low, high, 10)
            looked.append(again.descend(v[a], labels != labels[a], [w]))
            fits = [(-s, i) for i, s in zip(ids, scores) if low <= s <= high and labels[i] != labels[a]]
            assert [(-s, i) for s, i in zip(w.scores, w.ids)] == sorted(fits)[:10]
    assert np.mean(looked) < 1500


def plain(rows):
    v = []
    for i, e, y in rows:
        if i is None or e is None or y is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        v.append((i, (y + 1) % 10 if i % 7 == 0 else y, tuple(math.floor(256 * float(np.float32(x))) for x in e)))
    out = set()
    for a, ya, qa in set(v):
        if a % 100:
            continue
        def near(same):
            told = {(-sum(p * q for p, q in zip(qa, qb)), b) for b, yb, qb in v if len(qb) == len(qa) and (yb == ya) == same and (b != a or not same)}
            return sorted(told)
        for ps, p in near(True)[:5]:
            fit = [(s, b) for s, b in near(False) if 30 * -ps <= 100 * -s <= 90 * -ps]
            for r, (s, b) in enumerate(fit[:10]):
                out.add((a, p, r + 1, b, -ps, -s))
    return sorted(out)


def rows():
    rng = random.Random(4)
    point = lambda: [rng.choice([-0.5, -0.25, 0.125, 0.25, 0.5, 0.75]) for _ in range(4)]
    out = [(i, point(), i % 4) for i in range(420)]
    out += [(1000 + i, [0.5, 0.5, 0.5, 0.5], i % 2) for i in range(150)]
    out += [(2000, None, 1), (2001, [0.5, None, 0.1, 0.2], 1), (2002, [float("nan")] * 4, 1), (2003, [float("inf"), 0.0, 0.0, 0.0], 1), (2100, point(), None)]
    out += [(None, point(), 1), (3000, [0.5, 0.25], 1), (3001, [0.5, 0.5], 1), (3002, [0.25, 0.25], 2), (3100, [], 1), (3101, [], 1), (3103, [], 2)]
    out += [out[100], out[101], out[101], (200, point(), 3), (4000, [3e38] * 4, 1), (4001, [3e38] * 4, 2), (5000, [0.0] * 4, 1)]
    return out


def hard(df):
    noisy = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return N.mine_negatives(df, F.col("vec_id") % 100 == 0, label=noisy)


@pytest.mark.parametrize("tree_rows", [40, 2048])
def test_equal_to_all_pairs(spark, monkeypatch, tree_rows):
    monkeypatch.setattr(N, "TREE_ROWS", tree_rows)
    monkeypatch.setattr(N, "ANCHORS_PER_BLOCK", 1)
    wanted = [r for r in rows() if r[0] not in (4000, 4001)]
    df = spark.createDataFrame(wanted, SCHEMA).withColumns({"id": F.lit("kept"), "q": F.lit(1), "score": F.lit(None)})
    got = [tuple(r) for r in hard(df.repartition(3)).collect()]
    assert sorted(got) == plain(wanted) and len(got) > 100


def test_huge_components_and_empty_tables_do_not_stop_it(spark):
    assert hard(spark.createDataFrame(rows(), SCHEMA)).count() > 100
    for few in ([], [(100, [0.5], 1)], [(100, [0.5], 1), (101, [0.5], 1)], [(101, [0.5], 1)], [(100, None, 1)]):
        assert hard(spark.createDataFrame(few, SCHEMA)).collect() == []
