import math
import random

import numpy as np
import pytest

from stratum.llm import mtree


def brute(rows, k=20, every=20):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            good[i] = [math.floor(64 * float(np.float64(x))) for x in v]
    out = []
    for q, a in good.items():
        if q % every == 0:
            hits = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good.items() if i != q and len(a) == len(b))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(hits[:k])]
    return sorted(out)


def got(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return sorted(tuple(r) for r in mtree.top_k(df, **kw).collect())


@pytest.mark.parametrize("seed", range(3))
def test_tree_search_is_exact_and_skips(seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 30, (12, 16))
    rows = np.rint(centres[rng.integers(0, 12, 1500)] + rng.normal(0, 4, (1500, 16))).astype(np.int64)
    tree = mtree.MTree(rows, int((rows * rows).sum(axis=1).max()), leaf=16, fanout=6)
    weight = np.ones(len(rows), np.int64)
    computed = []
    for q in rows[::50]:
        tree.computed = 0
        found, scores = tree.search(q, 10, -(1 << 62), weight)
        true = rows @ q
        tenth = np.sort(true)[-10]
        assert sorted(found.tolist()) == sorted(np.flatnonzero(true >= tenth).tolist())
        assert (scores == true[found]).all()
        computed.append(tree.computed)
    assert np.mean(computed) < 0.8 * len(rows)


def test_radii_and_parent_distances_hold():
    rng = np.random.default_rng(4)
    rows = rng.integers(-20, 20, (700, 8))
    tree = mtree.MTree(rows, int((rows * rows).sum(axis=1).max()), leaf=10, fanout=4)

    def below(page):
        return page.rows if page.rows is not None else np.concatenate([below(c) for c in page.children])

    def check(page):
        assert (tree.between(page.centre, below(page)) <= page.radius + 1e-9).all()
        if page.children:
            assert np.allclose(tree.between(page.centre, page.centres), page.distance)
            for c in page.children:
                check(c)

    check(tree.root)
    assert sorted(below(tree.root).tolist()) == list(range(700))


def test_query_equals_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) + (i % 5) for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, rows[20][1]) for i in range(120)]  # a third of what a query sees ties
    rows += [(1000, rows[20][1]), (3000, [0.0] * 6), (40, rows[40][1])]
    rows += [(None, [1.0] * 6), (2000, None), (2020, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2040, [float("nan")] * 6),
             (2060, [float("inf")] + [0.0] * 5), (2080, []), (2100, [1e6] * 6), (2120, [3.0, 4.0])]
    assert got(spark, rows, subtree=64) == brute(rows)
    assert got(spark, rows, k=3, subtree=30) == brute(rows, 3)


def test_few_rows_and_empty(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (20, [-0.001, 0.5])]
    assert got(spark, rows) == brute(rows)
    assert got(spark, [(20, [1.0])]) == []
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, rank int, score string")
    assert mtree.top_k(empty).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(i * 20, [1e7 + i, -1e7 + 3 * i]) for i in range(30)]
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("large", [1e15, 1e200])
def test_finite_vectors_are_not_left_out(spark, large):
    """A score that may not fit a long is an error, not a missing row."""
    with pytest.raises(ValueError, match="fit a long"):
        got(spark, [(0, [1.0, 2.0]), (1, [large, 0.0])])


def test_far_subtrees_get_no_queries_and_tasks_hold_one_block(spark, monkeypatch):
    """Clustered rows: most (query, subtree) pairs are dropped before the exchange; a group is one subtree's rows or one block."""
    rng = random.Random(6)
    centres = [[rng.gauss(0, 4) for _ in range(8)] for _ in range(30)]
    rows = [(i, [c + rng.gauss(0, 0.05) for c in centres[i % 30]]) for i in range(6000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    seen = []
    real = type(df).sortWithinPartitions

    def watch(self, *cols):
        if "part" in cols:
            seen.append(self.groupBy("leaf", "salt", "kind").count().collect())
        return real(self, *cols)

    monkeypatch.setattr(type(df), "sortWithinPartitions", watch)
    monkeypatch.setattr(mtree, "BLOCK", 16)
    out = sorted(tuple(r) for r in mtree.top_k(df, k=5, subtree=100).collect())
    assert out == brute(rows, 5)
    subtrees = [r for r in seen[0] if r["kind"] == 0]
    asked = sum(r["count"] for r in seen[0] if r["kind"] == 1)
    assert max(r["count"] for r in subtrees) <= 260 and len(subtrees) > 40
    blocks = 300 / 16
    assert asked < 0.5 * blocks * len(subtrees)
