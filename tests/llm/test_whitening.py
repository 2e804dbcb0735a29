import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm import whitening
from tests.conftest import SMALL

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def brute(rows, k=4):
    """{(vec_id, x): (n, deviation, whitened, explained)} with numpy on all rows at once."""
    xs = [(i, tuple(math.floor(256 * float(c)) for c in v)) for i, v in rows
          if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({x for _, x in xs}), dtype=object)
    n, s = len(fit), [int(t) for t in fit.sum(axis=0)]
    mean = np.array([t / n for t in s])
    a = fit.astype(float) - mean
    values, vectors = np.linalg.eigh(a.T @ a / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    share = values / np.trace(a.T @ a / n)
    return [(i, n, sum((n * c - t) ** 2 for c, t in zip(x, s, strict=True)), (np.array(x, float) - mean) @ vectors / np.sqrt(values), share) for i, x in xs]


def compare(got, want, k=4):
    assert len(got) == k * len(want)
    signs, by = {}, {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    left = {}
    for i, n, dev, w, share in want:
        mine = by[i, dev]
        at = left[i, dev] = left.get((i, dev), -1) + 1
        for c in range(k):
            r = mine[c + 1][at]
            assert r.n == n and r.explained == pytest.approx(share[c], rel=1e-9) and 0 <= r.identity_error < 1e-9
            if abs(w[c]) > 1e-6:
                assert signs.setdefault(c, np.sign(w[c] * r.whitened)) == np.sign(w[c] * r.whitened)
            assert abs(r.whitened) == pytest.approx(abs(w[c]), rel=1e-7, abs=1e-9)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumns(
        {"n": F.lit("x"), "row": F.lit(1), "x": F.lit(None).cast("int"), "component": F.lit(0.5)})


def test_equal_to_numpy(spark):
    rng = random.Random(2)
    rows = [(i, [float(np.float32(rng.gauss(0, 0.1 + d / 9))) for d in range(7)]) for i in range(400)]
    rows += [(1000 + i, rows[5][1]) for i in range(200)] + [(7, rows[9][1])] * 2 + [(None, rows[1][1])]
    rows += [(-1, None), (-2, [None] * 7), (-3, [float("nan")] + [0.0] * 6), (-4, [float("inf")] * 7), (-5, [-0.0] * 7)]
    out = whitening.whiten(frame(spark, rows).repartition(5, "vec_id"), rows_per_block=64)
    assert out.columns == COLUMNS
    got = out.collect()
    assert {r.vec_id for r in got} == {i for i, v in rows if i is None or i >= 0 or i == -5}
    compare(got, brute(rows))
    compare(whitening.whiten(frame(spark, rows)).collect(), brute(rows))


def test_whole_table_equal_to_numpy(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    compare(whitening.whiten(table).collect(), brute([(r.vec_id, r.embedding) for r in table.collect()]))


def test_gram_splits_the_rows(spark):
    rows = spark.range(1000).select(F.col("id").alias("row"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v"))
    matrix = whitening.block_matrix(rows, F.col("v"), 1000, 2, 16)
    assert matrix.numRowBlocks == 63
    assert whitening.gram(matrix).tolist() == [[332833500.0, 499500.0], [499500.0, 1000.0]]


def test_without_variance_and_few_dimensions(spark):
    same = whitening.whiten(frame(spark, [(i, [0.5, 0.25]) for i in range(9)])).collect()
    assert len(same) == 18 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {(1, 0, None, None, None)}
    line = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(5)])).collect()
    assert len(line) == 15 and all((r.whitened is None) == (r.component > 1) for r in line)
    assert all(r.identity_error < 1e-9 for r in line)
    assert all(r.explained == pytest.approx(1.0) for r in line if r.component == 1)


def test_wide_numbers_lengths_and_empty_tables(spark):
    far = [(i, [1e9 * i, -3e11 + i, 0.0]) for i in range(3)]
    want = {i: dev for i, _, dev, _, _ in brute(far, 1)}
    got = whitening.whiten(frame(spark, far, "double"), components=1).collect()
    assert {r.vec_id: r.deviation for r in got} == {i: d if d < 1 << 63 else None for i, d in want.items()}
    beyond = whitening.whiten(frame(spark, [(1, [1e300, 1.0]), (2, [-1e300, 0.0]), (3, [1.0, 1.0])], "double")).collect()
    assert len(beyond) == 6
    mixed = whitening.whiten(frame(spark, [(1, [1.0]), (2, [1.0, 2.0]), (3, [0.5, 2.5]), (4, []), (5, [])])).collect()
    assert {r.vec_id for r in mixed} == {2, 3}
    for rows in ([], [(1, None)], [(1, [])]):
        none = whitening.whiten(frame(spark, rows))
        assert none.count() == 0 and none.columns == COLUMNS
