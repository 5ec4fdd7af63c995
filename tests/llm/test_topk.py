"""Top-k against all inner products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from waybill.llm import topk


def brute_force(rows, k=5, every=50):
    good = [
        (i, [math.floor(256 * x) for x in v]) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, q in good:
        if i % every == 0:
            scored = sorted(
                (-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i and len(v) == len(q)
            )
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [40, 100_000])
def test_against_all_pairs(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 3)
    rng = random.Random(2)
    rows = [(i, [float(np.float32(rng.gauss(0, 1))) for _ in range(6)]) for i in range(300)]
    same = rows[7][1]
    rows += [(i, same) for i in range(300, 420)]  # a crowd of equal vectors, so ties
    rows += [(500, [1.0, 2.0]), (501, [3.0, 4.0]), (550, None), (551, []), (600, [float("nan")] * 6),
             (None, same), (650, [None] + same[1:]), (700, [float("inf")] * 6)]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, shard int")
    got = sorted(tuple(r) for r in topk.nearest(table, F.col("vec_id") % 50 == 0).collect())
    assert got == brute_force(rows)


def test_fewer_than_k_and_none(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.nearest(table, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.nearest(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_a_walk_skips_what_cannot_count():
    rng = np.random.default_rng(0)
    centres = rng.integers(-200, 200, (50, 4))
    vectors = np.repeat(centres, 40, axis=0) + rng.integers(-3, 4, (2000, 4))
    tree = topk.build(np.arange(2000), vectors, leaf=16)
    assert (tree["left"] >= 0).sum() + 1 == (tree["left"] < 0).sum()
    q = vectors[:1]
    (ids, scores), = topk.search(tree, np.array([0]), q, 5, np.array([topk.LOWEST]))
    want = sorted((-int(v @ q[0]), i) for i, v in enumerate(vectors) if i)[:5]
    assert list(zip(scores.tolist(), ids.tolist())) == [(-s, i) for s, i in want]
    none = topk.search(tree, np.array([0]), q, 5, np.array([10**9]))
    assert len(none[0][0]) == 0


def test_repeated_rows_in_a_crowd_of_equal_vectors():
    ids = np.repeat(np.arange(300), 2)
    tree = topk.build(ids, np.full((600, 2), 3))
    for own in (0, 1, 2, 3, 299):
        (found, scores), = topk.search(tree, np.array([own]), np.array([[3, 3]]), 5, np.array([topk.LOWEST]))
        assert found.tolist() == [i for i in ids.tolist() if i != own][:5]
        assert scores.tolist() == [18] * 5
    tree = topk.build(np.repeat(np.arange(4), 2), np.full((8, 2), 3))
    (found, _), = topk.search(tree, np.array([0]), np.array([[3, 3]]), 5, np.array([topk.LOWEST]))
    assert found.tolist() == [1, 1, 2, 2, 3]
    (found, _), = topk.search(topk.build(np.zeros(9, np.int64), np.full((9, 2), 3)), np.array([0]), np.array([[3, 3]]), 5, np.array([0]))
    assert not len(found)
