"""Clustering against a scan of all centroids in Python's whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest

from lociframe.llm import centroids

VEC = "vec_id long, embedding array<float>, cluster string, distance int"


def brute(rows, k=centroids.K, rounds=centroids.ROUNDS):
    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v, *_ in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    c = [v for _, v in start]
    near = lambda v: min((sum((x - y) ** 2 for x, y in zip(v, m, strict=True)), n) for n, m in enumerate(c))
    for _ in range(rounds):
        who = [near(v)[1] for _, v in kept]
        for n in set(who):
            own = [v for (_, v), w in zip(kept, who, strict=True) if w == n]
            c[n] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    last = [near(v) for _, v in kept]
    total = sum(d for d, _ in last)
    out = [(i, n, d, sum(e for e, m in last if m == n), total, hashlib.sha256(",".join(map(str, c[n])).encode()).hexdigest()) for (i, _), (d, n) in zip(kept, last, strict=True)]
    return sorted(out, key=str)


def got(spark, rows):
    return sorted((tuple(r) for r in centroids.cluster(spark, centroids.whole_numbers(spark.createDataFrame(rows, VEC))).collect()), key=str)


def vectors(n, seed=3, grid=None):
    rng = random.Random(seed)
    draw = (lambda: rng.choice(grid)) if grid else (lambda: rng.uniform(-1, 1))
    return [(i, [draw() for _ in range(64)], "clash", 1) for i in range(n)]


@pytest.mark.parametrize("n", [3, 16, 250])
def test_against_all_centroids(spark, n):
    assert got(spark, vectors(n)) == brute(vectors(n))


def test_ties_repeats_nulls_and_hot_vectors(spark):
    rows = vectors(60, grid=[0.0, 1 / 64]) + vectors(40, seed=4, grid=[0.5])
    rows += [(None, [0.25] * 64, None, None), (7, [0.5] * 64, None, None), (8, None, None, None), (9, [0.1] * 63, None, None), (10, [0.1] * 65, None, None)]
    rows += [(11, [float("nan")] + [0.0] * 63, None, None), (12, [float("inf")] + [0.0] * 63, None, None), (13, [None] + [0.0] * 63, None, None)]
    assert got(spark, rows) == brute(rows)


def test_tree_meets_every_tie():
    rng = np.random.default_rng(5)
    for k in (1, 4, 5, 40, 200):
        points = rng.integers(-3, 3, (k, 3))
        points[k // 2 :] = points[: k - k // 2]  # equal centroids
        x = rng.integers(-4, 4, (500, 3))
        who, best = centroids.VantageTree(points).nearest(x)
        d = ((x[:, None] - points[None]) ** 2).sum(axis=2)
        assert (who == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    equal = centroids.VantageTree(np.zeros((5000, 2), dtype=np.int64))
    assert equal.nearest(np.ones((2, 2), dtype=np.int64))[0].tolist() == [0, 0]


def test_tree_prunes():
    """Far groups of centroids are not opened: most nodes keep their bound."""
    rng = np.random.default_rng(6)
    points = (rng.integers(0, 8, (64, 1)) * 100_000 + rng.integers(0, 9, (64, 64))).astype(np.int64)
    tree, met = centroids.VantageTree(points), 0

    def counted(x, c, f=tree.distances):
        nonlocal met
        met += len(x)
        return f(x, c)

    tree.distances = counted
    tree.nearest(points)
    assert met < 64 * 64 / 2


def test_no_vectors_and_too_large_ones(spark):
    assert got(spark, []) == [] and got(spark, [(1, None, None, None)]) == []
    with pytest.raises(Exception, match="overflow a long"):
        got(spark, [(1, [1e30] * 64, None, None)])
