from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadgrain.llm import hard_negatives
from loadgrain.llm.hard_negatives import Mining

COLUMNS = "vec_id bigint, embedding array<float>, label int, row int, block int, group int"


def brute(rows, asks, positives=5, negatives=10, low=30, high=90, scale=256):
    """Every anchor against every row, in Python's whole numbers."""
    usable = [
        (i, label, [math.floor(scale * float(np.float32(x))) for x in v])
        for i, v, label in rows
        if i is not None and label is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (anchor, label, q) in enumerate(usable):
        if not asks(anchor):
            continue
        scored = [
            (-sum(a * b for a, b in zip(q, v, strict=True)), i, own)
            for j, (i, own, v) in enumerate(usable)
            if j != at and len(v) == len(q)
        ]
        for p, positive, _ in sorted(s for s in scored if s[2] == label)[:positives]:
            inside = [s for s in scored if s[2] != label and low * -p <= 100 * -s[0] <= high * -p]
            for rank, (n, negative, _) in enumerate(sorted(inside)[:negatives], 1):
                out.append((anchor, positive, rank, negative, -p, -n))
    return sorted(out)


def mined(spark, rows, every=5, **options):
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], COLUMNS)
    got = hard_negatives.mine(frame, F.col("vec_id") % every == 0, how=Mining(**options))
    return sorted(tuple(r) for r in got.collect())


def clustered(rng, n, size=8, around=6, spread=0.3):
    middles = rng.normal(size=(around, size))
    return [(middles[rng.integers(around)] + spread * rng.normal(size=size)).tolist() for _ in range(n)]


@pytest.mark.parametrize("block, group", [(16, 4), (2048, 512)])
def test_against_brute_force(spark, block, group):
    rng = np.random.default_rng(1)
    rows = [(i, v, int(rng.integers(3))) for i, v in enumerate(clustered(rng, 200))]
    # Ties: whole groups of equal vectors under several labels, and short integers.
    rows += [(300 + i, [0.5] * 8, i % 4) for i in range(24)]
    rows += [(400 + i, [float(x) for x in rng.integers(-1, 2, size=8)], i % 3) for i in range(30)]
    expected = brute(rows, lambda i: i % 5 == 0)
    assert mined(spark, rows, block=block, group=group) == expected
    assert len(expected) > 500


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 1.0], 1), (5, [1.0, 0.9], 1), (2, [0.5, 0.5], 2), (3, [0.5, 0.5], 3),
        (10, None, 1), (11, [1.0, None], 2), (12, [1.0, float("nan")], 2), (13, [float("inf"), 1.0], 2),
        (15, [1.0, 1.0], None), (None, [0.6, 0.6], 2), (20, [1.0], 1), (21, [0.5], 2), (25, [1.0], 1),
        (30, [], 1), (31, [], 1), (32, [], 2), (35, [0.0, 0.0], 9), (36, [0.0, 0.0], 9),
    ]
    got = mined(spark, rows)
    assert got == brute(rows, lambda i: i % 5 == 0)
    assert {r[0] for r in got} == {0, 5, 20, 25, 30, 35}
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []
    assert mined(spark, [(1, [1.0], 1), (2, [0.5], 2)]) == []  # no anchor


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [0.9, 0.0], 1), (1, [0.5, 0.0], 2), (1, [0.4, 0.0], 2)]
    assert mined(spark, rows) == brute(rows, lambda i: i == 0)


def test_huge_components(spark):
    rows = [(i, [1e20 * (i + 1), 3.0], i % 2) for i in range(8)]
    assert mined(spark, rows) == []  # no score beyond 2**62 is found
    rows = [(i, [3e6 + 1000 * i, 2e6, float(i)], i % 2) for i in range(12)]
    assert mined(spark, rows, high=100) == brute(rows, lambda i: i % 5 == 0, high=100)


def test_tree_covers_nests_and_separates():
    rng = np.random.default_rng(4)
    points = np.vstack((clustered(rng, 300), np.ones((40, 8))))
    norm = float(np.linalg.norm(points, axis=1).max())
    x = hard_negatives.augmented(points, norm)
    assert np.allclose(np.linalg.norm(x, axis=1), norm)
    tree = hard_negatives.cover_tree(x, leaf=4)

    def below(node):
        kids = tree["children"][node]
        if kids is None:
            return list(tree["members"][node])
        centres = x[[tree["node_point"][k] for k in kids]]
        apart = np.linalg.norm(centres[:, None] - centres[None], axis=2)
        half = tree["radius"][node] / 2
        assert (apart + np.eye(len(kids)) * norm > half).all() or len(kids) == 1
        assert tree["node_point"][node] in [tree["node_point"][k] for k in kids]
        assert all(tree["radius"][k] <= half + 1e-12 for k in kids)
        return [p for k in kids for p in below(k)]

    assert sorted(below(0)) == list(range(len(points)))
    for node in range(len(tree["node_point"])):
        own = x[below(node)] - x[tree["node_point"][node]]
        assert np.linalg.norm(own, axis=1).max() <= tree["radius"][node] + 1e-9
        query = rng.normal(size=8)
        products = points[below(node)] @ query
        low, high = hard_negatives.bounds(
            np.array([points[tree["node_point"][node]] @ query]),
            np.array([tree["radius"][node]]), float(np.linalg.norm(query)), norm,
        )
        assert low[0] <= products.min() and products.max() <= high[0]


def test_the_descent_passes_over_nodes(monkeypatch):
    rng = np.random.default_rng(6)
    points = np.floor(np.array(clustered(rng, 1500, spread=0.05)) * 256).astype(np.int64)
    norm = float(np.linalg.norm(points.astype(float), axis=1).max())
    ids = np.arange(len(points))
    block = hard_negatives.Block(ids, ids, ids % 7, points, norm)
    looked = []
    exact = hard_negatives.exact_products
    monkeypatch.setattr(hard_negatives, "exact_products", lambda v, q: looked.append(len(v)) or exact(v, q))
    found = list(block.search(points[0], 0, 0, False, [(1, -(1 << 62), 1 << 62, -(1 << 62))], 5))
    assert len(found) == 5 and sum(looked) < 800
