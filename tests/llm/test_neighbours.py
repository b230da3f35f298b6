from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadgrain.llm import neighbours, queries


def brute(rows, asks, k):
    out = {}
    for q, x in rows:
        if not asks(q):
            continue
        near = []
        for v, y in rows:
            if v == q or len(x) != len(y):
                continue
            a, b = np.array(x, dtype=np.float32).astype(float), np.array(y, dtype=np.float32).astype(float)
            near.append((-float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))), v))
        out[q] = [(v, -s) for s, v in sorted((round(s, 12), v) for s, v in near)[:k]]
    return out


def search(spark, rows, **options):
    frame = spark.createDataFrame(
        [(*r, 1, 1) for r in rows], "vec_id bigint, embedding array<float>, id int, bucket int"
    )
    found = neighbours.nearest(frame, F.col("vec_id") % 5 == 0, neighbours.Search(**options)).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    return got


def test_copies_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(40)]
    rows += [(100 + i, [1.0, 2.0, 3.0, 0.0, 0.0, 0.0]) for i in range(25)]
    rows += [(200 + i, [2.0, 4.0, 6.0, 0.0, 0.0, 0.0]) for i in range(3)]
    rows += [(300, [1.0, 0.0]), (301, [0.5, 0.5]), (305, [3.0])]
    bad = [None, [0.0] * 6, [None, *[1.0] * 5], [float("nan"), *[1.0] * 5], [float("inf"), *[1.0] * 5]]
    odd = [(400 + 5 * i, v) for i, v in enumerate(bad)] + [(None, [1.0] * 6)]
    # Wide cells: every bucket is visited, so the result must be exact.
    got = search(spark, rows + odd, directions=2, width=50.0, probes=9)
    expected = brute(rows, lambda q: q % 5 == 0, 5)
    expected.pop(305)  # no other vector of its length
    assert {q: [v for v, _ in x] for q, x in got.items()} == {
        q: [v for v, _ in x] for q, x in expected.items()
    }
    for q, x in got.items():
        assert [s for _, s in x] == pytest.approx([s for _, s in expected[q]], abs=1e-12)


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(120)]
    whole = search(spark, rows, directions=2, width=1.0, probes=9)
    monkeypatch.setattr(neighbours, "BLOCK", 7)
    blocked = search(spark, rows, directions=2, width=1.0, probes=9)
    assert blocked.keys() == whole.keys()
    for q, x in whole.items():  # sums may differ in the last bit
        assert [v for v, _ in blocked[q]] == [v for v, _ in x]
        assert [s for _, s in blocked[q]] == pytest.approx([s for _, s in x], abs=1e-12)


def test_probes_in_order_of_success():
    sets = neighbours.perturbations(3, 27)
    assert sets[0] == () and sets[1] == (1,) and len(set(sets)) == len(sets) == 27
    # All ways to leave each of three directions as it is or cross one of its borders.
    for ranks in sets:
        assert all(7 - r not in ranks for r in ranks)


def test_recall_on_given_vectors(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    exact = brute(rows, lambda q: q % 50 == 0, 5)
    found = queries.op5_nearest_neighbours(spark, sf_dir).collect()
    pairs = {(r.query_id, r.vec_id) for r in found}
    wanted = {(q, v) for q, x in exact.items() for v, _ in x}
    assert len(pairs) == len(wanted)
    assert len(pairs & wanted) >= 0.9 * len(wanted)


@pytest.mark.parametrize("n", [1, 2, 4, 6, 10])
def test_small_tables_give_all_there_is(spark, n):
    rng = np.random.default_rng(n)
    rows = [(5 * i, rng.normal(size=4).tolist()) for i in range(n)]
    got = search(spark, rows, directions=4, width=0.01, probes=2, tables=1)
    expected = {q: x for q, x in brute(rows, lambda q: True, 5).items() if x}
    assert {q: [v for v, _ in x] for q, x in got.items()} == {q: [v for v, _ in x] for q, x in expected.items()}


def test_repeated_ids_are_vectors_of_their_own(spark):
    frame = spark.createDataFrame(
        [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (5, [1.0, 0.0]), (7, [1.0, 1.0])],
        "vec_id bigint, embedding array<float>",
    )
    got = neighbours.nearest(frame, F.col("vec_id") == 5, neighbours.Search(k=5)).collect()
    found = sorted((r["rank"], r.vec_id, round(r.score, 3)) for r in got)
    assert found == [(1, 5, 1.0), (1, 5, 1.0), (1, 7, 0.707), (2, 5, 0.0), (2, 7, 0.707), (2, 7, 0.707),
                     (3, 5, 0.0), (3, 5, 0.0), (3, 5, 0.0)]


def test_components_beyond_floats_take_no_part(spark):
    frame = spark.createDataFrame(
        [(0, [1e300, 1.0]), (1, [1.0, 1.0]), (5, [2.0, 2.0])], "vec_id bigint, embedding array<double>"
    )
    got = neighbours.nearest(frame, F.col("vec_id") % 5 == 0).collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(5, 1)]


def test_no_vectors(spark):
    assert search(spark, [(1, None)]) == {}
