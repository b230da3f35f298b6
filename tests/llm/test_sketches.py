from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loadgrain.llm import sketches


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edit_likeness_against_brute_force(docs_of):
    rng = random.Random(4)
    texts = [None, "", "one", "é" * 7, "a b c d e f g", "a b c d e f g", " \n"]
    texts += [" ".join(rng.choices("abcdefghij", k=rng.randrange(3, 90))) for _ in range(30)]
    rows = [(i * 7, t) for i, t in enumerate(texts)] + [(None, "no id at all"), (14, "zz"), (14, "one")]
    rows += [(None, "no id either, but other words"), (None, None), (14, "zz"), (14, "zz")]
    rng.shuffle(rows)
    docs = docs_of(rows, more=[("id", "int"), ("own", "int"), ("head", "int"), ("n", "int")])
    got = sorted((tuple(r) for r in sketches.edit_likeness(docs).collect()), key=repr)
    mark = lambda t: np.uint64(xxhash.xxh64_intdigest((t or "").encode(), 42)).astype(np.int64)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), mark(r[1])))
    expected = []
    for at, (d, text) in enumerate(order):
        text, after = text or "", order[(at + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        # All have fewer shingles than a sketch holds, so the estimates are exact.
        alike = [likeness(shingles(text), shingles(x)) for x in (edited, after)]
        expected.append((d, len(text), hashlib.sha256(edited.encode()).hexdigest(), *alike))
    expected.sort(key=repr)
    assert [r[:3] for r in got] == [r[:3] for r in expected]
    for mine, theirs in zip(got, expected, strict=True):
        assert mine[5:] == pytest.approx(theirs[3:])
    prints = {r[0]: r[3] for r in got}
    assert prints[28] == prints[35]


def test_merge_and_estimates(spark):
    rng = random.Random(5)
    words = [f"w{rng.random()}" for _ in range(6000)]
    a, b = " ".join(words[:4000]), " ".join(words[2000:])
    frame = spark.createDataFrame([(a, b, a + " " + b)], "a string, b string, both string")
    s = {c: sketches.sketch(F.col(c)) for c in "ab"}
    r = frame.select(
        sketches.resemblance(s["a"], s["b"]).alias("like"),
        sketches.containment(s["a"], s["b"]).alias("inside"),
        sketches.distinct_count(s["a"]).alias("n"),
        F.size(sketches.merged(s["a"], s["b"])).alias("k"),
        (sketches.merged(s["a"], s["b"]) == sketches.merged(s["b"], s["a"])).alias("same"),
    ).first()
    assert r.like == pytest.approx(1 / 3, abs=0.13)
    assert r.inside == pytest.approx(1 / 2, abs=0.2)
    assert r.n == pytest.approx(3996, rel=0.3)
    assert r.k == sketches.SKETCH_SIZE and r.same


def test_empty_table_and_one_document(docs_of):
    assert sketches.edit_likeness(docs_of([])).collect() == []
    only = sketches.edit_likeness(docs_of([(3, "a b c d e f g h i")])).first()
    assert only.near_next == 1.0
