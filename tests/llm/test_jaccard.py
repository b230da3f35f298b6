from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_simhash import plain_components

from loadgrain.llm import jaccard


def plain_set(text, words=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1)))


def brute(texts, words=3, percent=90):
    """(size, component) of each row; rows are told apart by their place."""
    sets = [plain_set(t, words) for t in texts]
    links = [
        (a, b)
        for a, b in combinations(range(len(sets)), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    roots = plain_components(links, range(len(sets)))
    return {i: (len(s), roots[i]) for i, s in enumerate(sets)}


def found(docs, **options):
    return jaccard.linked(docs, jaccard.Likeness(**options)).collect()


def family(rng, base, n, edits):
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"e{rng.random()}"
        yield " ".join(words)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randrange(2, 6)))
    texts = [None, "", " \n", "One", "one", "a b", "A  b", "a b c", "a b c a b c", "Ü É", "ü é"]
    base = [word() for _ in range(90)]
    texts += list(family(rng, base, 120, 4))
    # One passage in many different texts.
    passage = " ".join(word() for _ in range(40))
    for _ in range(40):
        own = " ".join(word() for _ in range(rng.randrange(1, 30)))
        texts += [f"{own} {passage}", f"{passage} {own}"]
    # One vocabulary in other orders, and beginnings of each other.
    some = [word() for _ in range(60)]
    texts += [" ".join(rng.sample(some, 60)) for _ in range(30)]
    texts += [" ".join(base[:n]) for n in range(60, 90, 2)]
    texts += ["x y " * n for n in (3, 50, 51)] + [" ".join(base).upper()] * 3
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("paired, square, first", [(2, 8, 1), (2, 16, 4), (16, 1024, 4), (10_000, 1024, 4)])
def test_against_brute_force(docs_of, texts, paired, square, first, monkeypatch):
    monkeypatch.setattr(jaccard, "SQUARE", square)
    monkeypatch.setattr(jaccard, "ROUND", first)
    got = found(docs_of(list(enumerate(texts))), paired=paired)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(texts)
    assert len(got) == len(texts)


@pytest.mark.parametrize("words, percent", [(1, 50), (5, 80), (2, 100)])
def test_other_sizes_and_likenesses(docs_of, texts, words, percent):
    some = texts[:120]
    got = found(docs_of(list(enumerate(some))), words=words, percent=percent, paired=8)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(some, words, percent)


def test_repeated_and_missing_ids_and_clashing_columns(docs_of):
    long = " ".join(f"w{i}" for i in range(30))
    rows = [(7, long), (7, "other words entirely"), (None, long), (3, long + " w30"), (None, "alone in here"),
            (None, None), (5, ""), (7, long)]
    more = [("n", "int"), ("row", "int"), ("t", "string"), ("token", "int"), ("component_id", "int")]
    got = sorted(tuple(r) for r in found(docs_of(rows, more)) if r.doc_id is not None)
    assert got == [(3, 29, 3), (5, 0, 5), (7, 1, 7), (7, 28, 3), (7, 28, 3)]
    lost = sorted((r.n_shingles, r.component_id) for r in found(docs_of(rows)) if r.doc_id is None)
    assert lost == [(0, None), (1, None), (28, 3)] or lost[2] == (28, 3)


def test_empty_table_and_long_texts(docs_of):
    assert found(docs_of([])) == []
    long = " ".join(f"w{i}" for i in range(30_000))
    got = found(docs_of([(1, long), (2, long + " end"), (3, "x" * 200_000), (4, "y " * 20_000)]))
    assert sorted(tuple(r) for r in got) == [(1, 29_998, 1), (2, 29_999, 1), (3, 1, 3), (4, 1, 4)]


def test_rare_ngrams_come_first(docs_of):
    common = "one two three four five"
    docs = docs_of([(i, f"{common} u{i} v{i} w{i}") for i in range(50)])
    ranks = jaccard.slot_order(docs, 3)
    shared = set(jaccard.ngrams(common, 3).tolist())
    own = jaccard.ngrams(f"{common} u7 v7 w7", 3)
    named = jaccard.rare_first(own, ranks)
    assert len(set(named.tolist())) == len(own)
    last = [g for _, g in sorted(zip(named.tolist(), own.tolist(), strict=True))][-3:]
    assert set(last) == shared


def test_copies_and_passages_make_few_pairs(spark, docs_of, monkeypatch):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    passage = " ".join(word() for _ in range(30))
    own = [" ".join(word() for _ in range(12)) for _ in range(300)]
    texts = ["same words in all of these copies"] * 400 + [f"{o} {passage}" for o in own]
    seen = []
    verified = jaccard._verified
    monkeypatch.setattr(jaccard, "_verified", lambda p, *a: seen.append(p.count()) or verified(p, *a))
    got = found(docs_of(list(enumerate(texts))))
    assert len({r.component_id for r in got}) == 301
    assert sum(seen) == 0


def test_filters_let_every_link_pass(spark):
    rng = np.random.default_rng(3)
    how = jaccard.Likeness()
    for _ in range(300):
        x = rng.choice(1 << 40, size=rng.integers(1, 80), replace=False)
        y = np.union1d(rng.choice(x, size=max(1, len(x) - rng.integers(0, 4)), replace=False),
                       rng.choice(1 << 40, size=rng.integers(0, 4)))
        common, total = len(np.intersect1d(x, y)), len(np.union1d(x, y))
        if 100 * common >= 90 * total:
            a, b = sorted(x)[: how.prefix(len(x))], sorted(y)[: how.prefix(len(y))]
            assert set(a) & set(b)
    frame = spark.createDataFrame([(10, 9, 0, 0), (10, 8, 0, 0), (100, 100, 0, 9)],
                                  "na bigint, nb bigint, pa bigint, pb bigint")
    kept = frame.select(jaccard._lengths(how), jaccard._places(how)).collect()
    assert [tuple(r) for r in kept] == [(True, True), (False, False), (True, False)]
    assert frame.where(F.lit(True)).count() == 3
