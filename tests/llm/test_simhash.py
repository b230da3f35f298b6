from __future__ import annotations

import random
from itertools import combinations

import pytest
import xxhash

from loadgrain.llm import simhash


def plain_simhash(text):
    """The fingerprint as its definition reads."""
    import re

    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(links, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def brute(rows):
    fps = [(d, plain_simhash(t)) for d, t in rows]
    ids = [d for d, _ in fps]
    links = [(a, b) for (a, x), (b, y) in combinations(fps, 2) if (x ^ y).bit_count() <= 2]
    roots = plain_components(links, ids)
    return sorted((d, f"{x:016x}", roots[d]) for d, x in fps)


def test_against_brute_force(docs_of):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(40)] + ["Émile", "ÀB", "X"]
    texts = [None, "", " \t\n", "One", "one", "a b", "A B c", " "]
    base = " ".join(rng.choices(words, k=120))
    texts += [base, base.upper(), base + " end", base.replace("w1 ", "w2 ")]
    for _ in range(60):
        some = base.split()
        some[rng.randrange(120)] = "new"
        texts.append(" ".join(some))
    texts += [" ".join(rng.choices(words, k=rng.randrange(1, 9))) for _ in range(60)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = docs_of(rows)
    got = simhash.fingerprint_components(docs).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)


@pytest.mark.parametrize("paired_block", [1, 3, 64])
def test_links_join_what_is_close(spark, paired_block):
    rng = random.Random(paired_block)
    fps = {0, -1, -(1 << 63)}
    for _ in range(30):
        fp = rng.getrandbits(64)
        for _ in range(6):
            for bit in rng.sample(range(64), rng.randrange(4)):
                fp ^= 1 << bit
            fps.add(fp - (1 << 64) if fp >> 63 else fp)
    frame = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    links = [(r.a, r.b) for r in simhash.fingerprint_links(frame, paired_block).collect()]
    mask = (1 << 64) - 1
    near = [(a, b) for a, b in combinations(fps, 2) if ((a ^ b) & mask).bit_count() <= 2]
    assert all(((a ^ b) & mask).bit_count() <= 2 for a, b in links)
    assert plain_components(links, fps) == plain_components(near, fps)


def test_empty_table(docs_of):
    assert simhash.fingerprint_components(docs_of([])).collect() == []
    assert simhash.keep_one(docs_of([])).collect() == []


def test_repeated_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame(
        [(1, "x y z", 5, 5), (1, "x y z", 5, 5), (None, "x y z", 1, 1), (2, "other words here", 1, 1)],
        "doc_id bigint, text string, fp bigint, component_id bigint",
    )
    got = simhash.fingerprint_components(docs).collect()
    assert sorted(((r.doc_id or -1), r.component_id) for r in got) == [(-1, 1), (1, 1), (1, 1), (2, 2)]


def family(rng, base, n, edits):
    for _ in range(n):
        words = list(base)
        for _ in range(edits):
            words[rng.randrange(len(words))] = f"e{rng.random()}"
        yield " ".join(words)


def test_keep_one_against_brute_force(docs_of):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randrange(2, 7)))
    texts = [None, "", " ", "one two", "One  two\n", "a b c d e f"]
    for size, n in ((900, 30), (1500, 30), (40, 20)):
        base = [word() for _ in range(size)]
        texts += [" ".join(base)] * 3 + list(family(rng, base, n, 1))
    texts += [" ".join(rng.sample(base, len(base))) for _ in range(50)]  # one vocabulary
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    expected = {component for _, _, component in brute(rows)}
    kept = simhash.keep_one(docs_of(rows, more=[("__row", "int"), ("fp", "int"), ("__fp", "int")]))
    assert kept.columns[-3:] == ["__row", "fp", "__fp"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected)
    assert len(expected) < len(rows) - 30


def test_keep_one_of_repeated_rows(docs_of):
    rows = [(1, "p q r"), (1, "p q r"), (2, "P Q R"), (None, "x y"), (None, "x y"), (5, None), (6, "")]
    kept = simhash.keep_one(docs_of(rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == [(False, 1), (False, 5), (True, 0)]


def test_keep_one_tells_rows_without_or_with_the_same_id_apart(docs_of):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    # Texts without ids and texts under one id are documents of their own.
    rows = [(None, a), (None, b), (None, b.upper()), (1, c), (2, d), (2, c.replace(" ", "\n"))]
    kept = sorted((r.doc_id or 0, r.text[:1]) for r in simhash.keep_one(docs_of(rows)).collect())
    assert [(i, t.lower()) for i, t in kept] == [(0, "a"), (0, "b"), (1, "c"), (2, "d")]


def test_links_through_a_long_chain(spark):
    from loadgrain.llm.common import connected_components

    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (7, 7)]
    random.Random(1).shuffle(chain)
    got = connected_components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()
    assert {r.node: r.root for r in got} == {**{i: 0 for i in range(61)}, 100: 100, 200: 100}
