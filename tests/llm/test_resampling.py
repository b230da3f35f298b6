from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import pytest

from loadgrain.llm import resampling
from loadgrain.llm.resampling import Resampling


def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(rows, target, how):
    def features(text):
        w = plain_words(text)
        return [" ".join(w[i : i + n]) for n in range(1, how.longest_run + 1) for i in range(len(w) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % how.buckets
    s, t = [0] * how.buckets, [0] * how.buckets
    for counts, texts in ((s, [x for _, x in rows]), (t, target)):
        for text in texts:
            for f in features(text):
                counts[bucket(f)] += 1
    big_s, big_t = sum(s) + how.buckets, sum(t) + how.buckets
    gain = [math.floor(1000 * math.log((y + 1) * big_s / ((x + 1) * big_t))) for x, y in zip(s, t, strict=True)]
    out = []
    for doc_id, text in rows:
        own = features(text)
        name = f"{how.seed}:" + ("" if doc_id is None else str(doc_id))
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in own)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(own), weight, score, None, len(plain_words(text)) >= how.least_words])
    fit = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(fit[: how.percent * len(fit) // 100], 1):
        r[4] = rank
    return sorted([tuple(r[:5]) for r in out], key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(13)
    word = lambda: rng.choice(["the", "The", "ärger", "x1", "naïve", "日本", "of", "zebra"]) + rng.choice("ab ,-")
    texts = ["".join(word() + " " for _ in range(rng.randrange(0, 60))) for _ in range(300)]
    return list(enumerate([None, "", "..", "a\x00b\x7fc", "É" * 30, *texts, "long " * 30_000]))


def resampled(docs, target_docs, how, **options):
    got = resampling.resample(docs, target_docs, how, **options).collect()
    return sorted([tuple(r) for r in got], key=repr)


@pytest.mark.parametrize("segment_rows", [1, 7, 4096])
@pytest.mark.parametrize("how", [Resampling(), Resampling(50, 3, 3, 97, 7), Resampling(percent=100)])
def test_against_brute_force(spark, docs_of, rows, how, segment_rows):
    target = [t for _, t in rows[100:130]] + [None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id bigint, text string")
    docs = docs_of(rows, [("segment", "int"), ("at", "int"), ("score", "int")]).repartition(5)
    got = resampled(docs, frame, how, segment_rows=segment_rows)
    assert got == brute(rows, target, how)


def test_repeated_and_missing_ids(docs_of):
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(4, text)] * 30 + [(None, text)] * 10 + [(None, None), (4, "short")]
    how = Resampling(percent=50)
    docs = docs_of(rows).repartition(4)
    got = resampling.resample(docs, docs_of([(1, text)]), how, segment_rows=3).collect()
    ranks = sorted(r["rank"] for r in got if r["rank"] is not None)
    assert len(got) == 42 and ranks == list(range(1, 21))
    best = max(r.score for r in got if r["rank"] is not None)
    assert all(r.score == best for r in got if r["rank"] is not None and r["rank"] <= 10)


def test_empty_tables(docs_of):
    assert resampled(docs_of([]), docs_of([(1, "a b")]), Resampling()) == []
    rows = [(i, " ".join(f"w{i % 3}" for _ in range(21 + i))) for i in range(20)]
    assert resampled(docs_of(rows), docs_of([]), Resampling()) == brute(rows, [], Resampling())


def test_splitters_keep_segments_even(spark, docs_of):
    text = " ".join(f"w{i}" for i in range(20))
    docs = docs_of([(i, f"{text} v{i % 50}") for i in range(4000)]).repartition(7)
    how = Resampling()
    gain = resampling.gains(resampling.bucket_counts(docs, how), resampling.bucket_counts(docs.limit(9), how))
    runs = resampling.sorted_runs(resampling.scored(docs, gain, how))
    splits = resampling.splitters(runs, 4000, 200)
    assert len(splits) == 19 and splits == sorted(splits)
    sizes = [r["count"] for r in resampling.cut(runs, splits).groupBy("segment").count().collect()]
    assert len(sizes) == 20 and max(sizes) <= 300 and sum(sizes) == 4000
