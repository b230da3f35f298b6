"""Language identification and the quality classifier."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadgrain.llm import langid, quality, queries

WORDS = {
    "en": "the of and this that with from which have they were been would there".split(),
    "de": "der die und das nicht mit sich auch werden einer haben schön über".split(),
    "": "xyzzy qwfp zxcv qqq".split(),
}


def text_of(lang, rng, n):
    return " ".join(rng.choices(WORDS[lang], k=n))


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(1)
    rows = [(i, text_of(k, rng, rng.randrange(3, 60)), k) for i, k in enumerate(list(WORDS) * 40)]
    return rows + [(900, None, "en"), (901, "", "de"), (902, "123 !!", "de"), (None, "the of", "en")]


def test_language_of_clean_and_odd_texts(docs_of, labelled):
    model = langid.fit(docs_of(labelled))
    assert set(model.languages) == set(WORDS)
    rng = random.Random(2)
    odd = [(1, None), (2, ""), (3, "12 !! ..."), (4, "THE OF AND, WITH!!"), (5, text_of("de", rng, 90_000))]
    docs = docs_of(odd + [(None, "die und der")], more=[("p", "int"), ("score", "int"), ("lang_pred", "int")])
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert {k: r.lang_pred for k, r in got.items()} == {
        1: "und", 2: "und", 3: "und", 4: "en", 5: "de", None: "de",
    }
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = langid.keep_identified(docs, model)
    assert kept.columns == docs.columns and kept.count() == 3


def test_kernel_as_defined(labelled):
    """Products of presence rows count the n-grams that two texts share."""
    a, b = "Der Hund!", "die  hunde, der"

    def grams(text):
        folded = "".join(c if c.isalpha() else " " for c in text.lower())
        folded = " " + " ".join(folded.split()) + " "
        return {folded[i : i + n] for n in range(1, 5) for i in range(len(folded) - n + 1)}

    x, y = langid.presence([a, b])
    assert abs(int(x @ y) - len(grams(a) & grams(b))) <= 1  # slots can collide
    assert abs(int(x.sum()) - len(grams(a))) <= 2


def test_long_text_reads_like_its_parts(monkeypatch):
    text = " ".join(WORDS["de"] * 9) + ", !"
    whole = langid.presence([text])
    monkeypatch.setattr(langid, "BATCH_CHARS", 7)
    assert np.array_equal(whole, langid.presence([text]))


def test_samples_stay_bounded_without_ids(docs_of):
    rng = random.Random(7)
    rows = [(None, text_of("en", rng, 9) + f" w{i}", "en") for i in range(600)]
    rows += [(7, "die und der", "de")] * 300 + [(8, "xyzzy qwfp", "rare")]
    docs = docs_of(rows)
    model = langid.fit(docs, fit_rows=60)
    assert model.languages == ("de", "en", "rare")
    assert len(quality._sampled(docs.select("doc_id", "text"), 50, 1)) <= 50
    got = quality._sampled(docs.where("lang = 'en'").select("doc_id", "text"), 50, 1)
    assert 30 <= len(got) <= 50
    assert len(quality._sampled(docs.where("lang = 'de'").select("doc_id", "text"), 400, 2)) == 300


def test_no_rows_to_learn_from(docs_of):
    model = langid.fit(docs_of([]))
    assert [tuple(r) for r in langid.identify(docs_of([(1, "word")]), model).collect()] == [(1, "und", 0.0)]
    assert langid.identify(docs_of([]), model).collect() == []


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = queries.op6_language_id(spark, sf_dir).where("held_out").join(docs, "doc_id")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.97


def test_quality_on_held_out_rows(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = queries.op10_quality_classifier(spark, sf_dir)
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    hit = (F.col("quality") == F.col("predicted")).cast("int")
    assert got.where("held_out").join(labels, "doc_id").agg(F.avg(hit)).first()[0] >= 0.9


def test_quality_rows_and_defaults(spark, docs_of):
    model = quality.fit(docs_of([]), spark.createDataFrame([], "doc_id bigint, quality int"))
    docs = docs_of([(1, None), (2, ""), (None, "x" * 400_000)], more=[("score", "int"), ("row", "int")])
    scores = docs.select(quality.score(model, F.col("text"))).collect()
    assert [r[0] for r in scores] == pytest.approx([model.prior] * 3)
    assert quality.keep_good(docs, model, 0.0).columns == docs.columns


def test_features_do_not_depend_on_the_stretch(monkeypatch):
    text = "Some Words, some || words!!\n" * 5
    whole = quality.features(text)
    monkeypatch.setattr(quality, "BATCH_CHARS", 5)
    assert np.allclose(whole, quality.features(text))


def test_unlabelled_learning_finds_the_negatives():
    """Positives alone and a mixture are enough, with the right prior."""
    rng = np.random.default_rng(0)

    def rows(n, good):
        x = rng.normal(size=(n, quality.WIDTH)).astype(np.float32)
        x[:, 5:] = 0
        x[:, 0] += 3 if good else -3
        return x

    unlabelled = np.vstack((rows(3500, True), rows(1500, False)))
    model = quality.fit_rows(rows(3000, True), unlabelled, 0.7)
    assert (model.scores(rows(500, True)) > 0.5).mean() > 0.95
    assert (model.scores(rows(500, False)) < 0.5).mean() > 0.95
