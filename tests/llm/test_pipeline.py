"""The pipeline against plain versions of its stages."""

from __future__ import annotations

import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_encodings import MODEL, plain_viterbi
from test_simhash import brute as plain_dedup

sys.path.append(str(Path(__file__).parents[2]))

import corpus_pipeline

from loadgrain.llm import langid, mixing, pieces, quality
from loadgrain.llm.common import held_out, table


@pytest.fixture(scope="module")
def folder(spark, sf_dir, tmp_path_factory):
    """The given documents with odd rows and an extra column, and the given labels."""
    root = tmp_path_factory.mktemp("corpus")
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = given.where("doc_id = 15").first().text
    odd = [
        (900_001, None, "en", "s"),
        (900_002, "", None, None),
        (900_003, "12 !! 34", "en", "s"),
        (900_004, good, None, None),
        (900_005, good.replace(" the ", " a ", 1), "en", "src1"),
        (900_006, good.upper(), "en", "src1"),
        (900_004, good, None, None),
        (900_008, " ".join(f"{w}{i}" for i, w in enumerate((good + " ").split() * 60)), "en", "src2"),
        *((900_010 + i, t, None, "s") for i, t in enumerate(("A.", "Q!!", "Жщъ ыэю", "汉字 汉", "zZ!! xQ"))),
        (None, good, "en", "src1"),
    ]
    frame = spark.createDataFrame(
        [(*r, 0) for r in odd], "doc_id bigint, text string, lang string, source string, n_chars bigint"
    )
    both = given.unionByName(frame).withColumn("ids", F.lit(1))
    both.write.parquet(f"{root}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(f"{root}/labels.parquet")
    return str(root)


def plain_mixture(docs):
    """Raking and drawing, one cell after the other."""
    import hashlib
    import re

    def topic(t):
        return "table" if "|" in t else "contact" if "@" in t else "link" if "http" in t else "prose"

    cells, of = {}, {}
    for d in docs:
        of[d.doc_id] = (d.source or "", d.lang or "", topic(d.text))
        words = max(1, len(re.findall(r"[^ \t\n\r\f\x0B]+", d.text)))
        cells[of[d.doc_id]] = cells.get(of[d.doc_id], 0) + words
    total = sum(cells.values())

    def margins(weights, at):
        sums = {}
        for cell, w in weights.items():
            sums[cell[at]] = sums.get(cell[at], 0) + w
        return sums

    goals = []
    for at in range(3):
        parts = {k: v**mixing.TEMPER for k, v in margins(cells, at).items()}
        goals.append({k: v / sum(parts.values()) for k, v in parts.items()})
    weights = dict(cells)
    for _ in range(mixing.ROUNDS):
        for at in range(3):
            sums = margins(weights, at)
            weights = {c: w * goals[at][c[at]] / sums[c[at]] for c, w in weights.items()}
    ratio = {c: weights[c] / cells[c] for c in cells}
    scale = min(mixing.BUDGET * total, 1 / max(ratio.values()))
    kept = set()
    for d in docs:
        text = f"{mixing.SEED}:" + ("" if d.doc_id is None else str(d.doc_id))
        draw = int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2**52
        if draw < min(1.0, scale * ratio[of[d.doc_id]]):
            kept.add(d.doc_id)
    return kept


def test_stages_against_plain_versions(spark, folder):
    docs = table(spark, folder, "documents")
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda rows: sorted((r.doc_id for r in rows), key=repr)
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = spark.createDataFrame(stage(spark, docs, folder).toArrow())
        out[name] = before, docs.collect()
        if stage is not stages["SentencePiece"]:
            assert docs.columns == table(spark, folder, "documents").columns

    before, after = out["language ID"]
    labelled = spark.createDataFrame(before, table(spark, folder, "documents").schema)
    model = langid.fit(labelled.where(~held_out()))
    lettered = [r for r in before if any(c.isalpha() for c in r.text or "")]
    best, scores = model.decide([r.text for r in lettered])
    told = [(r.doc_id, r.text, model.languages[b]) for r, b, s in zip(lettered, best, scores, strict=True) if s >= 0.5]
    assert sorted(((r.doc_id, r.text, r.lang) for r in after), key=repr) == sorted(told, key=repr)
    gone = {r.doc_id for r in before} - set(ids(after))
    assert gone & {r.doc_id for r in lettered}  # texts with letters go as well
    assert {r.doc_id: r.lang for r in after}[900_004] == "en"  # was NULL: told, and passed on

    before, after = out["quality classifier"]
    seen = spark.createDataFrame(before, table(spark, folder, "documents").schema)
    labels = table(spark, folder, "labels").where(~held_out())
    model = quality.fit(seen.where(~held_out()), labels)
    scores = model.scores(np.stack([quality.features(r.text) for r in before]))
    assert ids(after) == ids(r for r, s in zip(before, scores, strict=True) if s >= 0.7)
    assert len(after) < len(before)

    before, after = out["SimHash near-dedup"]
    rows = [(r.doc_id if r.doc_id is not None else 10**9, r.text) for r in before]
    assert ids(after) == ids(r for r in before if r.doc_id in {c for _, _, c in plain_dedup(rows)})
    assert 15 in ids(after) and not {900_004, 900_006, None} & set(ids(after))

    before, after = out["mixing"]
    assert ids(after) == sorted(plain_mixture(before), key=repr)

    before, after = out["SentencePiece"]
    own, texts = pieces.Pieces(MODEL), {r.doc_id: r.text for r in before}
    assert ids(after) == ids(before) and all(r.round_trip for r in after)
    for r in after[:5]:
        assert r.ids == plain_viterbi(own, texts[r.doc_id])


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels"):
        table(spark, folder, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert result.count() == 0 and "ids" in result.columns
