from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from loadgrain.llm import chats, mixing


def both(df, sql, **tables):
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame.toPandas())
    con.execute("SET TimeZone = 'UTC'")
    mine = [tuple(r) for r in df.collect()]
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    assert names == df.columns
    return sorted(mine, key=repr), sorted(rel.fetchall(), key=repr)


def test_snapshots_collapse(spark):
    said = [("user", "hi"), ("assistant", "yes?"), ("user", "why"), ("assistant", "so")]
    rows = []
    for conv in range(40):
        cut = conv % 4 + 1
        rows += [(conv, t, *said[t]) for t in range(cut)]
        if conv % 10 == 9:
            rows.append((conv, 9, "user", f"only {conv}"))
    rows += [(50, 0, None, None), (51, 0, "", ""), (52, 1, "user", "a"), (52, 1, "user", "a")]
    rows += [(60, 0, "user", "hi"), (60, 1, "user", "yes?"), (61, 0, "userh", "i"), (None, 0, "user", "x")]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(
        [(*r, 1, 2) for r in rows], "conv_id bigint, turn bigint, role string, text string, i int, h1 int"
    )
    mine, theirs = both(chats.render(frame), chats.RENDERED_SQL, conversations=frame)
    assert mine == theirs
    copies = {r[0]: r[2] for r in mine}
    assert copies[19] == 1 and 0 not in copies and 3 not in copies and copies[50] == 2


def test_repeated_turn_numbers_are_in_order_of_text(spark):
    """Beginnings of conversations whose last turn number has two texts."""
    rng, rows = random.Random(3), []
    for i in range(40):
        same, more = sorted(f"t{rng.random()}" for _ in range(2))
        rows += [(2 * i, 0, "user", f"q{i}"), (2 * i, 1, "user", same)]
        rows += [(2 * i + 1, 0, "user", f"q{i}"), (2 * i + 1, 1, "user", more), (2 * i + 1, 1, "user", same)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    mine, theirs = both(chats.render(frame), chats.RENDERED_SQL, conversations=frame)
    assert mine == theirs and len(mine) == 40


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chats.render(empty).collect() == []


def documents(n, seed):
    rng = random.Random(seed)
    marks = ["", "| cell |", "x@y.z", "see http://a"]
    rows = []
    for i in range(n):
        source = "hot" if rng.random() < 0.4 else f"s{rng.randrange(4)}"
        text = " ".join(["w"] * rng.randrange(0, 60)) + " " + rng.choice(marks)
        rows.append((i, text, rng.choice(["en", "en", "de", None]), source))
    return rows + [(n, None, None, None), (n + 1, "", "en", "hot"), (n + 1, "", "en", "hot")]


def test_mixture_against_sql(docs_of):
    docs = docs_of(documents(400, 1), more=[("tokens", "int"), ("chance", "int"), ("topic", "int")])
    mine, theirs = both(mixing.mixed(docs), mixing.mixed_sql(), documents=docs)
    assert len(mine) == len(theirs) == 403
    for a, b in zip(mine, theirs, strict=True):
        assert a[:5] == b[:5] and a[6] == b[6] and a[5] == pytest.approx(b[5], abs=2e-6)


def test_margins_hold_and_sample_follows(docs_of):
    docs = docs_of(documents(3000, 2))
    rows = mixing.described(docs)
    cells = mixing.rake(rows)
    for margin in mixing.MARGINS:
        goal = {r.value: r.share for r in mixing.tempered(cells, margin).collect()}
        got = {r[0]: r[1] for r in cells.groupBy(margin).agg(F.sum("weight")).collect()}
        assert got == pytest.approx(goal, abs=1e-4)
    mixed = mixing.mixed(docs)
    assert mixed.agg(F.max("chance")).first()[0] <= 1
    kept = mixing.sample(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        r.doc_id for r in mixed.where("sampled").collect()
    )


def test_given_targets(spark, docs_of):
    goal = spark.createDataFrame([("en", 0.5), ("de", 0.5), ("absent", 0.0)], "value string, share double")
    cells = mixing.rake(mixing.described(docs_of(documents(500, 3))), {"lang": goal})
    got = {r[0]: r[1] for r in cells.groupBy("lang").agg(F.sum("weight")).collect()}
    assert got == pytest.approx({"en": 0.5, "de": 0.5, "": 0.0}, abs=1e-3)


def test_nothing_to_mix(docs_of):
    assert mixing.mixed(docs_of([])).collect() == []
    assert mixing.sample(docs_of([])).collect() == []
