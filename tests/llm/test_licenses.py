from __future__ import annotations

import math
import re

from loadgrain.llm import licenses

LINES = [
    "Released under the MIT License.",
    "Licensed under the Apache License, Version 2.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under CC BY-NC 4.0.",
    "mit license mit license MIT\nLICENSE apache-license",
    "the MIT general License public",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of it",
    "permission is granted free of charge to any person hereby",
    "Redistribution and use in source and binary forms, with or without modification",
]


def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(rows):
    """Every passage at every place of every text."""
    split = [(d, plain_words(t)) for d, t in rows]
    n = len(split)
    vocabulary = {w for p in licenses.PASSAGES for w in p.text.split()}
    df = {w: sum(w in set(words) for _, words in split) for w in vocabulary}
    idf = {w: math.log((n + 1) / (df[w] + 0.5)) for w in vocabulary}
    out = []
    for d, words in split:
        starts, base, labels, score = [], set(), set(), 0.0
        for p in licenses.PASSAGES:
            text, key = p.text.split(), p.key.split()
            at = next(i for i in range(len(text)) if text[i : i + len(key)] == key)
            total = sum(idf[w] for w in text)
            for start in range(-len(text), len(words)):
                same = [
                    i for i, w in enumerate(text) if 0 <= start + i < len(words) and words[start + i] == w
                ]
                found = sum(idf[text[i]] for i in same)
                if not set(range(at, at + len(key))) <= set(same) or found < 0.6 * total:
                    continue
                labels.add(p.label)
                score = max(score, 1.0 if p.base else min(1.0, found / total))
                if p.base:
                    starts.append(start)
                    base.add(p.label)
        ends = (min(starts), max(starts)) if starts else (None, None)
        row = (d, len(words), len(starts), *ends, ",".join(sorted(base)), ",".join(sorted(labels)))
        out.append((*row, round(score, 6)))
    return sorted(out, key=repr)


def test_scan_against_brute_force(docs_of):
    texts = [None, "", "...", "Überall licence ünd", *LINES, " / ".join(LINES), "x " * 5000 + LINES[0]]
    rows = list(enumerate(texts)) + [(3, LINES[0]), (3, LINES[0]), (None, LINES[1])]
    docs = docs_of(rows, more=[("row", "int"), ("hits", "int"), ("word", "string"), ("template", "int")])
    got = [tuple(r) for r in licenses.scan(docs).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_key_phrases_without_a_gate_word(docs_of):
    lines = ["Released under CC BY-SA 4.0", "(cc-by-nc)", "under cc / By_Nc", "cc by", "accc by sa x", "cc bysa"]
    rows = list(enumerate([*lines, *["nothing of the kind"] * 30]))
    got = sorted((tuple(r) for r in licenses.scan(docs_of(rows)).collect()), key=repr)
    assert got == brute(rows)
    assert [r[6] for r in sorted(got) if r[0] in (0, 2)] == ["cc-by-sa", "cc-by-nc"]


def test_rare_words_elsewhere_crowd_nothing_out(docs_of):
    key = "Permission is hereby granted, free of charge"
    lines = [f"{key}. The person obtaining the copy. " + ". ".join(key.split()), key, "GNU lesser public " * 9]
    rows = list(enumerate([*lines, *["to any a"] * 40, "person obtaining copy"]))
    got = sorted((tuple(r) for r in licenses.scan(docs_of(rows)).collect()), key=repr)
    assert got == brute(rows)
    assert [r[6] for r in sorted(got) if r[0] == 0] == ["mit"]


def test_sql_agrees_on_all_lines(docs_of):
    import duckdb

    rows = list(enumerate([*LINES, "Released under CC BY-SA 4.0", "cc by nc", None, *["to any a"] * 20]))
    con = duckdb.connect()
    con.register("documents", docs_of(rows).toPandas())
    theirs = con.execute(licenses.scan_sql()).fetchall()
    assert sorted(theirs, key=repr) == brute(rows)


def test_every_passage_has_a_gate():
    assert all(any(g in p.text for g in licenses.GATED) for p in licenses.PASSAGES)


def test_empty_table(docs_of):
    assert licenses.scan(docs_of([])).collect() == []
