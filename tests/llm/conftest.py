from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs_of(spark):
    """A ``documents`` frame from (doc_id, text, lang, source); further places are NULL."""

    def build(rows, more=()):
        names = [n for n, _ in more]
        schema = DOCS + "".join(f", {n} {t}" for n, t in more)
        filled = [(*r, *[None] * (4 - len(r)), 7, *[1] * len(names)) for r in rows]
        return spark.createDataFrame(filled, schema)

    return build
