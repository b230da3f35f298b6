from __future__ import annotations

from loadgrain.llm import sketches


def test_texts_are_shuffled_by_one_exchange_before_the_joins(docs_of):
    """Counting repeated rows took a second shuffle of all texts."""
    found = sketches.edit_likeness(docs_of([(1, "a b c"), (2, "d e f"), (2, "d e f")]))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    with_text = [line for line in plan.splitlines() if "Aggregate" in line and "first(text" in line]
    assert with_text and not any("count(" in line for line in with_text)
    assert found.count() == 3
