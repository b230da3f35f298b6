"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic). Raking scales the cells'
token weights to each margin's targets in turn until all margins hold; a
document's chance of being sampled is proportional to its cell's weight per
token, so the expected tokens of the sample follow the targets exactly.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadgrain.session import settle

MARGINS = ("source", "lang", "topic")
#: Targets, where none are given: shares of tokens to this power, scaled to one.
TEMPER = 0.85
ROUNDS = 10
#: Share of all tokens wanted in the sample; lowered where a chance would exceed one.
BUDGET = 0.6
SEED = "mix"
WORD = r"[^ \t\n\r\f\x0B]+"


def topic(text: Column) -> Column:
    """A coarse topic told by marks in the text; NULL counts as empty."""
    return (
        F.when(text.contains("|"), "table")
        .when(text.contains("@"), "contact")
        .when(text.contains("http"), "link")
        .otherwise("prose")
    )


def tokens(text: Column) -> Column:
    """Words of a text; an empty or NULL text counts one, so that every document weighs."""
    return F.greatest(F.lit(1), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0))).cast("bigint")


def described(docs: DataFrame) -> DataFrame:
    """``doc_id``, the three margins and ``tokens``; NULL margins count as empty."""
    margin = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        margin("source"),
        margin("lang"),
        topic(F.col("text")).alias("topic"),
        tokens(F.col("text")).alias("tokens"),
    )


def tempered(cells: DataFrame, margin: str, power: float = TEMPER) -> DataFrame:
    """Targets ``value``, ``share``: the margin's shares of tokens, evened out."""
    sums = cells.groupBy(F.col(margin).alias("value")).agg(
        F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("part")
    )
    total = sums.agg(F.sum("part").alias("total"))
    # One row on the right; a join without keys, but not of two tables.
    return sums.join(F.broadcast(total)).select("value", (F.col("part") / F.col("total")).alias("share"))


def rake(
    docs: DataFrame, targets: Mapping[str, DataFrame] | None = None, rounds: int = ROUNDS
) -> DataFrame:
    """One row per cell: the margins, ``tokens``, and ``weight``; weights sum to one.

    ``docs`` is as :func:`described` makes it. ``targets`` gives, per margin, a
    frame of ``value`` and ``share``; values without a target get weight zero.
    Cells can be many, so weights stay distributed: each round is three sums by
    margin, joined back, and ends in the shared folder.
    """
    cells = settle(docs.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "cells")
    targets = dict(targets or {})
    for margin in MARGINS:
        if margin not in targets:
            targets[margin] = settle(tempered(cells, margin), f"target-{margin}")
    # Each cell's targets, joined once; from then on one join per margin and round.
    state = cells.withColumn("weight", F.col("tokens").cast("double"))
    for margin in MARGINS:
        goal = targets[margin].select(F.col("value").alias(margin), F.col("share").alias(f"to_{margin}"))
        state = state.join(goal, margin, "left")
    kept = ["tokens", *(f"to_{m}" for m in MARGINS)]
    state = settle(state, "aimed")
    for _ in range(rounds):
        for margin in MARGINS:
            sums = state.groupBy(margin).agg(F.sum("weight").alias("all"))
            share = F.coalesce(F.col(f"to_{margin}"), F.lit(0.0))
            factor = F.when(F.col("all") > 0, share / F.col("all")).otherwise(0.0)
            state = state.join(sums, margin).select(
                *MARGINS, *kept, (F.col("weight") * factor).alias("weight")
            )
        state = settle(state, "raked")
    state = state.select(*MARGINS, "tokens", "weight")
    return state


def chances(cells: DataFrame, budget: float = BUDGET) -> DataFrame:
    """The margins and ``chance``: each document's probability, the same within a cell.

    Chances are proportional to weight per token. They add up to ``budget`` times
    all tokens or, where that would need a chance above one, to as many as keep
    the largest at one: nothing is cut off, so the mixture stays on target.
    """
    ratio = F.col("weight") / F.col("tokens")
    most = cells.agg(F.max(ratio).alias("most"), F.sum("tokens").alias("all"))
    scale = F.least(F.lit(budget) * F.col("all"), 1 / F.col("most"))
    return cells.join(F.broadcast(most)).select(
        *MARGINS, F.least(F.lit(1.0), scale * ratio).alias("chance")
    )


def drawn(doc_id: Column) -> Column:
    """A number in [0, 1) that depends on the id only; NULL ids draw as one."""
    text = F.concat(F.lit(SEED + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint") / (1 << 52)


def mixed(docs: DataFrame, targets: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Every document with its margins, ``tokens``, ``chance`` and whether it is ``sampled``.

    Rows that repeat an id draw alike. Empty tables give no rows.
    """
    rows = settle(described(docs), "described")
    odds = settle(chances(rake(rows, targets)), "chances")
    return rows.join(odds, list(MARGINS)).select(
        "doc_id",
        *MARGINS,
        "tokens",
        F.round("chance", 6).alias("chance"),
        (drawn(F.col("doc_id")) < F.col("chance")).alias("sampled"),
    )


def sample(docs: DataFrame, targets: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The sampled rows of ``docs``, all columns as they are."""
    odds = settle(chances(rake(settle(described(docs), "described"), targets)), "chances")
    odds = odds.select(*[F.col(m).alias(f"__{m}") for m in MARGINS], F.col("chance").alias("__chance"))
    margin = lambda c: F.coalesce(docs[c].cast("string"), F.lit(""))
    same = (
        (margin("source") == odds["__source"])
        & (margin("lang") == odds["__lang"])
        & (topic(docs["text"]) == odds["__topic"])
    )
    return docs.join(odds, same).where(drawn(docs["doc_id"]) < F.col("__chance")).select(
        *[docs[c] for c in docs.columns]
    )


def mixed_sql() -> str:
    """SQL for :func:`mixed` with tempered targets; one table per step."""
    steps = [
        f"""
rows AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
    CASE WHEN contains(text, '|') THEN 'table' WHEN contains(text, '@') THEN 'contact'
      WHEN contains(text, 'http') THEN 'link' ELSE 'prose' END AS topic,
    CAST(greatest(1, coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\r\\f\\x0B]+')), 0)) AS BIGINT) AS tokens
  FROM documents
)""",
        """
cells AS MATERIALIZED (
  SELECT source, lang, topic, CAST(sum(tokens) AS BIGINT) AS tokens FROM rows GROUP BY ALL
)""",
    ]
    for margin in MARGINS:
        steps.append(f"""
goal_{margin} AS MATERIALIZED (
  SELECT {margin}, part / sum(part) OVER () AS share FROM (
    SELECT {margin}, pow(CAST(sum(tokens) AS DOUBLE), {TEMPER}) AS part FROM cells GROUP BY ALL)
)""")
    before = "SELECT *, CAST(tokens AS DOUBLE) AS weight FROM cells"
    for number in range(ROUNDS * len(MARGINS)):
        margin = MARGINS[number % len(MARGINS)]
        steps.append(f"""
raked_{number} AS MATERIALIZED (
  SELECT source, lang, topic, tokens,
    weight * (share / sum(weight) OVER (PARTITION BY {margin})) AS weight
  FROM ({before}) JOIN goal_{margin} USING ({margin})
)""")
        before = f"FROM raked_{number}"
    steps.append(f"""
odds AS MATERIALIZED (
  SELECT source, lang, topic,
    least(1.0, least({BUDGET} * sum(tokens) OVER (), 1 / max(weight / tokens) OVER ())
      * (weight / tokens)) AS chance
  FROM ({before})
)""")
    return f"""WITH {",".join(steps)}
SELECT doc_id, source, lang, topic, tokens, round(chance, 6) AS chance,
  ('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13))::BIGINT
    / CAST({1 << 52} AS DOUBLE) < chance AS sampled
FROM rows JOIN odds USING (source, lang, topic)"""
