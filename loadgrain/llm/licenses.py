"""Licence scans with a positional index of rare words, in DataFrame functions only.

Templates are short passages of licence texts. Each template word that tells
something is posted with its place. A file's rare licence words (by inverse
document frequency over the whole corpus) are looked up first: of each template as
many of the rarest as hold more weight than a match may lack, so that every match has
one of them. Where the same template stands at the same relative place for further
words, the passage is aligned; the template's key phrase must then stand there word
for word.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadgrain.session import settle

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Share of a template's weight that must be found at a place.
COVERAGE = 0.6


@dataclass(frozen=True)
class Passage:
    label: str
    text: str
    key: str  # words that must stand together, inside ``text``
    base: bool = False


# Words of well-known licences, in lower case without punctuation.
PASSAGES = (
    Passage("mit", "mit license", "mit license", base=True),
    Passage("apache", "apache license", "apache license", base=True),
    Passage("gpl", "general public license", "general public license", base=True),
    Passage("gpl-3", "gnu general public license version 3", "general public license version 3"),
    Passage("gpl-2", "gnu general public license version 2", "general public license version 2"),
    Passage("lgpl", "gnu lesser general public license", "lesser general public license"),
    Passage("apache-2", "licensed under the apache license version 2 0", "apache license version 2"),
    Passage("cc-by-nc", "licensed under cc by nc", "cc by nc"),
    Passage("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    Passage("cc-by", "creative commons attribution license", "creative commons attribution"),
    Passage("mpl", "mozilla public license version", "mozilla public license"),
    Passage(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy",
        "permission is hereby granted free of charge",
    ),
    Passage(
        "isc",
        "permission to use copy modify and or distribute this software",
        "permission to use copy modify",
    ),
    Passage(
        "bsd",
        "redistribution and use in source and binary forms with or without modification",
        "redistribution and use in source and binary forms",
    ),
    Passage(
        "unlicense",
        "free and unencumbered software released into the public domain",
        "free and unencumbered software",
    ),
)
# One of these is part of a word of every passage, but not of every key
# phrase; ``scan`` asks for one, or for a key phrase without any.
GATED = ("licens", "commons", "permission", "redistribution", "unencumbered")


def _postings(spark) -> DataFrame:
    """``word``, ``template``, ``place``, ``in_key`` for every word of every passage."""
    rows = []
    for number, passage in enumerate(PASSAGES):
        text, key = passage.text.split(), passage.key.split()
        at = next(i for i in range(len(text)) if text[i : i + len(key)] == key)
        for place, word in enumerate(text):
            rows.append((word, number, place, at <= place < at + len(key)))
    return spark.createDataFrame(rows, "word string, template int, place int, in_key boolean")


def _templates(spark) -> DataFrame:
    rows = [(i, p.label, p.base, len(p.key.split())) for i, p in enumerate(PASSAGES)]
    return spark.createDataFrame(rows, "template int, label string, base boolean, key_words int")


def _vocabulary() -> list[str]:
    return sorted({w for p in PASSAGES for w in p.text.split()})


def _may_match(text: Column) -> Column:
    """Whether a key phrase can stand in a text: true for every text with one."""
    lowered = F.lower(text)
    gate = F.lit(False)
    for word in GATED:
        gate = gate | lowered.contains(word)
    apart = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    for key in sorted({p.key for p in PASSAGES}):
        if not any(word in key for word in GATED):
            gate = gate | lowered.rlike(key.replace(" ", apart))
    return gate


def _hits(text: Column) -> Column:
    """The licence words of a text with their places; none where no key phrase can stand."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    placed = F.transform(
        words,
        lambda w, i: F.struct(F.translate(w, upper, lower).alias("word"), i.alias("pos")),
    )
    hits = F.filter(placed, lambda h: h["word"].isin(*_vocabulary()))
    return F.when(_may_match(text), hits).otherwise(F.array().cast("array<struct<word:string,pos:int>>"))


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: counts, places, labels and a score.

    ``n_words``; ``n_base``, ``first_word``, ``last_word``: number, smallest and
    largest start of the places of base phrases (NULL without any);
    ``base_labels`` and ``labels``: sorted, joined by commas; ``score``: the best
    share of a passage's weight found at one place, 1 for base phrases. A NULL
    text counts as empty. Rows that repeat an id are scanned apart.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    read = settle(
        docs.select("doc_id", text.alias("text")).select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "text",
            F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)).alias("words"),
        )
        .select(
            "row",
            "doc_id",
            F.size("words").cast("bigint").alias("n_words"),
            F.array_intersect("words", F.array(*map(F.lit, _vocabulary()))).alias("present"),
            _hits(F.col("text")).alias("hits"),
        ),
        "licence-words",
    )
    hits = read.where(F.size("hits") > 0).select("row", F.inline("hits"))

    # Rarity over the whole corpus; a small table, as large as the vocabulary.
    n = F.lit(read.count())
    frequency = (
        read.select(F.explode("present").alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    )
    postings = settle(
        _postings(spark)
        .join(frequency, "word", "left")
        .withColumn("idf", F.log((n + 1) / (F.coalesce("df", F.lit(0)) + 0.5)))
        .drop("df"),
        "postings",
    )
    weights = postings.groupBy("template").agg(F.sum("idf").alias("total"))
    templates = _templates(spark).join(weights, "template")

    # All but the rarest words, which together weigh less than a match must.
    rarer = Window.partitionBy("template").orderBy(F.desc("idf"), "word").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    spared = F.sum("idf").over(rarer) - F.sum("idf").over(Window.partitionBy("template", "word"))
    rare = postings.withColumn("spared", spared).join(weights, "template")
    rare = rare.where(F.col("spared") <= F.col("total") * (1 - COVERAGE) + 1e-9)
    start = (F.col("pos") - F.col("place")).alias("start")
    proposed = hits.join(rare.select("word", "template", "place"), "word")
    proposed = proposed.select("row", "template", start).distinct()
    posted = hits.join(postings, "word").select("row", "template", start, "idf", "in_key")
    aligned = (
        posted.join(proposed, ["row", "template", "start"])
        .groupBy("row", "template", "start")
        .agg(F.sum("idf").alias("found"), F.count_if("in_key").alias("key_found"))
        .join(templates, "template")
        .where((F.col("key_found") == F.col("key_words")) & (F.col("found") >= F.col("total") * COVERAGE))
    )
    base_start = F.when(F.col("base"), F.col("start")).cast("bigint")
    share = F.when(F.col("base"), 1.0).otherwise(
        F.least(F.lit(1.0), F.col("found") / F.col("total"))
    )
    listed = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    found = aligned.groupBy("row").agg(
        F.count(base_start).alias("n_base"),
        F.min(base_start).alias("first_word"),
        F.max(base_start).alias("last_word"),
        listed(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        listed(F.col("label")).alias("labels"),
        F.max(share).alias("score"),
    )
    return read.select("row", "doc_id", "n_words").join(found, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("bigint")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.round(F.coalesce("score", F.lit(0.0)), 6).alias("score"),
    )


def scan_sql() -> str:
    """SQL for :func:`scan`: every passage laid over every licence word of every text."""
    posted, templates = [], []
    for number, p in enumerate(PASSAGES):
        text, key = p.text.split(), p.key.split()
        at = next(i for i in range(len(text)) if text[i : i + len(key)] == key)
        templates.append(f"({number}, '{p.label}', {p.base}, {len(key)})")
        posted += [
            f"('{w}', {number}, {i}, {at <= i < at + len(key)})" for i, w in enumerate(text)
        ]
    return f"""
WITH posted(word, template, place, in_key) AS (VALUES {", ".join(posted)}),
passages(template, label, base, key_words) AS (VALUES {", ".join(templates)}),
texts AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), split AS MATERIALIZED (
  SELECT row, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '{WORD}') AS words,
    regexp_extract_all(lower(text), '{WORD}') AS folded
  FROM texts
), frequency AS (
  SELECT word, count(*) AS df FROM (SELECT row, unnest(list_distinct(folded)) AS word FROM split)
  WHERE word IN (SELECT word FROM posted) GROUP BY word
), rated AS MATERIALIZED (
  SELECT posted.*, ln(((SELECT count(*) FROM split) + 1) / (coalesce(df, 0) + 0.5::DOUBLE)) AS idf
  FROM posted LEFT JOIN frequency USING (word)
), weights AS (SELECT template, sum(idf) AS total FROM rated GROUP BY template),
hits AS (
  SELECT row, words[i] AS word, i - 1 AS pos FROM split, unnest(range(1, len(words) + 1)) AS u(i)
  WHERE words[i] IN (SELECT word FROM posted)
), laid AS MATERIALIZED (
  SELECT row, word, template, pos - place AS start, in_key, idf FROM hits JOIN rated USING (word)
), aligned AS (
  SELECT row, template, start, sum(idf) AS found, count(*) FILTER (in_key) AS keyed
  FROM laid GROUP BY row, template, start
), kept AS (
  SELECT row, label, base, start,
    CASE WHEN base THEN 1.0::DOUBLE ELSE least(1.0, found / total) END AS share
  FROM aligned JOIN passages USING (template) JOIN weights USING (template)
  WHERE keyed = key_words AND found >= total * {COVERAGE}
), summed AS (
  SELECT row, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
    max(start) FILTER (base) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
    string_agg(DISTINCT CASE WHEN base THEN label END, ',' ORDER BY CASE WHEN base THEN label END) AS base_labels,
    max(share) AS score
  FROM kept GROUP BY row
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  round(coalesce(score, 0), 6)::DOUBLE AS score
FROM split LEFT JOIN summed USING (row)"""
