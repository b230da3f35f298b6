"""The operators over the given tables, and SQL for those SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadgrain.llm import (
    chats,
    hard_negatives,
    jaccard,
    langid,
    licenses,
    mixing,
    neighbours,
    pieces,
    quality,
    records,
    resampling,
    simhash,
    sketches,
)
from loadgrain.llm.common import held_out, table
from loadgrain.session import scratch_path

QUERIES = {}
ORACLES = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_chat_formatting(spark, sf_dir):
    return chats.render(table(spark, sf_dir, "conversations"))


ORACLES["op1_chat_formatting"] = chats.RENDERED_SQL


@query
def op2_mixing_to_target_weights(spark, sf_dir):
    return mixing.mixed(table(spark, sf_dir, "documents"))


ORACLES["op2_mixing_to_target_weights"] = mixing.mixed_sql()


@query
def op3_simhash_near_dedup(spark, sf_dir):
    return simhash.fingerprint_components(table(spark, sf_dir, "documents"))


@query
def op4_sentencepiece(spark, sf_dir, model=None):
    model = model or tokenizer_path("piece_bpe_32k.model")
    return pieces.encode_documents(table(spark, sf_dir, "documents"), model, with_ids=False)


@query
def op5_nearest_neighbours(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op6_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~held_out()))
    found = langid.predicted(model, F.col("text"))
    return docs.select("doc_id", held_out().alias("held_out"), found.alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score"
    )


@query
def op7_document_fingerprints(spark, sf_dir):
    return sketches.edit_likeness(table(spark, sf_dir, "documents"))


@query
def op8_token_records(spark, sf_dir, tokenizer=None):
    tokenizer = tokenizer or tokenizer_path("byte_bpe_50k.json")
    folder = scratch_path(spark, "token-records")
    records.write_records(table(spark, sf_dir, "documents"), tokenizer, folder)
    index = records.build_index(spark, folder)
    return index.select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op9_license_scans(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


ORACLES["op9_license_scans"] = licenses.scan_sql()


@query
def op10_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out())
    model = quality.fit(docs.where(~held_out()), labels)
    scored = docs.select(
        "doc_id",
        held_out().alias("held_out"),
        quality.score(model, F.col("text")).alias("score"),
    )
    good = F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0)
    return scored.withColumn("predicted", good)


@query
def op11_ngram_jaccard_join(spark, sf_dir):
    return jaccard.linked(table(spark, sf_dir, "documents"))


# Sets with the same n-grams are one class; links of classes are followed to their end.
ORACLES["op11_ngram_jaccard_join"] = """
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1),
            lambda i: array_to_string(w[i:i + 2], ' ')))) END AS g FROM words
), classes AS (
    SELECT min(doc_id) AS node, g, len(g) AS n FROM sets WHERE len(g) > 0 GROUP BY g
), grams AS (SELECT node, n, unnest(g) AS gram FROM classes),
links AS (
    SELECT a.node AS a, b.node AS b FROM grams a JOIN grams b ON a.gram = b.gram AND a.node <> b.node
    WHERE 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
    GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reached AS (
    SELECT node, node AS other FROM classes
    UNION SELECT r.node, l.b FROM reached r JOIN links l ON r.other = l.a
), roots AS (SELECT node, min(other) AS component_id FROM reached GROUP BY node)
SELECT s.doc_id, len(s.g) AS n_shingles, coalesce(r.component_id, s.doc_id) AS component_id
FROM sets s LEFT JOIN classes c ON s.g = c.g LEFT JOIN roots r ON c.node = r.node
"""


@query
def op12_hard_negatives(spark, sf_dir):
    vec_id, label = F.col("vec_id"), F.col("label")
    own = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, own)


ORACLES["op12_hard_negatives"] = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id,
        CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
    FROM usable a JOIN usable c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank,
    n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same
    AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= 10
"""


@query
def op13_importance_resampling(spark, sf_dir):
    return resampling.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
