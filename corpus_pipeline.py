"""From raw documents to token ids: one stage after the other, each a table.

Language, quality, near-duplicates, mixture, encoding. Every stage reads what
the one before it wrote, so a lost executor costs part of a stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadgrain.llm import langid, mixing, pieces, quality, simhash
from loadgrain.llm.common import held_out, table
from loadgrain.llm.queries import tokenizer_path
from loadgrain.session import settle


#: Texts are long rows: so many go to a Python worker at a time, in place of 10 000.
BATCH_ROWS = 1000


def _long_rows(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, which ``lang`` then says; others go.

    NULL texts and texts without a letter go. Rows that repeat an id are judged each by
    its own text.
    """
    _long_rows(spark)
    return langid.keep_identified(docs, langid.fit(docs.where(~held_out())))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model takes for good text.

    NULL texts count as empty. Rows that repeat an id are judged each by its own text; of
    labels that contradict each other the good one counts.
    """
    _long_rows(spark)
    labels = table(spark, sf_dir, "labels").where(~held_out())
    return quality.keep_good(docs, quality.fit(docs.where(~held_out()), labels))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies: the one of the smallest id.

    NULL texts count as empty, which is one text; NULL ids come last.
    """
    _long_rows(spark)
    return simhash.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample on the target weights of sources, languages and topics.

    NULL sources and languages are values of their own. Rows that repeat an id draw alike.
    """
    return mixing.sample(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with proof that they decode to its text.

    A NULL text has none. Every row is encoded, whether or not it repeats an id.
    """
    _long_rows(spark)
    return pieces.encode_documents(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("language ID", language),
    ("quality classifier", good_quality),
    ("SimHash near-dedup", one_of_each),
    ("mixing", mixture),
    ("SentencePiece", encoded),
]

#: Learnt models and Hamming blocks have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), "stage")
    return docs
