"""Importance resampling towards a target distribution.

Features are hashed into a fixed number of buckets. A bucket's gain compares how
often the target and the corpus use it; a document's weight is the sum of the
gains of its features, taken from one array. Adding Gumbel noise drawn from a
hash of the id turns the highest scores into a sample without replacement.

The order is found by parallel sorting by regular sampling: every partition is
sorted by itself and written as a run; rows at regular places of the runs give
splitters; runs are cut at the splitters, and what belongs to one segment is
brought together and merged; the counts of the segments before tell the exact
rank. Segments wholly behind the sample are never moved.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadgrain.session import settle

#: Rows that a segment is meant to hold, and the most segments there are.
SEGMENT_ROWS, SEGMENTS = 4096, 4096
#: About so many rows, taken from all runs at a regular distance, give the splitters.
SAMPLES = 1 << 16
#: A run's number is above, the place in the run below this bit of ``at``.
_RUN_BITS = 33
#: Orders NULL ids behind all others.
_LAST = (1 << 63) - 1

# Words are runs of digits, letters (A-Z in lower case) and bytes beyond ASCII.
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


@dataclass(frozen=True)
class Resampling:
    """``percent`` of the documents with ``least_words`` are drawn; features are runs
    of up to ``longest_run`` words in ``buckets``; ``seed`` goes into the noise."""

    percent: int = 10
    least_words: int = 20
    longest_run: int = 1
    buckets: int = 10_000
    seed: int = 2024


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


def feature_buckets(words: list[bytes], how: Resampling) -> np.ndarray:
    """The bucket of each feature, repeats included."""
    features = list(words)
    for length in range(2, how.longest_run + 1):
        features += [b" ".join(run) for run in zip(*(words[i:] for i in range(length)), strict=False)]
    hashes = np.fromiter(map(zlib.crc32, features), np.uint32, len(features))
    return (hashes % np.uint32(how.buckets)).astype(np.int64)


def bucket_counts(texts: DataFrame, how: Resampling) -> np.ndarray:
    """How many features of all texts fall into each bucket.

    Tasks add up an array each; only ``how.buckets`` sums reach the driver.
    """

    def run(batches):
        counts = np.zeros(how.buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                at = feature_buckets(words_of(text.as_py()), how)
                counts += np.bincount(at, minlength=how.buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])

    rows = (
        texts.select(F.col("text").cast("string"))
        .mapInArrow(run, "bucket bigint, n bigint")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = np.zeros(how.buckets, dtype=np.int64)
    for row in rows:
        counts[row.bucket] = row.n
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of how much likelier the target uses a bucket, smoothed by one."""
    buckets = len(corpus)
    in_corpus, in_target = int(corpus.sum()) + buckets, int(target.sum()) + buckets
    ratios = [
        float(t + 1) * float(in_corpus) / (float(s + 1) * float(in_target))
        for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
    ]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], dtype=np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise in thousandths, from a hash of the id (nothing, for a NULL id)."""
    name = f"{seed}:" + ("" if doc_id is None else str(doc_id))
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, how: Resampling) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``fit`` (has words enough)."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            columns = [[], [], [], []]
            for doc_id, text in zip(ids, batch.column(1), strict=True):
                words = words_of(text.as_py())
                at = feature_buckets(words, how)
                weight = int(gain[at].sum())
                found = (len(at), weight, weight + noise(doc_id, how.seed), len(words) >= how.least_words)
                for column, value in zip(columns, found, strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *arrays], ["doc_id", "n_features", "weight", "score", "fit"]
            )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, n_features bigint, weight bigint, score bigint, fit boolean"
    )


def _order():
    return [F.desc("score"), F.asc_nulls_last("doc_id")]


def sorted_runs(rows: DataFrame) -> DataFrame:
    """Every partition sorted by itself, rows without words enough behind the others.

    ``at`` is the number of the run and, below it, the place in the run.
    """
    runs = rows.sortWithinPartitions(F.desc("fit"), *_order())
    return settle(runs.withColumn("at", F.monotonically_increasing_id()), "runs")


def _key(score: int, doc_id: int | None, at: int) -> tuple[int, int, int]:
    return -score, _LAST if doc_id is None else doc_id, at


def splitters(runs: DataFrame, total: int, segment_rows: int = SEGMENT_ROWS) -> list[tuple]:
    """Keys that cut the order into segments of about ``segment_rows``.

    Rows of a run are taken at a fixed distance, from a start that differs from run
    to run, so their number does not depend on how many runs there are.
    """
    segments = min(SEGMENTS, -(-total // segment_rows))
    if segments < 2:
        return []
    apart = max(1, total // SAMPLES)
    run = F.shiftrightunsigned("at", _RUN_BITS)
    place = F.col("at").bitwiseAND((1 << _RUN_BITS) - 1)
    start = F.pmod(F.xxhash64(run), F.lit(apart))
    taken = runs.where("fit").where((place + start) % apart == 0).select("score", "doc_id", "at")
    keys = sorted(_key(*row) for row in taken.collect())
    return [keys[i * len(keys) // segments] for i in range(1, segments)] if keys else []


def cut(runs: DataFrame, splits: list[tuple]) -> DataFrame:
    """``runs`` with ``segment``: how many splitters are at or before a row; NULL if not fit."""

    def assign(batches):
        for batch in batches:
            names = batch.schema.names
            score, doc_id, at, fit = (
                batch.column(names.index(n)).to_pylist() for n in ("score", "doc_id", "at", "fit")
            )
            segment = [
                bisect_right(splits, _key(s, d, a)) if f else None
                for s, d, a, f in zip(score, doc_id, at, fit, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(segment, pa.int32())], [*names, "segment"]
            )

    schema = "doc_id bigint, n_features bigint, weight bigint, score bigint, fit boolean, at bigint"
    return runs.mapInArrow(assign, f"{schema}, segment int")


def resample(
    docs: DataFrame,
    target: DataFrame,
    how: Resampling = Resampling(),
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score``, ``rank`` for every row of ``docs``.

    ``docs`` has ``doc_id`` and ``text``, ``target`` has ``text``; other columns are
    not looked at. The highest scores of the rows with words enough are drawn, ties
    to the smaller id (NULL ids last); ``rank`` counts them from 1 and is NULL for
    all other rows. NULL texts have no words, weight 0 and are never drawn; rows that
    repeat an id are rows of their own, in any order among equal scores. With an
    empty target all gains come from the corpus alone.
    """
    gain = gains(bucket_counts(docs, how), bucket_counts(target, how))
    runs = sorted_runs(scored(docs, gain, how))
    total = runs.where("fit").count()
    wanted = how.percent * total // 100
    pieces = settle(cut(runs, splitters(runs, total, segment_rows)), "segments")
    # At most SEGMENTS numbers.
    sizes = dict(pieces.where("fit").groupBy("segment").count().collect())
    offsets, before = [], 0
    for segment in sorted(sizes):
        if before < wanted:
            offsets.append((segment, before))
        before += sizes[segment]
    spark = docs.sparkSession
    offsets_frame = spark.createDataFrame(offsets, "segment int, before bigint")
    last = offsets[-1][0] if offsets else -1
    place = F.row_number().over(Window.partitionBy("segment").orderBy(*_order(), "at"))
    rank = F.col("before") + F.col("place")
    columns = ["doc_id", "n_features", "weight", "score"]
    drawn = (
        pieces.where(F.col("segment") <= last)
        .withColumn("place", place)
        .join(offsets_frame, "segment")
        .select(*columns, F.when(rank <= wanted, rank).alias("rank"))
    )
    others = pieces.where(F.col("segment").isNull() | (F.col("segment") > last))
    return drawn.unionByName(others.select(*columns, F.lit(None).cast("bigint").alias("rank")))
