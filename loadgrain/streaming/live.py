"""Throughput, p95 and concurrency of a run while it goes on.

Streams add increments: what each batch holds of each bucket. Nothing is kept as
state and there is no watermark, so late samples count as any others, and
reading gives every bucket, also those still open.

Increments are kept by stream and span of batches. Ten spans of one tier fold into
one of the next, so that however long streams run, few folders are left. A span
counts once it is whole, and then stands for all shorter ones inside it: a batch that
is repeated replaces its increments, or adds nothing if a longer span has them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loadgrain.functions.numbers import int_half_even, round_half_up
from loadgrain.functions.percentiles import SKETCH_K, grouped_percentiles
from loadgrain.functions.timebuckets import time_bucket
from loadgrain.operators.timeline import value_of
from loadgrain.streaming.ingest import stream_name

COUNTS = "bucket timestamp, role string, value double, n bigint"
SKETCHES = "bucket timestamp, reqs bigint, sketch binary, timed bigint, vus double"
#: So many spans of a tier make one of the next.
FOLD = 10


def value_counts(samples: DataFrame, width: str = "5 seconds") -> DataFrame:
    """How often each value occurred per bucket and role; keeps results exact."""
    metric = F.col("metric_name")
    role = (
        F.when(metric == "http_reqs", "request")
        .when(metric == "http_req_duration", "duration")
        .when(metric == "vus", "users")
        .otherwise("other")
    )
    kept = F.when(metric.isin("http_req_duration", "vus"), F.col("value"))
    return samples.groupBy(
        time_bucket(width).cast("timestamp").alias("bucket"), role.alias("role"), kept.alias("value")
    ).agg(F.count("*").alias("n"))


def bucket_sketches(samples: DataFrame, width: str = "5 seconds") -> DataFrame:
    """Per bucket: requests, a KLL sketch of durations, and users, for dashboards."""
    ms = value_of("http_req_duration")
    return samples.groupBy(time_bucket(width).cast("timestamp").alias("bucket")).agg(
        F.count(value_of("http_reqs")).alias("reqs"),
        F.kll_sketch_agg_double(ms, F.lit(SKETCH_K)).alias("sketch"),
        F.count(ms).alias("timed"),
        F.max(value_of("vus")).alias("vus"),
    )


def _folded_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy("bucket", "role", "value").agg(F.sum("n").alias("n"))


def _folded_sketches(sketches: DataFrame) -> DataFrame:
    return sketches.groupBy("bucket").agg(
        F.sum("reqs").alias("reqs"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
        F.sum("timed").alias("timed"),
        F.max("vus").alias("vus"),
    )


class Spans:
    """The folders ``stream=<name>/span=<first>-<last>`` of a live series."""

    def __init__(self, spark: SparkSession, path: str):
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self.spark, self.path = spark, path.rstrip("/")
        self.fs = self._hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def folder(self, stream: str, span: tuple[int, int]) -> str:
        return f"{self.path}/stream={stream}/span={span[0]:010d}-{span[1]:010d}"

    def _names(self, path: str, prefix: str) -> list[str]:
        folder = self._hadoop.Path(path)
        if not self.fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in self.fs.listStatus(folder)]
        return [n.removeprefix(prefix) for n in names if n.startswith(prefix)]

    def streams(self) -> list[str]:
        return self._names(self.path, "stream=")

    def whole(self, stream: str) -> list[tuple[int, int]]:
        """All spans whose writing has ended, in order, longer ones first."""
        spans = []
        for name in self._names(f"{self.path}/stream={stream}", "span="):
            first, last = map(int, name.split("-"))
            if self.fs.exists(self._hadoop.Path(self.folder(stream, (first, last)), "_SUCCESS")):
                spans.append((first, last))
        return sorted(spans, key=lambda s: (s[0], -s[1]))

    def counted(self, stream: str) -> list[tuple[int, int]]:
        """The spans that count: whole, and not inside a longer one that is."""
        counted: list[tuple[int, int]] = []
        for span in self.whole(stream):
            if not counted or span[1] > counted[-1][1]:
                counted.append(span)
        return counted

    def drop(self, stream: str, span: tuple[int, int]) -> None:
        self.fs.delete(self._hadoop.Path(self.folder(stream, span)), True)


def _folds(batch: int) -> Iterator[tuple[int, int]]:
    """The spans that end with a batch, shortest first; without the batch itself."""
    size = FOLD
    while (batch + 1) % size == 0:
        yield batch + 1 - size, batch
        size *= FOLD


Fold = Callable[[DataFrame], DataFrame]


def add_increments(spans: Spans, stream: str, batch: int, rows: DataFrame, fold: Fold) -> None:
    """Keep the increments of a batch, and fold what it completes.

    What a fold has taken the place of is deleted when the next one of its tier or
    a longer one is whole, so that a reader who has just listed it may still read it.
    """
    counted = spans.counted(stream)
    if not any(first <= batch <= last and first < last for first, last in counted):
        rows.write.mode("overwrite").parquet(spans.folder(stream, (batch, batch)))
    for first, last in _folds(batch):
        if (first, last) not in spans.whole(stream):
            parts = [s for s in spans.counted(stream) if first <= s[0] and s[1] <= last]
            folders = [spans.folder(stream, part) for part in parts]
            merged = fold(spans.spark.read.schema(rows.schema).parquet(*folders))
            merged.write.mode("overwrite").parquet(spans.folder(stream, (first, last)))
        counted = spans.counted(stream)
        for span in spans.whole(stream):
            if span not in counted and span[1] < first:
                spans.drop(stream, span)


def _start(samples, gather, fold, width, path, checkpoint, drain) -> StreamingQuery:
    spark = samples.sparkSession
    spans, stream = Spans(spark, path), stream_name(spark, checkpoint)

    def write(batch: DataFrame, number: int) -> None:
        add_increments(spans, stream, number, gather(batch, width), fold)

    trigger = {"availableNow": True} if drain else {"processingTime": "1 second"}
    started = samples.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return started.trigger(**trigger).start()


def start_value_counts(
    samples: DataFrame, path: str, checkpoint: str, width: str = "5 seconds", drain: bool = False
) -> StreamingQuery:
    """Keep value counts of a stream of samples (with ``ts``) at ``path``; exact.

    Any number of streams, each with a checkpoint of its own, may add to one path.
    ``drain`` takes in what there is and stops.
    """
    return _start(samples, value_counts, _folded_counts, width, path, checkpoint, drain)


def start_bucket_sketches(
    samples: DataFrame, path: str, checkpoint: str, width: str = "5 seconds", drain: bool = False
) -> StreamingQuery:
    """The same with sketches in place of counts: small, p95 approximate."""
    return _start(samples, bucket_sketches, _folded_sketches, width, path, checkpoint, drain)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    spans = Spans(spark, path)
    folders = [spans.folder(s, span) for s in spans.streams() for span in spans.counted(s)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def read_value_counts(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, COUNTS)


def read_bucket_sketches(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, SKETCHES)


def throughput_from_counts(counts: DataFrame, method: str = "exact") -> DataFrame:
    """The time series of a run from its value counts; exact."""
    role, n = F.col("role"), F.col("n")
    series = counts.groupBy("bucket").agg(
        F.coalesce(F.sum(F.when(role == "request", n)), F.lit(0).cast("bigint")).alias("reqs"),
        F.max(F.when(role == "users", F.col("value"))).alias("vus"),
    )
    p95 = grouped_percentiles(
        counts.where(role == "duration"), ["bucket"], {"p95_ms": 0.95}, weight="n", method=method
    )
    return _series(series.join(p95, "bucket", "left"))


def throughput_from_sketches(sketches: DataFrame) -> DataFrame:
    """The time series of a run from its sketches; p95 approximate."""
    merged = _folded_sketches(sketches)
    p95 = F.kll_sketch_get_quantile_double("sketch", F.lit(0.95))
    return _series(merged.withColumn("p95_ms", F.when(F.col("timed") > 0, p95)))


def _series(table: DataFrame) -> DataFrame:
    vus: Column = int_half_even(F.col("vus"))
    return table.select(
        "bucket", "reqs", round_half_up(F.col("p95_ms"), 1).alias("p95_ms"), vus.alias("vus")
    ).orderBy("bucket")
