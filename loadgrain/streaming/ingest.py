"""Raw sample streams into sample tables."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loadgrain.functions.timebuckets import seconds
from loadgrain.operators.flatten import flatten_samples
from loadgrain.operators.runs import RunInfo, run_record, summarise_runs
from loadgrain.schema import SAMPLE_COLUMNS
from loadgrain.session import configure, qualified
from loadgrain.sources.ledger import Ledger, stream_load
from loadgrain.sources.samples import (
    SinkOptions,
    compact_run,
    read_samples,
    write_load,
    write_runs,
)


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """A checkpoint stands for one stream, which is named after it, however it is spelt."""
    return hashlib.sha256(qualified(spark, checkpoint).encode()).hexdigest()[:16]


def start_ingest(
    raw: DataFrame,
    options: SinkOptions,
    checkpoint: str,
    run_id: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Flatten a raw stream into a sample table, one folder per run.

    Stateless and without a watermark, so samples are kept however late they
    are. Runs every ``push_interval``; with ``drain`` it takes in all that has
    arrived and stops, which is also how the last samples of a run get written.
    Batches that fail are retried from the checkpoint, never dropped, and replace
    what they had written; a run that has been compacted with it since keeps its rows
    and gets none twice. Any number of streams, each with a checkpoint of its own, and
    batch jobs may write to one table.
    """
    spark = configure(raw.sparkSession)
    wide = flatten_samples(raw)
    if run_id is not None:
        wide = wide.withColumn("run_id", F.lit(run_id))
    trigger = (
        {"availableNow": True}
        if drain
        else {"processingTime": f"{round(seconds(options.push_interval) * 1000)} milliseconds"}
    )
    stream = stream_name(spark, checkpoint)
    ledger = Ledger(spark, options.path)
    first = True

    def write(batch: DataFrame, number: int) -> None:
        # Only the first batch after a start can be one that was written before.
        nonlocal first
        lacking = ledger.not_swallowed(stream, number) if first else None
        write_load(batch if lacking is None else batch.where(lacking), options, stream_load(stream, number))
        if first:
            ledger.drop_if_swallowed(stream, number)
        first = False

    return (
        wide.select(*[F.col(f"`{c}`") for c in SAMPLE_COLUMNS], "run_id")
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def finalise_run(
    spark: SparkSession, run: RunInfo, options: SinkOptions, runs_path: str
) -> DataFrame:
    """Compact a drained run and record it: its sample count and end, from its own folder."""
    compact_run(spark, options, run.run_id)
    mine = read_samples(spark, options.path).where(F.col("run_id") == run.run_id)
    found = summarise_runs(mine).first()
    count, last = (found["sample_count"], found["end_time"]) if found else (0, None)
    record = run_record(
        spark, run, count, options.compression, options.row_group_size, last
    )
    write_runs(record, runs_path)
    return record
