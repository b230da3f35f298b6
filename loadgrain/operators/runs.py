"""Run records: provenance, script options without secrets, joins on the run id."""

from __future__ import annotations

import platform
import socket
import uuid
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadgrain.schema import RUNS, SCHEMA_VERSION

# The script options that may be recorded. Anything else, also
# options added to the load generator later, is dropped.
RECORDED_OPTIONS = (
    "vus",
    "duration",
    "iterations",
    "stages",
    "scenarios",
    "thresholds",
    "tags",
    "systemTags",
    "summaryTrendStats",
    "summaryTimeUnit",
)


def redact_options(options: str | Column) -> Column:
    """Script options (JSON object) cut down to the recorded keys, sorted by key.

    Values keep their nesting. NULL where the text is no JSON object.
    """
    text = F.col(options) if isinstance(options, str) else options
    fields = ", ".join(f"`{key}` VARIANT" for key in sorted(RECORDED_OPTIONS))
    kind = F.schema_of_variant(F.try_parse_json(text))
    return F.when(kind.startswith("OBJECT"), F.to_json(F.from_json(text, fields)))


@dataclass(frozen=True)
class RunInfo:
    """What is known about one run when its samples are written."""

    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    run_name: str | None = None
    tool_version: str = "unknown"
    runtime_version: str = field(default_factory=platform.python_version)
    os: str = field(default_factory=lambda: platform.system().lower())
    arch: str = field(default_factory=platform.machine)
    hostname: str | None = None
    script_path: str | None = None
    start_time: datetime | None = None
    end_time: datetime | None = None
    script_options: str | None = None


def run_record(
    spark: SparkSession,
    run: RunInfo,
    sample_count: int,
    compression: str,
    row_group_size: int,
    end_time: datetime | None = None,
) -> DataFrame:
    """The run's row of the ``runs`` table, its script options redacted."""
    values = {
        "run_id": run.run_id,
        "run_name": run.run_name,
        "schema_version": SCHEMA_VERSION,
        "tool_version": run.tool_version,
        "runtime_version": run.runtime_version,
        "os": run.os,
        "arch": run.arch,
        "hostname": run.hostname or socket.gethostname(),
        "script_path": run.script_path,
        "start_time": run.start_time or datetime.now(UTC),
        "end_time": run.end_time or end_time,
        "sample_count": sample_count,
        "compression": compression,
        "row_group_size": row_group_size,
        "script_options": run.script_options,
    }
    row = spark.createDataFrame([tuple(values[f.name] for f in RUNS)], RUNS)
    return row.withColumn("script_options", redact_options("script_options"))


def summarise_runs(samples: DataFrame) -> DataFrame:
    """Sample count, first and last sample time of every run in a sample table."""
    clock = lambda c: F.timestamp_micros(F.call_function("div", c, F.lit(1000)))
    return samples.groupBy("run_id").agg(
        F.count("*").alias("sample_count"),
        clock(F.min("ts_unix_nano")).alias("start_time"),
        clock(F.max("ts_unix_nano")).alias("end_time"),
    )


def with_duration(runs: DataFrame) -> DataFrame:
    """Adds how long each run took, as an interval; NULL while it is open."""
    return runs.withColumn("duration", F.col("end_time") - F.col("start_time"))


def attach_runs(samples: DataFrame, runs: DataFrame) -> DataFrame:
    """Run attributes next to each sample; samples of unknown runs are kept.

    A ``runs`` table read from files is broadcast while its files are small; a
    long history is joined by shuffle, where adaptive execution splits the
    partition of a run that holds much of the data. Of several records of a run
    the greatest, column by column, counts: no sample comes out twice.
    """
    others = [c for c in runs.columns if c != "run_id"]
    single = runs.groupBy("run_id").agg(F.max(F.struct(*others)).alias("__run"))
    return samples.join(single.select("run_id", "__run.*"), "run_id", "left")


def join_external(runs: DataFrame, external: DataFrame, run_key: str = "run_id") -> DataFrame:
    """Runs with an outside table (build records, annotations) on the run id.

    Runs that the outside table does not know stay, with NULLs; a key that it repeats
    gives its run as many rows.
    """
    renamed = external.withColumnRenamed(run_key, "run_id") if run_key != "run_id" else external
    return runs.join(renamed, "run_id", "left")
