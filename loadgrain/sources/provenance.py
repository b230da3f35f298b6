"""Run provenance in file footers: what it says, writing it, reading it back."""

from __future__ import annotations

import json
import socket
from datetime import UTC, datetime
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadgrain.operators.runs import RunInfo, redact_options
from loadgrain.schema import SAMPLE_COLUMNS, SCHEMA_VERSION
from loadgrain.session import configure, qualified
from loadgrain.sources import footers
from loadgrain.sources.footers import duration_text, instant_text

if TYPE_CHECKING:
    from loadgrain.sources.samples import SinkOptions

NAMESPACE = "loadgrain"

# The keys of a run's footer, after the namespace. The load
# generator's version goes under its own name, `<generator>_version`.
RUN_KEYS = (
    "schema_version",
    "test_run_id",
    "go_version",
    "os",
    "arch",
    "start_time",
    "sample_count",
    "compression",
    "row_group_size",
    "test_run_name",
    "hostname",
    "script_path",
    "end_time",
    "duration",
    "script_options",
)
OPTIONS_KEY = "script_options"


def footer_pairs(
    spark: SparkSession,
    run: RunInfo,
    options: SinkOptions,
    namespace: str = NAMESPACE,
    generator: str = "tool",
) -> dict[str, str]:
    """The run's footer, but for the sample count; script options redacted."""
    start = run.start_time or datetime.now(UTC)
    pairs = {
        "schema_version": SCHEMA_VERSION,
        "test_run_id": run.run_id,
        f"{generator}_version": run.tool_version,
        "go_version": run.runtime_version,
        "os": run.os,
        "arch": run.arch,
        "start_time": instant_text(start),
        "sample_count": "0",
        "compression": options.compression,
        "row_group_size": str(options.row_group_size),
        "test_run_name": run.run_name,
        "hostname": run.hostname or socket.gethostname(),
        "script_path": run.script_path,
    }
    if run.end_time is not None:
        pairs["end_time"] = instant_text(run.end_time)
        pairs["duration"] = duration_text(start, run.end_time)
    if run.script_options:
        given = spark.createDataFrame([(run.script_options,)], "o STRING")
        pairs[OPTIONS_KEY] = given.select(redact_options("o")).first()[0]
    return {f"{namespace}.{key}": value for key, value in pairs.items() if value}


def _closing(run: RunInfo, pairs: dict[str, str], namespace: str) -> dict[str, str]:
    """What a file needs to state its end and duration itself, where no end is given."""
    if run.end_time is not None:
        return {}
    return {"namespace": namespace, "start": pairs[f"{namespace}.start_time"]}


def write_portable_run(
    samples: DataFrame,
    run: RunInfo,
    options: SinkOptions,
    namespace: str = NAMESPACE,
    generator: str = "tool",
    single_file: bool = False,
) -> None:
    """Write one run as self-describing files in a folder, replacing it.

    Without an end in ``run``, each file states when it was closed.
    Every task writes one file; ``single_file`` gathers a small run in one.
    """
    spark = configure(samples.sparkSession)
    footers.register(spark)
    rows = samples.select(*[F.col(f"`{c}`") for c in SAMPLE_COLUMNS])
    if single_file:
        rows = rows.coalesce(1)
    pairs = footer_pairs(spark, run, options, namespace, generator)
    with footers.batches_by_rows(spark):
        (
            rows.sortWithinPartitions("metric_name", "ts_unix_nano")
            .write.format("run_file")
            .mode("overwrite")
            .option("footer", json.dumps(pairs))
            .option("count_key", f"{namespace}.sample_count")
            .option("compression", options.compression)
            .option("row_group_size", str(options.row_group_size))
            .option("page_size", str(options.page_size))
            .option("closing", json.dumps(_closing(run, pairs, namespace)))
            .save(qualified(spark, options.path))
        )


def read_footers(spark: SparkSession, *paths: str) -> DataFrame:
    """``(file, key, value)`` for every footer pair; no row data is read.

    Filters on ``file`` and ``key`` (equal, in, beginnings and ends) reach the source:
    other files are not opened.
    """
    return _of_footers(spark, "run_footer", paths)


def read_row_groups(spark: SparkSession, *paths: str) -> DataFrame:
    """``(file, row_group, n_rows, first_metric, last_metric)`` from footers and statistics."""
    return _of_footers(spark, "run_row_groups", paths)


def _of_footers(spark: SparkSession, source: str, paths) -> DataFrame:
    footers.register(spark)
    reader, paths = spark.read.format(source), [qualified(spark, p) for p in paths]
    return reader.load(paths[0]) if len(paths) == 1 else reader.load(list(paths))


def _run_key() -> Column:
    """The key after its namespace, or NULL if it is not one of a run's keys."""
    bare = F.regexp_extract("key", r"\A[A-Za-z0-9_-]+\.([a-z0-9_]+)\z", 1)
    known = bare.isin(*RUN_KEYS) | bare.rlike(r"\A[a-z0-9]+_version\z")
    return F.when(known, bare)


def run_metadata(
    spark: SparkSession, *paths: str, namespace: str | None = None, file: bool = False
) -> DataFrame:
    """A run's provenance without its (long) script options, in key order.

    Without ``namespace`` the keys of a run are known by what follows the dot.
    """
    pairs = read_footers(spark, *paths)
    if namespace is None:
        pairs = pairs.where(_run_key().isNotNull())
    else:
        pairs = pairs.where(F.col("key").startswith(f"{namespace}."))
    columns = ["file", "key", "value"] if file else ["key", "value"]
    pairs = pairs.where(~F.col("key").endswith(f".{OPTIONS_KEY}"))
    return pairs.select(*columns).orderBy(*columns[:-1])


def footer_value(spark: SparkSession, key: str, *paths: str) -> DataFrame:
    """The value of one run key (such as ``script_options``) per file."""
    pairs = read_footers(spark, *paths).where(F.col("key").endswith(f".{key}"))
    return pairs.where(_run_key() == key).select("file", "value")


def runs_from_footers(pairs: DataFrame) -> DataFrame:
    """Run records from footer pairs: one row per run, counts added up over files."""
    bare = _run_key()
    one = lambda key: F.max(F.when(F.col("bare") == key, F.col("value")))
    tool = F.col("bare").endswith("_version") & ~F.col("bare").isin("schema_version", "go_version")
    per_file = (
        pairs.withColumn("bare", bare)
        .where(F.col("bare").isNotNull())
        .groupBy("file")
        .agg(
            *[one(key).alias(key) for key in RUN_KEYS],
            F.max(F.when(tool, F.col("value"))).alias("tool_version"),
        )
    )
    same = {
        "run_name": "test_run_name",
        "schema_version": "schema_version",
        "tool_version": "tool_version",
        "runtime_version": "go_version",
        "os": "os",
        "arch": "arch",
        "hostname": "hostname",
        "script_path": "script_path",
        "compression": "compression",
        "script_options": "script_options",
    }
    return per_file.groupBy(F.col("test_run_id").alias("run_id")).agg(
        *[F.max(source).alias(name) for name, source in same.items()],
        F.min(F.col("start_time").cast("timestamp")).alias("start_time"),
        F.max(F.col("end_time").cast("timestamp")).alias("end_time"),
        F.sum(F.col("sample_count").cast("bigint")).alias("sample_count"),
        F.max(F.col("row_group_size").cast("bigint")).alias("row_group_size"),
    )


def schema_versions(spark: SparkSession, *paths: str) -> DataFrame:
    """``(file, schema_version)``; NULL for a file that names none."""
    return versions_in(read_footers(spark, *paths))


def versions_in(pairs: DataFrame) -> DataFrame:
    version = F.max(F.when(_run_key() == "schema_version", F.col("value")))
    return pairs.groupBy("file").agg(version.alias("schema_version"))


def require_schema_version(
    spark: SparkSession, *paths: str, supported: tuple[str, ...] = (SCHEMA_VERSION,)
) -> None:
    """Raise if a file was written with a schema version this package cannot read."""
    known = F.coalesce(F.col("schema_version").isin(*supported), F.lit(False))
    others = schema_versions(spark, *paths).where(~known).take(3)
    if others:
        listed = ", ".join(f"{row.file}: {row.schema_version}" for row in others)
        raise ValueError(f"unsupported schema version ({listed})")
