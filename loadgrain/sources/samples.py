"""Reading and writing sample tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, fields, replace
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loadgrain.functions.timebuckets import sample_time, seconds
from loadgrain.operators.runs import RunInfo, run_record
from loadgrain.schema import LOAD, RUN_ID, SAMPLE_COLUMNS, SAMPLES
from loadgrain.session import configure
from loadgrain.sources.ledger import Ledger
from loadgrain.sources.versions import read_run_files

# The accepted codecs and the defaults of the sink.
CODECS = ("zstd", "snappy", "gzip", "uncompressed")
DEFAULT_CODEC = "zstd"
DEFAULT_PUSH_INTERVAL = "1s"
DEFAULT_ROW_GROUP_SIZE = 100_000
DEFAULT_PAGE_SIZE = 1 << 20


@dataclass(frozen=True)
class SinkOptions:
    """Where and how samples are written; checked before any job starts."""

    path: str = ""
    push_interval: str = DEFAULT_PUSH_INTERVAL
    compression: str = DEFAULT_CODEC
    row_group_size: int = DEFAULT_ROW_GROUP_SIZE
    page_size: int = DEFAULT_PAGE_SIZE

    def __post_init__(self) -> None:
        object.__setattr__(self, "compression", str(self.compression).lower())
        if not self.path:
            raise ValueError("no path given to write samples to")
        for name in ("row_group_size", "page_size"):
            try:
                size = int(getattr(self, name))
            except ValueError:
                raise ValueError(f"{name}: not a whole number") from None
            if size <= 0:
                raise ValueError(f"{name}: at least 1 is needed, {size} was given")
            object.__setattr__(self, name, size)
        if self.compression not in CODECS:
            raise ValueError(
                f"{self.compression!r} is no known codec; there are {', '.join(CODECS)}"
            )
        try:
            interval = seconds(self.push_interval)
        except ValueError as error:
            raise ValueError(f"push_interval: {error}") from None
        if interval <= 0:
            raise ValueError(f"push_interval: {self.push_interval} is no time span")

    @classmethod
    def layered(cls, *layers: Mapping[str, object], path: str | None = None) -> SinkOptions:
        """Options from several mappings; later ones win, and ``path`` over all."""
        merged: dict[str, object] = {}
        for layer in layers:
            merged |= layer
        if path is not None:
            merged["path"] = path
        unknown = set(merged) - {f.name for f in fields(cls)}
        if unknown:
            raise ValueError(f"unknown sink options: {', '.join(sorted(unknown))}")
        return cls(**merged)

    def at(self, path: str) -> SinkOptions:
        return replace(self, path=path)


def read_samples(
    spark: SparkSession, *paths: str, run_id: str | None = None, source_file: bool = False
) -> DataFrame:
    """The samples of one or many runs: files, run folders or whole tables.

    The schema is given, so nothing is inferred; columns an older file lacks
    are NULL. Adds ``ts`` (the sample clock in microseconds), ``run_id`` from
    the table's folders (or as given), and ``source_file`` if asked for. Loads that
    are not whole yet, or that another load stands for, are passed over. Files with a
    footer of their own are read by the schema version that it names. Several
    tables, each with run folders of its own, are read one by one and joined
    with :func:`concatenate`.
    """
    if any(_in_table(spark, path) for path in paths):
        files = _table(spark, *paths)
        for root in {path.split("/run_id=")[0] for path in paths}:
            visible = Ledger(spark, root).visible()
            if visible is not None:
                files = files.where(visible)
        source = F.col("_metadata.file_path")
    else:
        files = read_run_files(spark, *paths).withColumn("run_id", F.lit(None).cast("string"))
        source = F.col("source_file")
    extra = [sample_time().alias("ts")]
    extra.append(F.col("run_id") if run_id is None else F.lit(run_id).alias("run_id"))
    if source_file:
        extra.append(plain_path(source).alias("source_file"))
    return files.select(*[F.col(f"`{c}`") for c in SAMPLE_COLUMNS], *extra)


def _in_table(spark: SparkSession, path: str) -> bool:
    """Whether a path is a table, with run folders, or one of those; tables have no footers."""
    if "/run_id=" in path:
        return True
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if any(c in path for c in "*?[{") or not fs.exists(root) or fs.getFileStatus(root).isFile():
        return False
    entries = fs.listStatusIterator(root)
    while entries.hasNext():
        name = entries.next().getPath().getName()
        if name[0] not in "._":
            return name.startswith("run_id=")
    return True  # nothing in it yet


def _table(spark: SparkSession, *paths: str) -> DataFrame:
    """All loads of all runs, with ``run_id`` and ``load`` from their folders."""
    configure(spark)
    # Folder values are text: a run called 0815 must not turn into a number.
    schema = StructType([*SAMPLES.fields, RUN_ID, LOAD])
    reader = spark.read.schema(schema)
    roots = {path.split("/run_id=")[0] for path in paths}
    if len(roots) == 1 and all("/run_id=" in path for path in paths):
        # Single run folders of a table: their names still tell the run.
        reader = reader.option("basePath", roots.pop())
    return reader.parquet(*paths)


def plain_path(uri: Column) -> Column:
    """A local file URI as a plain path; other URIs unchanged."""
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.when(uri.startswith("file:"), F.regexp_replace(decoded, r"^file:/+", "/")).otherwise(
        uri
    )


def label_by_source(samples: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Adds ``run``: the label whose file or folder a sample was read from."""
    label = F.lit(None).cast("string")
    for name, path in labels.items():
        plain = unquote(urlparse(path).path) if path.startswith("file:") else path
        plain = plain.rstrip("/")
        source = F.col("source_file")
        label = F.coalesce(
            label, F.when((source == plain) | source.startswith(plain + "/"), F.lit(name))
        )
    return samples.withColumn("run", label)


def concatenate(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column name; missing columns are NULL."""
    whole = None
    for frame in frames:
        whole = frame if whole is None else whole.unionByName(frame, allowMissingColumns=True)
    if whole is None:
        raise ValueError("nothing to concatenate")
    return whole


def write_samples(
    samples: DataFrame,
    options: SinkOptions,
    rebalance: bool = False,
    by_metric: bool = False,
) -> None:
    """Write wide samples as a table with one folder per run.

    Runs present in ``samples`` replace all that was there of them, others stay.
    Inside a task rows are sorted by metric and time, so that row groups hold
    few metrics and scans skip the rest. ``rebalance`` shuffles towards even
    files of few runs first; use it when the rows of a run are scattered over
    many tasks. ``by_metric`` does so by run and metric, which serves large runs
    best: files then hold few metrics. Adaptive execution splits the rows of a
    dominant run or metric again.
    """
    keys = ["run_id", "metric_name"] if by_metric else ["run_id"]
    if rebalance or by_metric:
        samples = samples.hint("rebalance", *keys)
    with _replacing(samples.sparkSession, options) as load:
        write_load(samples, options, load)


@contextmanager
def _replacing(spark: SparkSession, options: SinkOptions, run_id: str | None = None) -> Iterator[str]:
    """A load that, once written, stands for all others of the runs that have it, and of ``run_id``."""
    ledger = Ledger(spark, options.path)
    ledger.clear()
    load = f"w-{uuid.uuid4().hex}"
    ledger.begin(load)
    try:
        yield load
    except BaseException:
        ledger.abandon(load)
        raise
    runs = set(ledger.runs_with(load))
    if run_id is not None:
        runs.add(ledger.run_folder(run_id))
    ledger.commit(load, {run: [x for x in ledger.loads(run) if x != load] for run in sorted(runs)})
    ledger.clear()


def write_load(samples: DataFrame, options: SinkOptions, load: str) -> None:
    """Add ``samples`` to their runs as one load.

    A load is a folder inside each run's. Written again under the same name, it
    replaces itself, so a batch that is repeated adds nothing.
    """
    rows = samples.select(*[F.col(f"`{c}`") for c in SAMPLE_COLUMNS], "run_id")
    (
        rows.withColumn(LOAD.name, F.lit(load))
        .sortWithinPartitions("run_id", "metric_name", "ts_unix_nano")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**parquet_options(options))
        .partitionBy("run_id", LOAD.name)
        .parquet(options.path)
    )


class Compaction:
    """Puts one load, sorted by metric and time, in the place of those a run has now.

    Files then hold few metrics and row groups are filled up to their cap. The loads
    are listed when this is made; what streams add from then on stays, beside the new
    load. :meth:`write` can be repeated; readers see the change with :meth:`commit`, and
    :meth:`clear` deletes what was replaced. One compaction of a run at a time.
    """

    def __init__(self, spark: SparkSession, options: SinkOptions, run_id: str | None):
        self.spark, self.options, self.run_id = spark, options, run_id
        self.ledger = Ledger(spark, options.path)
        self.ledger.clear()
        self.run = self.ledger.run_folder(run_id)
        self.loads = self.ledger.loads(self.run)
        self.load = f"c-{uuid.uuid4().hex}"

    def write(self) -> None:
        self.ledger.begin(self.load)
        mine = _table(self.spark, self.options.path).where(
            F.col("run_id").eqNullSafe(F.lit(self.run_id)) & F.col(LOAD.name).isin(self.loads)
        )
        write_load(mine.hint("rebalance", "run_id", "metric_name"), self.options, self.load)

    def commit(self) -> None:
        self.ledger.commit(self.load, {self.run: self.loads})

    def clear(self) -> None:
        self.ledger.clear()


def compact_run(spark: SparkSession, options: SinkOptions, run_id: str | None) -> None:
    """Rewrite a run that came in many loads as one; see :class:`Compaction`."""
    compaction = Compaction(spark, options, run_id)
    if compaction.loads:
        compaction.write()
        compaction.commit()
        compaction.clear()


# Columns that are looked up by value and not sorted by: a row group says of each, in a
# bloom filter, which values it may hold. Pages have their own index anyway.
LOOKED_UP = ("name", "group", "check", "url", "error", "extra_tags.key_value.value")
# A writer holds the filters and the footer of a file until it closes it, so filters are no
# larger than the rows of a group can need (some values of a map each), nor files longer.
FILTER_BYTES_PER_ROW, MAX_FILTER_BYTES, GROUPS_PER_FILE = 10, 1 << 20, 200


def parquet_options(options: SinkOptions) -> dict[str, str]:
    filter_bytes = min(MAX_FILTER_BYTES, max(512, options.row_group_size * FILTER_BYTES_PER_ROW))
    skipping = {
        "parquet.bloom.filter.adaptive.enabled": "true",
        "parquet.bloom.filter.max.bytes": str(filter_bytes),
    }
    for column in LOOKED_UP:
        skipping[f"parquet.bloom.filter.enabled#{column}"] = "true"
    return {
        "compression": options.compression,
        "parquet.block.row.count.limit": str(options.row_group_size),
        "parquet.page.size": str(options.page_size),
        "maxRecordsPerFile": str(options.row_group_size * GROUPS_PER_FILE),
        **skipping,
    }


def write_run(
    samples: DataFrame, run: RunInfo, options: SinkOptions, runs_path: str | None = None
) -> int:
    """Write one run and its record; returns the number of samples.

    Count and last sample time are observed in the write job itself.
    """
    seen = Observation()
    observed = samples.withColumn("run_id", F.lit(run.run_id)).observe(
        seen, F.count("*").alias("n"), F.max(sample_time()).alias("last")
    )
    # Also in the place of a run that has no rows any more.
    with _replacing(samples.sparkSession, options, run.run_id) as load:
        write_load(observed, options, load)
    count = seen.get["n"]
    if runs_path is not None:
        record = run_record(
            samples.sparkSession,
            run,
            count,
            options.compression,
            options.row_group_size,
            seen.get["last"],
        )
        write_runs(record, runs_path)
    return count


def write_runs(records: DataFrame, path: str) -> None:
    """Add or replace run records; one folder per run."""
    (
        records.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    from loadgrain.schema import RUNS

    configure(spark)
    return spark.read.schema(RUNS).parquet(path).select(*RUNS.fieldNames())
