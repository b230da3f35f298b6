"""Parquet footers as a source, and portable run files as a sink.

``run_footer`` reads the key/value pairs in file footers without touching row
data, and ``run_row_groups`` what they say of their row groups. Both list folders
inside their tasks, and look only at files and keys that filters ask for.
``run_file`` writes samples into files that carry their run's provenance
in the footer and can be read anywhere. Both are Python data sources: Spark's
own Parquet reader shows no footer pairs, and its writer takes none.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from loadgrain.session import ship_code

FOOTER_SCHEMA = "file STRING, key STRING, value STRING"
ROW_GROUP_SCHEMA = (
    "file STRING, row_group INT, n_rows BIGINT, first_metric STRING, last_metric STRING"
)
# Small enough to spread a long history over a cluster, large enough that a
# task is worth its start.
FILES_PER_TASK = 64
# Samples go to a writer in batches of so many.
BATCH_ROWS = 2000


def register(spark: SparkSession) -> None:
    """Make both formats known to the session."""
    ship_code(__name__)
    # Off by default, and then a source that takes filters is refused.
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RunFooterSource)
    spark.dataSource.register(RowGroupSource)
    spark.dataSource.register(RunFileSource)


@contextmanager
def batches_by_rows(spark: SparkSession) -> Iterator[None]:
    """Inside, Arrow batches end after a number of rows and not of bytes.

    Spark adds up the sizes of all columns after every row to keep to a number of bytes,
    which for rows of many columns takes ten times as long as writing them.
    """
    by_rows = {
        "spark.sql.execution.arrow.maxBytesPerBatch": str((1 << 31) - 1),
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
    }
    before = {key: spark.conf.get(key) for key in by_rows}
    try:
        for key, value in by_rows.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _filesystem(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        # As Spark spells local paths: not encoded.
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _parquet_files(path: str, recursive: bool = True) -> list[str]:
    """The data files under a file, folder or pattern, in name order."""
    from fnmatch import fnmatch

    from pyarrow import fs

    system, local = _filesystem(path)
    prefix = path[: len(path) - len(local)] if path.endswith(local) else ""
    local = local.rstrip("/")
    pattern = None
    if _is_pattern(local):
        pattern = local
        while _is_pattern(local):
            local = local.rsplit("/", 1)[0]
    info = system.get_file_info(local)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [prefix + info.path]
    found = []
    for entry in system.get_file_info(fs.FileSelector(local, recursive=recursive or pattern is not None)):
        inside = entry.path[len(local) :].strip("/").split("/")
        if entry.type != fs.FileType.File or any(p[0] in "._" for p in inside):
            continue
        if pattern is None:
            wanted = entry.path.endswith(".parquet")
        else:
            wanted = fnmatch(entry.path, pattern) or fnmatch(entry.path, pattern + "/*.parquet")
        if wanted:
            found.append(prefix + entry.path)
    return sorted(found)


def _is_pattern(path: str) -> bool:
    return any(c in path for c in "*?[")


def _folders_in(path: str) -> list[str]:
    """The folders directly inside one, as they are to be listed; none for files and patterns."""
    from pyarrow import fs

    system, local = _filesystem(path)
    if _is_pattern(local) or system.get_file_info(local).type != fs.FileType.Directory:
        return []
    prefix = path[: len(path) - len(local)] if path.endswith(local) else ""
    entries = system.get_file_info(fs.FileSelector(local))
    folders = [e.path for e in entries if e.type == fs.FileType.Directory]
    return sorted(prefix + f for f in folders if f.rsplit("/", 1)[-1][0] not in "._")


@dataclass
class Listing(InputPartition):
    """What a task has to list: a path, and which share of its files are the task's own."""

    path: str
    recursive: bool
    share: int = 0
    shares: int = 1

    def files(self) -> list[str]:
        return _parquet_files(self.path, self.recursive)[self.share :: self.shares]


@dataclass
class Wanted:
    """Conditions on a column that filters have asked for; all have to hold."""

    conditions: list[tuple[str, tuple]] = field(default_factory=list)

    def take(self, one: Filter) -> bool:
        """Whether the filter is one that this can see to."""
        if isinstance(one, EqualTo):
            self.conditions.append(("in", (one.value,)))
        elif isinstance(one, In):
            self.conditions.append(("in", tuple(one.value)))
        elif isinstance(one, StringStartsWith):
            self.conditions.append(("startswith", (one.value,)))
        elif isinstance(one, StringEndsWith):
            self.conditions.append(("endswith", (one.value,)))
        else:
            return isinstance(one, IsNotNull)  # neither files nor keys are NULL
        return True

    def holds(self, text: str) -> bool:
        return all(
            text in values if kind == "in" else any(getattr(text, kind)(v) for v in values)
            for kind, values in self.conditions
        )


class _FooterReader(DataSourceReader):
    """Deals folders out to tasks; files and keys that filters exclude are passed over."""

    columns = ("file", "key")

    def __init__(self, options) -> None:
        several = options.get("paths")
        self.paths = json.loads(several) if several else [options["path"]]
        self.wanted = {column: Wanted() for column in self.columns}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for one in filters:
            column = getattr(one, "attribute", ())
            if len(column) != 1 or column[0] not in self.columns or not self.wanted[column[0]].take(one):
                yield one

    def partitions(self) -> list[Listing]:
        """Folders one level down go to tasks whole; a flat folder's files are only counted."""
        found = []
        for path in self.paths:
            shares = -(-len(_parquet_files(path, recursive=False)) // FILES_PER_TASK)
            found += [Listing(path, False, share, shares) for share in range(shares)]
            found += [Listing(folder, True) for folder in _folders_in(path)]
        return found

    def _footers(self, partition: Listing):
        import pyarrow.parquet as pq

        for file in partition.files():
            if self.wanted["file"].holds(file):
                system, local = _filesystem(file)
                yield file, pq.read_metadata(local, filesystem=system)


class RunFooterReader(_FooterReader):
    def read(self, partition: Listing) -> Iterator[tuple]:
        for file, footer in self._footers(partition):
            for key, value in (footer.metadata or {}).items():
                name = key.decode("utf-8")
                if self.wanted["key"].holds(name):
                    yield file, name, value.decode("utf-8", "replace")


class RowGroupReader(_FooterReader):
    columns = ("file",)

    def read(self, partition: Listing) -> Iterator[tuple]:
        for file, footer in self._footers(partition):
            metric = footer.schema.names.index("metric_name") if "metric_name" in footer.schema.names else None
            for number in range(footer.num_row_groups):
                group = footer.row_group(number)
                known = group.column(metric).statistics if metric is not None else None
                ends = (known.min, known.max) if known is not None and known.has_min_max else (None, None)
                yield file, number, group.num_rows, *ends


class RunFooterSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "run_footer"

    def schema(self) -> str:
        return FOOTER_SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return RunFooterReader(self.options)


class RowGroupSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "run_row_groups"

    def schema(self) -> str:
        return ROW_GROUP_SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return RowGroupReader(self.options)


def instant_text(at: datetime) -> str:
    """A UTC time as RFC 3339 text, without trailing zeros in the fraction."""
    at = at.astimezone(UTC) if at.tzinfo else at.replace(tzinfo=UTC)
    fraction = f".{at.microsecond:06d}".rstrip("0").rstrip(".")
    return f"{at:%Y-%m-%dT%H:%M:%S}{fraction}Z"


def duration_text(start: datetime, end: datetime) -> str:
    """A duration as hours, minutes and seconds, e.g. ``1h2m3.5s``; or ``12ms``."""
    micros = round((end - start).total_seconds() * 1_000_000)
    if micros == 0:
        return "0s"
    sign, micros = ("-" if micros < 0 else ""), abs(micros)
    number = lambda value, unit: f"{value:.9f}".rstrip("0").rstrip(".") + unit
    if micros < 1000:
        return f"{sign}{micros}µs"
    if micros < 1_000_000:
        return sign + number(micros / 1000, "ms")
    hours, rest = divmod(micros, 3_600_000_000)
    minutes, rest = divmod(rest, 60_000_000)
    text = number(rest / 1_000_000, "s")
    if hours:
        return f"{sign}{hours}h{minutes}m{text}"
    return f"{sign}{minutes}m{text}" if minutes else sign + text


def closing_stamp(namespace: str, start: str) -> dict[str, str]:
    """End and duration of a run that ends now."""
    end = datetime.now(UTC)
    began = datetime.fromisoformat(start)
    return {
        f"{namespace}.end_time": instant_text(end),
        f"{namespace}.duration": duration_text(began, end),
    }


class RunFileSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "run_file"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return RunFileWriter(self.options, overwrite)


@dataclass
class WrittenFile(WriterCommitMessage):
    hidden: str | None
    final: str | None
    rows: int


class RunFileWriter(DataSourceArrowWriter):
    """One file per task under a hidden name; the driver publishes them all.

    A task streams its batches and holds at most one row group in memory. The
    footer counts the file's own rows; the run's total is in the runs table.
    Hidden names carry the write's id, so that what lost or repeated tasks left
    behind is found and removed when the write ends.
    """

    def __init__(self, options, overwrite: bool) -> None:
        self.path = options["path"].rstrip("/")
        self.footer = json.loads(options.get("footer", "{}"))
        self.count_key = options.get("count_key", "sample_count")
        self.codec = options.get("compression", "zstd")
        self.row_group_size = int(options.get("row_group_size", 100_000))
        self.page_size = int(options.get("page_size", 1 << 20))
        self.closing = json.loads(options.get("closing", "{}"))
        self.overwrite = overwrite
        self.write_id = uuid.uuid4().hex

    def write(self, iterator: Iterator) -> WrittenFile:
        import pyarrow as pa
        import pyarrow.parquet as pq

        system, folder = _filesystem(self.path)
        system.create_dir(folder, recursive=True)
        name = f"part-{self.write_id[:8]}-{uuid.uuid4().hex}.parquet"
        hidden = f"{folder}/.{self.write_id}-{name}"
        writer, rows, held, held_rows = None, 0, [], 0

        def flush(upto: int) -> None:
            nonlocal held, held_rows
            table = pa.Table.from_batches(held)
            whole = table.num_rows - table.num_rows % upto if upto else table.num_rows
            writer.write_table(table.slice(0, whole), row_group_size=self.row_group_size)
            rest = table.slice(whole)
            held, held_rows = rest.to_batches(), rest.num_rows

        try:
            for batch in iterator:
                batch = _with_nanos(batch)
                if writer is None:
                    writer = pq.ParquetWriter(
                        hidden,
                        batch.schema,
                        filesystem=system,
                        compression=None if self.codec == "uncompressed" else self.codec,
                        data_page_size=self.page_size,
                        write_page_index=True,
                    )
                rows += batch.num_rows
                held.append(batch)
                held_rows += batch.num_rows
                if held_rows >= self.row_group_size:
                    flush(self.row_group_size)
            if writer is None:
                return WrittenFile(None, None, 0)
            if held_rows:
                flush(0)
            stamp = {}
            if self.closing:
                stamp = closing_stamp(**self.closing)
            writer.add_key_value_metadata({**self.footer, **stamp, self.count_key: str(rows)})
            writer.close()
        except BaseException:
            if writer is not None:
                writer.close()
                system.delete_file(hidden)
            raise
        return WrittenFile(hidden, f"{folder}/{name}", rows)

    def commit(self, messages: list[WrittenFile | None]) -> None:
        from pyarrow import fs

        system, folder = _filesystem(self.path)
        system.create_dir(folder, recursive=True)
        older = []
        if self.overwrite:
            older = [
                entry.path
                for entry in system.get_file_info(fs.FileSelector(folder))
                if entry.base_name.endswith(".parquet") and not entry.base_name.startswith(".")
            ]
        for message in messages:
            if message is not None and message.hidden is not None:
                system.move(message.hidden, message.final)
        for path in older:
            system.delete_file(path)
        self._sweep(system, folder)

    def abort(self, messages: list[WrittenFile | None]) -> None:
        self._sweep(*_filesystem(self.path))

    def _sweep(self, system, folder: str) -> None:
        from pyarrow import fs

        for entry in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if entry.base_name.startswith(f".{self.write_id}-"):
                system.delete_file(entry.path)


def _with_nanos(batch):
    """The sample clock as the nanosecond UTC timestamp the file layout has."""
    import pyarrow as pa

    at = batch.schema.get_field_index("ts_unix_nano")
    if at < 0 or not pa.types.is_int64(batch.schema.field(at).type):
        return batch
    kind = pa.timestamp("ns", tz="UTC")
    return batch.set_column(
        at, pa.field("ts_unix_nano", kind, nullable=False), batch.column(at).cast(kind)
    )
