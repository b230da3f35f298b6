"""Sample files of several schema versions, read as one.

A file says in its footer which version of the schema it was written with. A layout
tells how files of a version are read: their own schema, and how their rows become
samples of today. ``read_run_files`` looks the versions up first, reads the files of
each with its layout, and puts all rows together.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loadgrain.schema import SAMPLES, SCHEMA_VERSION
from loadgrain.session import configure
from loadgrain.sources import provenance


@dataclass(frozen=True)
class Layout:
    """The columns of a version's files, and what makes today's samples of their rows.

    Columns that ``upgrade`` does not give are NULL; ``source_file`` must be kept.
    """

    schema: StructType | str
    upgrade: Callable[[DataFrame], DataFrame] = lambda rows: rows


#: Layouts by schema version.
LAYOUTS: dict[str, Layout] = {SCHEMA_VERSION: Layout(SAMPLES)}


def register_layout(version: str, layout: Layout) -> None:
    """Make files of a version readable in this process."""
    LAYOUTS[version] = layout


def read_run_files(
    spark: SparkSession, *paths: str, layouts: Mapping[str, Layout] | None = None
) -> DataFrame:
    """The 26 sample columns and ``source_file``, of files of any version that has a layout.

    Files that name no version are taken for today's. Raises ValueError for a version
    without a layout, before any row is read.
    """
    configure(spark)
    layouts = {**LAYOUTS, **(layouts or {})}
    version = F.coalesce("schema_version", F.lit(SCHEMA_VERSION))
    known = provenance.schema_versions(spark, *paths).withColumn("version", version)
    # A row per version; the driver gets no files while there is one version only.
    counts = {r["version"]: r["n"] for r in known.groupBy("version").agg(F.count("*").alias("n")).collect()}
    unknown = sorted(set(counts) - set(layouts))
    if unknown:
        (one,) = known.where(F.col("version") == unknown[0]).limit(1).collect()
        raise ValueError(f"no layout for schema version {unknown[0]!r}, as of {one['file']}")
    parts = []
    for name in sorted(counts) or [SCHEMA_VERSION]:
        files = list(paths)
        if len(counts) > 1:
            files = [r["file"] for r in known.where(F.col("version") == name).collect()]
        parts.append(_read(spark, layouts[name], files))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _read(spark: SparkSession, layout: Layout, files: list[str]) -> DataFrame:
    rows = spark.read.schema(layout.schema).parquet(*files)
    rows = layout.upgrade(rows.select("*", F.col("_metadata.file_path").alias("source_file")))
    columns = [
        (F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in SAMPLES
    ]
    return rows.select(*columns, "source_file")
