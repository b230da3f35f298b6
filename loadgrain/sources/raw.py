"""Raw samples, or containers of them, from files; batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadgrain.operators.flatten import explode_containers
from loadgrain.schema import RAW, RAW_CONTAINERS
from loadgrain.session import configure


def read_raw(
    spark: SparkSession, path: str, fmt: str = "json", containers: bool = False
) -> DataFrame:
    """Raw samples from JSON lines or Parquet, with the fixed raw schema."""
    return _open(configure(spark).read, path, fmt, containers)


def stream_raw(
    spark: SparkSession, path: str, fmt: str = "json", containers: bool = False, **options: str
) -> DataFrame:
    """The same as an unbounded frame: files are picked up as they arrive."""
    return _open(configure(spark).readStream.options(**options), path, fmt, containers)


def _open(reader, path: str, fmt: str, containers: bool) -> DataFrame:
    frame = reader.format(fmt).schema(RAW_CONTAINERS if containers else RAW).load(path)
    return explode_containers(frame) if containers else frame
