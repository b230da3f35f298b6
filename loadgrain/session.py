"""Session settings and the shared scratch folder."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# UTC keeps bucket edges independent of the driver's zone; nanosecond columns
# are read as BIGINT because Spark has no such timestamp; INT96 (Spark's
# default on write) carries no logical type.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that reading and writing samples rely on."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, name: str = "loadgrain") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme; a bare one belongs to Spark's default file system."""
    plain = spark._jvm.org.apache.hadoop.fs.Path(path)
    return plain.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(plain).toString()


def ship_code(*modules: str) -> None:
    """Send the code of these modules along with what tasks are to run.

    Workers then need not have the package installed.
    """
    from pyspark import cloudpickle

    for module in modules:
        cloudpickle.register_pickle_by_value(sys.modules[module])


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, whose
    executors share the driver's disk, may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(tempfile.mkdtemp(prefix="loadgrain-"))
        root = context.getCheckpointDir().removeprefix("file:")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage at a point that survives lost executors, and it gives
    the planner a true size: joins against a settled frame are broadcast only
    while its files stay under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
