"""Names for ad-hoc SQL over samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadgrain.functions.timebuckets import WEEK_ORIGIN_SECONDS
from loadgrain.session import configure


def register_sql(
    spark: SparkSession, samples: DataFrame | None = None, runs: DataFrame | None = None
) -> None:
    """Temporary functions ``time_bucket``, ``round_half_up`` and ``int_half_even``,
    and the views ``samples`` and ``runs`` if given.

    The bodies are SQL expressions that the planner inlines.
    """
    configure(spark)
    origin = WEEK_ORIGIN_SECONDS * 1_000_000
    step = "unix_micros(TIMESTAMP '1970-01-01 00:00:00Z' + width)"
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION time_bucket(
          width INTERVAL DAY TO SECOND, ts TIMESTAMP)
        RETURNS TIMESTAMP
        RETURN timestamp_micros(unix_micros(ts) - pmod(unix_micros(ts) - {origin}, {step}))""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION round_half_up(x DOUBLE, digits INT)
        RETURNS DOUBLE
        RETURN round(x * power(10, digits), 0) / power(10, digits)""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION int_half_even(x DOUBLE)
        RETURNS INT RETURN CAST(rint(x) AS INT)""")
    if samples is not None:
        samples.createOrReplaceTempView("samples")
    if runs is not None:
        runs.createOrReplaceTempView("runs")
