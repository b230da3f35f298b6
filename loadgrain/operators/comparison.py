"""One metric across several runs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadgrain.functions.numbers import round_half_up
from loadgrain.functions.percentiles import Bound, grouped_percentiles
from loadgrain.operators.latency import BY_NAME, durations
from loadgrain.operators.runs import attach_runs
from loadgrain.session import settle


def compare_runs(
    samples: DataFrame,
    run_a: str,
    run_b: str,
    by: Mapping[str, str | Column] = BY_NAME,
    run: str | Column = "run_id",
    fraction: float = 0.95,
    method: str = "exact",
    threshold_ms: float | None = None,
) -> DataFrame:
    """p95 of two runs side by side, largest slowdown first.

    ``run`` names each sample's run; a section absent from one has NULL there.
    ``threshold_ms`` keeps slowdowns above it; they are compared before rounding.
    """
    keys = {**by, "__run": run}
    rows = durations(samples, keys, "http_req_duration").where(F.col("__run").isin(run_a, run_b))
    per_run = grouped_percentiles(rows, list(keys), {"p": fraction}, method=method)
    a = F.max(F.when(F.col("__run") == run_a, F.col("p")))
    b = F.max(F.when(F.col("__run") == run_b, F.col("p")))
    table = per_run.groupBy(*by).agg(a.alias("a"), b.alias("b")).withColumn("delta", F.expr("b - a"))
    if threshold_ms is not None:
        table = table.where(F.col("delta") > threshold_ms)
    return table.select(
        *by,
        round_half_up(F.col("a"), 1).alias("a_p95_ms"),
        round_half_up(F.col("b"), 1).alias("b_p95_ms"),
        round_half_up(F.col("delta"), 1).alias("delta_ms"),
    ).orderBy(F.desc_nulls_last("delta_ms"), *[F.asc_nulls_last(k) for k in by])


def regressions(
    samples: DataFrame,
    run_a: str,
    run_b: str,
    threshold_ms: float,
    run: str | Column = "run_id",
    method: str = "exact",
) -> DataFrame:
    """Endpoints (name and method) whose p95 grew by more than the threshold."""
    by = {"section": "name", "method": "method"}
    return compare_runs(
        samples, run_a, run_b, by, run, method=method, threshold_ms=threshold_ms
    )


def regression_bounds(
    samples: DataFrame,
    run_a: str,
    run_b: str,
    by: Mapping[str, str | Column] = BY_NAME,
    run: str | Column = "run_id",
    fraction: float = 0.95,
    z: float = 1.96,
) -> DataFrame:
    """p95 of two runs with bounds, and whether the second is ``significant``ly slower.

    Bounds come from order statistics, so they hold for any distribution of durations.
    A slowdown is significant if the second run's lower bound lies above the first's
    upper one: noise of few requests is none, nor is any where a bound needs more.
    """
    keys = {**by, "__run": run}
    rows = durations(samples, keys, "http_req_duration").where(F.col("__run").isin(run_a, run_b))
    wanted = {"p": fraction, "lower": Bound(fraction, -z), "upper": Bound(fraction, z)}
    per_run = grouped_percentiles(rows, list(keys), wanted)
    of = lambda label, column: F.max(F.when(F.col("__run") == label, F.col(column)))
    table = per_run.groupBy(*by).agg(
        of(run_a, "p").alias("a"), of(run_a, "upper").alias("a_upper"),
        of(run_b, "p").alias("b"), of(run_b, "lower").alias("b_lower"),
    )
    significant = F.coalesce(F.col("b_lower") > F.col("a_upper"), F.lit(False))
    return table.select(
        *by,
        *[round_half_up(F.col(c), 1).alias(f"{c}_ms") for c in ("a", "a_upper", "b_lower", "b")],
        significant.alias("significant"),
    ).orderBy(F.desc("significant"), *[F.asc_nulls_last(k) for k in by])


def metric_history(
    samples: DataFrame,
    runs: DataFrame,
    metric: str = "http_req_duration",
    by: Mapping[str, str | Column] = BY_NAME,
    method: str = "exact",
) -> DataFrame:
    """p95 per run in order of start, with the change from the run before; unrounded.

    ``runs`` has ``run_id`` and ``start_time``. The samples are brought down to
    one settled row per run first. Runs are chained inside calendar days, and days
    by their last run, so no window holds a whole history. A run without start
    time has no run before it, nor is it the one before another.
    """
    keys = {**by, "run_id": "run_id"}
    per_run = settle(
        grouped_percentiles(
            durations(samples, keys, metric), list(keys), {"p95": 0.95}, method=method
        ),
        "per-run",
    )
    attached = attach_runs(per_run, runs.select("run_id", "start_time"))
    undated = attached.where("start_time IS NULL")
    dated = attached.where("start_time IS NOT NULL").withColumn("day", F.to_date("start_time"))
    in_day = Window.partitionBy(*by, "day").orderBy("start_time", "run_id")
    position = F.row_number().over(in_day)
    dated = dated.withColumn("in_day", F.lag("p95").over(in_day)).withColumn("nth", position)

    days = dated.groupBy(*by, "day").agg(
        F.max_by("p95", F.struct("start_time", "run_id")).alias("closing")
    )
    over_days = Window.partitionBy(*by).orderBy("day")
    days = days.select(*by, "day", F.lag("closing").over(over_days).alias("before_day"))

    same = F.lit(True)
    for key in (*by, "day"):
        same = same & F.col(f"r.{key}").eqNullSafe(F.col(f"d.{key}"))
    before = F.when(F.col("nth") == 1, F.col("before_day")).otherwise(F.col("in_day"))
    return (
        dated.alias("r")
        .join(days.alias("d"), same, "left")
        .select(
            *[F.col(f"r.{key}").alias(key) for key in by],
            "run_id",
            "start_time",
            F.col("p95").alias("p95_ms"),
            (F.col("p95") - before).alias("change_ms"),
        )
        .unionByName(
            undated.select(
                *by,
                "run_id",
                "start_time",
                F.col("p95").alias("p95_ms"),
                F.lit(None).cast("double").alias("change_ms"),
            )
        )
        .orderBy(*[F.asc_nulls_last(k) for k in by], "start_time", "run_id")
    )
