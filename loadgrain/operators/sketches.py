"""Mergeable percentile sketches, kept per run for long histories.

A sketch per run and section is a few kilobytes, so percentiles over any set of
runs can be had again without going back to their samples. Approximate; the
exact operators are in :mod:`latency` and :mod:`comparison`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadgrain.functions.percentiles import SKETCH_K
from loadgrain.operators.latency import BY_NAME, durations


def latency_sketches(
    samples: DataFrame,
    by: Mapping[str, str | Column] = BY_NAME,
    metric: str = "http_req_duration",
) -> DataFrame:
    """One sketch per run and group: keys, ``run_id``, ``samples``, ``sketch``."""
    keys = {**by, "run_id": "run_id"}
    return (
        durations(samples, keys, metric)
        .where(F.col("value").isNotNull())
        .groupBy(*keys)
        .agg(
            F.count("*").alias("samples"),
            F.kll_sketch_agg_double("value", F.lit(SKETCH_K)).alias("sketch"),
        )
    )


def merged_percentiles(
    sketches: DataFrame, by: Sequence[str], percentiles: Mapping[str, float]
) -> DataFrame:
    """Percentiles per group of ``by`` over all runs whose sketches are given."""
    merged = sketches.groupBy(*by).agg(
        F.sum("samples").alias("samples"), F.kll_merge_agg_double("sketch").alias("sketch")
    )
    picked = [
        F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(name)
        for name, p in percentiles.items()
    ]
    return merged.select(*by, "samples", *picked)
