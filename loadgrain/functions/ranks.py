"""Ranks inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Slots per power of e: windows hold the values of one slot of a group, not a group.
LOG_SLOTS = 256


def _slot(value: Column) -> Column:
    """A slot number that never decreases as the value grows."""
    magnitude = F.floor(F.ln(F.abs(value)) * LOG_SLOTS) + (1 << 20)
    return (
        F.when(F.isnan(value), F.lit(1 << 42))
        .when(value == float("inf"), F.lit(1 << 41))
        .when(value == float("-inf"), F.lit(-(1 << 41)))
        .when(value > 0, magnitude)
        .when(value < 0, -magnitude)
        .otherwise(F.lit(0).cast("bigint"))
    )


def average_ranks(counts: DataFrame, by: Sequence[str], value: str, n: str) -> DataFrame:
    """``counts`` with ``rank``: that of each value in its group, the mean rank of its ties.

    ``counts`` says how often (``n``) a value occurs; a value may stand in several rows
    of a group, and must not be NULL. Slots of values are counted and chained first, then
    values inside each slot; the rows of a group never meet in one task.
    """
    keys = [F.col(k).alias(f"__k{i}") for i, k in enumerate(by)]
    names = [f"__k{i}" for i in range(len(by))]
    slotted = counts.withColumn("__slot", _slot(F.col(value)))
    slots = slotted.groupBy(*keys, F.col("__slot").alias("__at")).agg(F.sum(n).alias("__n"))
    below = F.sum("__n").over(Window.partitionBy(*names).orderBy("__at")) - F.col("__n")
    slots = slots.select(*names, "__at", below.alias("__before"))
    same = F.col("__slot") == F.col("__at")
    for key, name in zip(by, names, strict=True):
        same = same & F.col(key).eqNullSafe(F.col(name))
    inside = Window.partitionBy(*by, "__slot").orderBy(value)
    upto = F.sum(n).over(inside.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    ties = F.sum(n).over(Window.partitionBy(*by, "__slot", value))
    rank = F.col("__before") + F.col("__upto") - F.col("__ties") + (F.col("__ties") + 1) / 2
    ranked = slotted.withColumns({"__upto": upto, "__ties": ties}).join(slots, same)
    return ranked.select(*counts.columns, rank.alias("rank"), F.col("__ties").alias("ties"))
