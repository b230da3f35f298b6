"""Percentiles per group, with linear interpolation.

Spark's ``percentile`` is exact but keeps every distinct value of a group in one
task. Raw timings are nearly all distinct, so one large group is too much for
it. Here all rows are sorted once, by group and value, over ranges of both: a
group may span many tasks, and many groups may share one. A task reads its range
in order and picks the values at the wanted ranks of every group that lies wholly
inside. What is left of it, the groups at its two ends and those of many values, it
hands on in pieces of bounded size; counting the pieces before tells which of them
hold the wanted ranks. So rows are shuffled once, no task holds a group, and the
result is that of ``percentile``, to the last bit. There is one route for all sizes.

The method ``sketch`` is approximate: a KLL sketch per group, one pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from loadgrain.session import settle, ship_code

# The most values of a group that are kept together.
RANGE_VALUES = 100_000
# Rank error of about 0.1 % of a group's rows.
SKETCH_K = 2048

_KEY, _VALUE, _N = "__key", "__value", "__n"

# The kinds of aggregates; what is known of a stretch of a group, and how stretches
# are put together.
_KINDS = ("count", "sum", "max", "min", "avg")
_PARTS = {"rows": "sum", "count": "sum", "sum": "sum", "min": "min", "max": "max"}


@dataclass(frozen=True)
class Bound:
    """The value that lies ``z`` standard errors of its rank off a percentile.

    The number of values below the true percentile is binomial, whatever their
    distribution; the rank is that number's mean plus ``z`` deviations, rounded down.
    NULL where a group is too small to have that rank.
    """

    fraction: float
    z: float

    def spread(self) -> float:
        return self.z * (self.fraction * (1 - self.fraction)) ** 0.5


def grouped_percentiles(
    df: DataFrame,
    by: Sequence[str],
    percentiles: Mapping[str, float | Bound],
    value: str = "value",
    weight: str | None = None,
    aggs: Mapping[str, tuple[str, str]] | None = None,
    method: str = "exact",
    range_values: int = RANGE_VALUES,
) -> DataFrame:
    """One row per group of ``by``: the keys, ``aggs``, and each percentile.

    ``percentiles`` maps output names to fractions, or to bounds of such percentiles.
    NULL values do not count.
    ``weight`` names a column saying how many times a row's value occurred; it
    must not be negative. ``aggs`` maps output names to a kind (count, sum, max,
    min or avg) and the value's column, or ``*`` to count all rows; they count
    rows, whatever their weight. Keys may be of any type that can be sorted.
    """
    aggs = dict(aggs or {})
    for kind, column in aggs.values():
        if kind not in _KINDS or column not in ((value, "*") if kind == "count" else (value,)):
            raise ValueError(f"no aggregate {kind!r} of {column!r} beside percentiles of {value!r}")
    if method == "sketch":
        if weight is not None:
            raise ValueError("the sketch method takes unweighted values")
        return _sketch(df, by, percentiles, value, aggs)
    if method != "exact":
        raise ValueError(f"unknown percentile method {method!r}")

    times = F.lit(1) if weight is None else F.col(weight)
    if weight is not None:
        wrong = F.raise_error(F.lit("a percentile weight must not be negative"))
        times = F.when(times < 0, wrong.cast("bigint")).otherwise(times)
    rows = df.select(
        _key(by).alias(_KEY),
        F.col(value).cast("double").alias(_VALUE),
        F.coalesce(times.cast("bigint"), F.lit(0)).alias(_N),
    )
    picked = settle(_picked(rows, list(percentiles.values()), range_values), "picked")
    # As SQL texts: a plan takes a tenth of the calls into the JVM that way.
    columns = [
        *[f"{_KEY}.k{i} AS {_quoted(name)}" for i, name in enumerate(by)],
        *[f"{_kind(*agg)} AS {_quoted(name)}" for name, agg in aggs.items()],
        *_blended(percentiles),
    ]
    whole = picked.where("whole").selectExpr(*columns)
    return whole.unionAll(_from_pieces(picked, percentiles).selectExpr(*columns))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _kind(kind: str, column: str) -> str:
    """An aggregate from what is known of a group."""
    return "try_divide(sum, count)" if kind == "avg" else "rows" if column == "*" else kind


def _key(by: Sequence[str]) -> Column:
    """All keys in one struct: equal structs match even where a field is NULL."""
    fields = [F.col(name).alias(f"k{i}") for i, name in enumerate(by)]
    return F.struct(*fields) if fields else F.struct(F.lit(0).alias("k"))


def _sketch(df, by, percentiles, value, aggs) -> DataFrame:
    plain = {"count": F.count, "sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg}
    grouped = df.groupBy(*by).agg(
        *[plain[kind](column).alias(name) for name, (kind, column) in aggs.items()],
        F.kll_sketch_agg_double(value, SKETCH_K).alias("__s"),
        F.count(value).alias("__c"),
    )
    # An empty sketch has no quantiles to ask for.
    picked = [
        F.when(F.col("__c") > 0, F.kll_sketch_get_quantile_double("__s", F.lit(float(p)))).alias(
            name
        )
        for name, p in percentiles.items()
    ]
    return grouped.select(*[c for c in grouped.columns if c not in ("__s", "__c")], *picked)


def _position(p: float | Bound, n: str) -> str:
    """Where a percentile lies among ``n`` values in order, from 0; may be between two."""
    if isinstance(p, Bound):
        return f"floor({n} * {float(p.fraction)!r}D + sqrt(cast({n} AS double)) * {p.spread()!r}D)"
    return f"{float(p)!r}D * ({n} - 1)"


def _positions(p: float | Bound, n: np.ndarray) -> np.ndarray:
    """The same in a task; kept inside where there is no such rank."""
    if isinstance(p, Bound):
        at = np.floor(n * p.fraction + np.sqrt(n.astype(np.float64)) * p.spread())
        return np.clip(at, 0, np.maximum(n - 1, 0))
    return p * (n - 1)


def _picked(rows: DataFrame, fractions: list[float | Bound], most: int) -> DataFrame:
    """The sorted rows, gone through once.

    One row per ``whole`` group with ``lows`` and ``highs``, the values at the ranks on
    both sides of each percentile; and the other groups in pieces of up to ``most``
    ``values``, ordered by ``part`` and ``seq``, with ``upto``, the weights up to each.
    """
    # Equal values of one group may be more than a task should hold; where they
    # came from tells them apart.
    origin = F.spark_partition_id().alias("__from")
    fields = [F.col(_KEY)[f.name] for f in rows.schema[_KEY].dataType.fields]
    ranged = rows.select("*", origin).repartitionByRange(*fields, _VALUE, "__from")
    ordered = ranged.sortWithinPartitions(*fields, _VALUE).select(_KEY, _VALUE, _N)
    doubles, longs = ArrayType(DoubleType()), ArrayType(LongType())
    schema = StructType(
        [
            StructField(_KEY, rows.schema[_KEY].dataType),
            StructField("seq", IntegerType()),
            StructField("whole", BooleanType()),
            StructField("n", LongType()),
            StructField("rows", LongType()),
            StructField("count", LongType()),
            *[StructField(name, DoubleType()) for name in ("sum", "min", "max")],
            StructField("lows", doubles),
            StructField("highs", doubles),
            StructField("values", doubles),
            StructField("upto", longs),
        ]
    )

    ship_code(__name__)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _Stretches(fractions, most).run(batches)

    return ordered.mapInArrow(pick, schema).withColumn("part", F.spark_partition_id())


def _changes(keys: pa.StructArray) -> np.ndarray:
    """Where a row's key differs from that of the row before; the first row does."""
    n = len(keys)
    differs = np.zeros(n, dtype=bool)
    differs[:1] = True
    for field in keys.flatten():
        one, two = field.slice(0, max(n - 1, 0)), field.slice(1)
        if pa.types.is_nested(field.type):
            unlike = np.array([a != b for a, b in zip(one.to_pylist(), two.to_pylist(), strict=True)], bool)
        else:
            unlike = pc.fill_null(pc.not_equal(one, two), False).to_numpy(zero_copy_only=False)
            if pa.types.is_floating(field.type):
                unlike = unlike & ~(np.isnan(one) & np.isnan(two))
            missing = field.is_null().to_numpy(zero_copy_only=False)
            unlike = unlike | (missing[1:] != missing[:-1])
        differs[1:] |= unlike
    return differs


class _Stretches:
    """Goes through one task's rows, which are in order of group and value."""

    def __init__(self, fractions: list[float | Bound], most: int):
        self.fractions, self.most = fractions, most
        self.seq = 0
        self.open_piece = True  # the first group may have begun in another task

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            both = batch if rest is None else pa.concat_batches([rest, batch])
            starts = np.flatnonzero(_changes(both.column(0)))
            last = int(starts[-1])
            if last:
                yield from self._groups(both.slice(0, last), starts[:-1])
            rest = both.slice(last)
            # What has come of the last group is handed on as soon as it is too much.
            while rest.num_rows > self.most:
                yield self._piece(rest.slice(0, self.most))
                rest, self.open_piece = rest.slice(self.most), True
        if rest is not None:
            yield self._piece(rest)  # it may go on in another task

    def _groups(self, rows: pa.RecordBatch, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Groups that end here: in pieces if they began before or are large, else whole."""
        ends = np.append(starts[1:], rows.num_rows)
        large = ends - starts > self.most
        large[0] |= self.open_piece
        self.open_piece = False
        for i in np.flatnonzero(large).tolist():
            for at in range(int(starts[i]), int(ends[i]), self.most):
                yield self._piece(rows.slice(at, min(self.most, int(ends[i]) - at)))
        small = np.flatnonzero(~large)
        if len(small):
            yield self._whole(rows, starts[small], ends[small])

    def _known(self, rows: pa.RecordBatch, starts: np.ndarray, ends: np.ndarray):
        """Values, weights summed up from the first row, and what is known of each stretch."""
        value = rows.column(1)
        missing = value.is_null().to_numpy(zero_copy_only=False)
        number = value.fill_null(0.0).to_numpy(zero_copy_only=False)
        upto = np.cumsum(np.where(missing, 0, rows.column(2).to_numpy()))
        nulls = np.concatenate(([0], np.cumsum(missing)))
        count = (ends - starts) - (nulls[ends] - nulls[starts])
        spans = np.ravel(np.column_stack((starts, ends)))
        padded = np.append(number, 0.0)
        with np.errstate(invalid="ignore"):  # infinities of both signs
            total = np.add.reduceat(padded, spans)[::2]
        none = count == 0
        known = [
            pa.array(ends - starts),
            pa.array(count),
            pa.array(total, mask=none),
            # NULLs come first, and NaN, the largest, last.
            pa.array(padded[ends - count], mask=none),
            pa.array(number[ends - 1], mask=none),
        ]
        return missing, number, upto, known

    def _whole(self, rows, starts, ends) -> pa.RecordBatch:
        _, number, upto, known = self._known(rows, starts, ends)
        below = np.where(starts > 0, upto[starts - 1], 0)
        n = upto[ends - 1] - below
        sides = []
        for turn in (np.floor, np.ceil):
            ranks = np.column_stack([turn(_positions(p, n)) for p in self.fractions] or [n[:0]])
            places = np.searchsorted(upto, (below[:, None] + ranks).ravel(), side="right")
            width = len(self.fractions)
            offsets = pa.array(np.arange(len(n) + 1, dtype=np.int32) * width)
            picked = pa.array(number[np.minimum(places, len(number) - 1)])
            sides.append(pa.ListArray.from_arrays(offsets, picked, mask=pa.array(n == 0)))
        nothing = len(n)
        return self._batch(
            rows.column(0).take(pa.array(starts)), True, n, known, *sides,
            pa.nulls(nothing, pa.list_(pa.float64())), pa.nulls(nothing, pa.list_(pa.int64())),
        )

    def _piece(self, rows: pa.RecordBatch) -> pa.RecordBatch:
        missing, number, upto, known = self._known(rows, np.array([0]), np.array([rows.num_rows]))
        held = ~missing
        no_side = pa.nulls(1, pa.list_(pa.float64()))
        return self._batch(
            rows.column(0).slice(0, 1), False, upto[-1:], known, no_side, no_side,
            pa.array([number[held]], pa.list_(pa.float64())),
            pa.array([upto[held]], pa.list_(pa.int64())),
        )

    def _batch(self, keys, whole, n, known, lows, highs, values, upto) -> pa.RecordBatch:
        seq = np.arange(self.seq, self.seq + len(keys), dtype=np.int32)
        self.seq += len(keys)
        names = [_KEY, "seq", "whole", "n", "rows", "count", "sum", "min", "max"]
        return pa.RecordBatch.from_arrays(
            [
                keys, pa.array(seq), pa.array(np.full(len(keys), whole)), pa.array(n), *known,
                lows, highs, values, upto,
            ],
            [*names, "lows", "highs", "values", "upto"],
        )


def _from_pieces(picked: DataFrame, percentiles: Mapping[str, float]) -> DataFrame:
    """The groups that came in pieces, in the form of those that came whole.

    Windows run over pieces, not rows. Values are read from those that hold wanted
    ranks only, and not shuffled while the list of these is small.
    """
    pieces = picked.where("NOT whole")
    ranks = [f"{turn}({_position(p, 'n')})" for turn in ("floor", "ceil") for p in percentiles.values()]
    listed = ", ".join(f"cast({rank} AS bigint)" for rank in ranks)
    wanted = f"array_distinct(array({listed}))" if ranks else "cast(array() AS array<bigint>)"
    group, ordered = f"PARTITION BY {_KEY}", f"PARTITION BY {_KEY} ORDER BY part, seq"
    counted = pieces.selectExpr(
        _KEY,
        "part",
        "seq",
        "n AS own",
        f"sum(n) OVER ({group}) AS n",
        f"sum(n) OVER ({ordered}) - n AS below",
        f"row_number() OVER ({ordered}) AS nth",
        *[f"{put}({name}) OVER ({group}) AS {name}" for name, put in _PARTS.items()],
    ).selectExpr("*", f"filter({wanted}, r -> r >= below AND r < below + own) AS held")
    counted = settle(counted, "pieces")
    # The value at a rank of a piece: the first that the weights reach beyond it.
    found = (
        counted.where("size(held) > 0")
        .selectExpr("part", "seq", "below", f"{_KEY} AS found", "explode(held) AS rank")
        .join(pieces.select("part", "seq", "values", "upto"), ["part", "seq"])
        .selectExpr(
            "found", "rank", "element_at(values, size(filter(upto, u -> u <= rank - below)) + 1) AS at"
        )
        .groupBy("found")
        .agg(F.expr("map_from_entries(collect_list(struct(rank, at))) AS ranked"))
    )
    sides = {"lows": ranks[: len(percentiles)], "highs": ranks[len(percentiles) :]}
    picks = {name: ", ".join(f"ranked[{rank}]" for rank in side) for name, side in sides.items()}
    groups = counted.where("nth = 1")
    return groups.join(found, groups[_KEY] == found["found"], "left").selectExpr(
        "*", *[f"CASE WHEN n > 0 THEN array({values}) END AS {name}" for name, values in picks.items()]
    )


def _blended(percentiles: Mapping[str, float | Bound]) -> list[str]:
    """Blend the values at the ranks on both sides of each percentile."""
    columns = []
    for i, (name, p) in enumerate(percentiles.items()):
        at, x, y = _position(p, "n"), f"lows[{i}]", f"highs[{i}]"
        if isinstance(p, Bound):
            value = f"CASE WHEN {at} >= 0 AND {at} < n THEN {x} END"
        else:
            blend = f"(ceil({at}) - {at}) * {x} + ({at} - floor({at})) * {y}"
            value = f"CASE WHEN floor({at}) = ceil({at}) OR {x} = {y} THEN {x} ELSE {blend} END"
        columns.append(f"{value} AS {_quoted(name)}")
    return columns
