"""The percentile routes against brute force, also on skewed groups."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadgrain.functions import percentiles as module
from loadgrain.functions.percentiles import grouped_percentiles
from loadgrain.functions.ranks import average_ranks

WANTED = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}


def brute(rows, weighted=False):
    groups = {}
    for key, value, *n in rows:
        if value is not None:
            groups.setdefault(key, []).extend([value] * (n[0] if weighted else 1))
    return {
        key: [float(np.quantile(values, p)) for p in WANTED.values()]
        for key, values in groups.items()
    }


def check(found, expected):
    found = {r["k"]: [r[name] for name in WANTED] for r in found.collect()}
    for key, values in found.items():
        if key not in expected:
            assert values == [None] * len(WANTED)
        else:
            np.testing.assert_allclose(values, expected[key], rtol=1e-12)
    assert set(expected) <= set(found)


def skewed(n=6000, seed=7):
    """A third of all rows under one key, a NULL key, ties, negatives and zeros."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else (None if i % 7 == 0 else f"k{i % 40}")
        value = float(rng.choice([rng.exponential(50), -rng.exponential(3), 0.0, 12.5]))
        rows.append((key, None if i % 50 == 0 else value))
    return rows


@pytest.mark.parametrize("range_values", [100_000, 3, 1])
def test_exact(spark, range_values):
    rows = skewed()
    frame = spark.createDataFrame(rows, "k string, value double")
    found = grouped_percentiles(frame, ["k"], WANTED, range_values=range_values)
    assert found.columns == ["k", *WANTED]
    check(found, brute(rows))


def test_the_built_in_gives_the_same(spark):
    frame = spark.createDataFrame(skewed(), "k string, value double").where("value IS NOT NULL")
    built_in = frame.groupBy("k").agg(F.percentile("value", F.array(*map(F.lit, WANTED.values()))))
    expected = {r[0]: r[1] for r in built_in.collect()}
    found = grouped_percentiles(frame, ["k"], WANTED, range_values=10).collect()
    assert {r.k: [r[p] for p in WANTED] for r in found} == expected


def test_rows_are_shuffled_once_by_range(spark, sf_dir, monkeypatch):
    """One scan and one range shuffle of the input; what follows reads the settled picks."""
    frame = spark.read.parquet(f"{sf_dir}/events.parquet")
    plans, real = [], module.settle

    def settled(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, label)

    monkeypatch.setattr(module, "settle", settled)
    found = grouped_percentiles(frame, ["event_type"], {"p": 0.5})
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert [p.count("events.parquet") for p in plans] == [1, 0, 0]
    assert plans[0].count("Exchange") == 1 and "Exchange rangepartitioning" in plans[0]
    # Values of pieces stay where they are while the ranks looked for are few.
    assert not any("values#" in line for p in plans for line in p.splitlines() if "Exchange" in line)


def pieces_of(spark, rows, most):
    frame = spark.createDataFrame(rows, "k string, value double").repartition(12)
    keyed = frame.select(
        module._key(["k"]).alias(module._KEY),
        F.col("value").alias(module._VALUE),
        F.lit(1).cast("bigint").alias(module._N),
    )
    return module._picked(keyed, [0.5], most).collect()


def test_a_group_spans_tasks_and_many_share_one(spark):
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        rows = [("hot", float(i % 1000)) for i in range(6000)]
        rows += [(f"k{i % 400:03}", float(i)) for i in range(6000)]
        got = pieces_of(spark, rows, 700)
        hot = [r for r in got if r[module._KEY].k0 == "hot"]
        assert len({r.part for r in hot}) > 1 and not any(r.whole for r in hot)
        assert max(len(r["values"]) for r in hot) <= 700 and sum(r.n for r in hot) == 6000
        small = [r for r in got if r.whole]
        assert len(small) > 350 and all(r["values"] is None and r.n == 15 for r in small)
        # Rows that are all alike do not gather in one task either.
        same = pieces_of(spark, [("hot", 1.5)] * 12_000, 100_000)
        assert len({r.part for r in same}) > 1 and max(r.n for r in same) <= 6000
        frame = spark.createDataFrame(rows, "k string, value double")
        check(grouped_percentiles(frame, ["k"], WANTED, range_values=700), brute(rows))
    finally:
        spark.conf.unset(setting)


def test_keys_of_all_kinds(spark):
    schema = "a double, b array<int>, c date, value double"
    nan = float("nan")
    rows = [(nan, [1], None, 1.0), (nan, [1], None, 3.0), (0.0, None, None, 5.0), (-0.0, None, None, 7.0)]
    rows += [(None, [2], None, 1.0), (None, [2, 3], None, 2.0), (nan, [1, 2], None, None)]
    found = grouped_percentiles(
        spark.createDataFrame(rows, schema), ["a", "b", "c"], {"p": 0.5}, aggs={"n": ("count", "*")}
    ).collect()
    assert sorted((str(r.a), str(r.b), r.n, r.p) for r in found) == [
        ("0.0", "None", 2, 6.0), ("None", "[2, 3]", 1, 2.0), ("None", "[2]", 1, 1.0),
        ("nan", "[1, 2]", 1, None), ("nan", "[1]", 2, 2.0),
    ]


def test_empty_input(spark):
    frame = spark.createDataFrame([], "k string, value double")
    assert grouped_percentiles(frame, ["k"], WANTED).collect() == []
    assert grouped_percentiles(frame, ["k"], {}).columns == ["k"]


def test_only_aggregates_of_the_value(spark):
    frame = spark.createDataFrame([("a", 1.0, 2.0)], "k string, value double, other double")
    for agg in (("max", "other"), ("max", "*"), ("median", "value")):
        with pytest.raises(ValueError, match="no aggregate"):
            grouped_percentiles(frame, ["k"], {"p": 0.5}, aggs={"x": agg})


def test_weights(spark):
    rng = np.random.default_rng(3)
    rows = [("ab"[i % 2], float(rng.integers(0, 300)), int(rng.integers(1, 9))) for i in range(900)]
    frame = spark.createDataFrame(rows, "k string, value double, n long")
    expected = brute(rows, weighted=True)
    check(grouped_percentiles(frame, ["k"], WANTED, weight="n"), expected)
    check(grouped_percentiles(frame, ["k"], WANTED, weight="n", range_values=5), expected)


def test_bad_weights(spark):
    frame = spark.createDataFrame([("a", 1.0, 2), ("a", 2.0, -1)], "k string, value double, n int")
    with pytest.raises(Exception, match="must not be negative"):
        grouped_percentiles(frame, ["k"], {"p": 0.5}, weight="n").collect()
    kept = frame.withColumn("n", F.when(F.col("n") > 0, F.col("n")))
    assert grouped_percentiles(kept, ["k"], {"p": 0.5}, weight="n").collect() == [("a", 1.0)]


def test_group_without_values_and_aggregates(spark):
    rows = [("a", 1.0)] * 5 + [("b", None)] * 3
    frame = spark.createDataFrame(rows, "k string, value double")
    aggs = {
        "n": ("count", "*"), "m": ("count", "value"), "top": ("max", "value"),
        "low": ("min", "value"), "all": ("sum", "value"), "mean": ("avg", "value"),
    }
    for method in ("exact", "sketch"):
        found = grouped_percentiles(frame, ["k"], {"p": 0.5}, aggs=aggs, method=method)
        assert sorted(map(tuple, found.collect())) == [
            ("a", 5, 5, 1.0, 1.0, 5.0, 1.0, 1.0), ("b", 3, 0, None, None, None, None, None),
        ]


def test_infinite_and_nan(spark):
    values = [float("-inf"), -1.0, 0.0, 2.0, 5.0, float("inf"), float("nan")] * 50
    frame = spark.createDataFrame([("a", v) for v in values], "k string, value double")
    found = grouped_percentiles(
        frame, ["k"], {"lo": 0.0, "mid": 0.5, "hi": 1.0}
    ).first()
    assert found.lo == float("-inf") and found.mid == 2.0 and math.isnan(found.hi)


def test_bounds_are_order_statistics(spark):
    rng = np.random.default_rng(5)
    sizes = {"few": 30, "some": 200, "many": 3000}
    rows = [(k, float(v)) for k, n in sizes.items() for v in rng.exponential(50, size=n)]
    frame = spark.createDataFrame(rows, "k string, value double").repartition(5)
    wanted = {"lo": module.Bound(0.95, -1.96), "p": 0.95, "hi": module.Bound(0.95, 1.96)}
    for most in (100_000, 150):
        found = {r.k: r for r in grouped_percentiles(frame, ["k"], wanted, range_values=most).collect()}
        for k, n in sizes.items():
            values = sorted(v for key, v in rows if key == k)
            off = 1.96 * (0.95 * 0.05 * n) ** 0.5
            low, high = math.floor(0.95 * n - off), math.floor(0.95 * n + off)
            assert found[k].lo == values[low]
            assert found[k].hi == (values[high] if high < n else None)
            assert found[k].p == pytest.approx(np.quantile(values, 0.95), rel=1e-12)
    # Nineteen of twenty such intervals hold the true value.
    rows = [(str(i), float(v)) for i in range(300) for v in rng.uniform(0, 100, size=400)]
    frame = spark.createDataFrame(rows, "k string, value double")
    held = grouped_percentiles(frame, ["k"], wanted).where("lo <= 95 AND hi >= 95").count()
    assert 270 <= held


def test_ranks_with_ties(spark):
    rng = np.random.default_rng(6)
    rows = [("ab"[i % 2], float(v)) for i, v in enumerate(rng.integers(-40, 40, size=400))]
    rows += [("a", v) for v in (1e-9, 2e-9, 0.0, 1e300, -1e300, float("inf"), float("nan"))] + [(None, 1.0)]
    frame = spark.createDataFrame(rows, "k string, value double")
    counts = frame.groupBy("k", "value").agg(F.count("*").alias("n"))
    got = {(r.k, str(r.value)): (r["rank"], r.ties) for r in average_ranks(counts, ["k"], "value", "n").collect()}
    for key in ("a", "b", None):
        own = sorted((v for k, v in rows if k == key), key=lambda v: (math.isnan(v), v))
        for v in own:
            places = [i + 1 for i, x in enumerate(own) if x == v or (math.isnan(x) and math.isnan(v))]
            assert got[key, str(v)] == (sum(places) / len(places), len(places))


def test_no_keys(spark):
    frame = spark.createDataFrame([(float(i),) for i in range(101)], "value double")
    assert grouped_percentiles(frame, [], {"p": 0.95}).collect() == [(95.0,)]


def test_sketch_is_close(spark):
    rows = [(("a" if i % 3 else "b"), float(i)) for i in range(30_000)] + [("c", None)]
    frame = spark.createDataFrame(rows, "k string, value double")
    found = {
        r.k: r.p95
        for r in grouped_percentiles(frame, ["k"], {"p95": 0.95}, method="sketch").collect()
    }
    assert abs(found["a"] - 28_500) < 300 and abs(found["b"] - 28_500) < 300
    assert found["c"] is None


def test_unknown_method(spark):
    frame = spark.createDataFrame([(1.0,)], "value double")
    with pytest.raises(ValueError, match="unknown percentile method"):
        grouped_percentiles(frame, [], {"p": 0.5}, method="guess")
    with pytest.raises(ValueError, match="unweighted"):
        grouped_percentiles(frame, [], {"p": 0.5}, method="sketch", weight="value")
