"""Every operator as a query over the given tables.

Each query takes a session and a data folder. Those that test a sink or a
stream write what Spark derives from ``events`` to the shared scratch folder
and read it back.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from loadgrain.functions.numbers import round_half_up
from loadgrain.functions.percentiles import grouped_percentiles
from loadgrain.functions.sql import register_sql
from loadgrain.functions.timebuckets import month_bucket, sample_time, time_bucket
from loadgrain.operators import comparison, flatten, latency, requests, runs, sketches, timeline
from loadgrain.plans.events import raw_from_events, runs_from_events, samples_from_events
from loadgrain.session import configure, qualified, scratch_path, settle, ship_code
from loadgrain.sources import footers, provenance
from loadgrain.sources.raw import read_raw, stream_raw
from loadgrain.sources.samples import (
    Compaction,
    SinkOptions,
    compact_run,
    concatenate,
    label_by_source,
    read_runs,
    read_samples,
    write_run,
    write_samples,
)
from loadgrain.sources.versions import Layout, register_layout
from loadgrain.streaming import ingest, live

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# A small limit, so that groups come in pieces also on small test data.
SMALL_LIMITS = {"range_values": 20}
# Where samples are written, a task makes those of so many events.
EVENTS_PER_TASK = 25_000
# Raw samples land in files of so many.
LANDING_ROWS = 40_000
START = datetime(2024, 1, 1, tzinfo=UTC)
END = datetime(2024, 1, 31, 1, 2, 3, 500000, tzinfo=UTC)


def query(function: Query) -> Query:
    """Register a query; its times come out zone-less, as the SQL side has them."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = function(configure(spark), sf_dir)
        zoned = [f.name for f in result.schema if isinstance(f.dataType, TimestampType)]
        return result.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})

    QUERIES[function.__name__] = run
    return run


def events_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def spread_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in tasks of a bounded number.

    A small file with few row groups is read in as few tasks; each event yields some 13
    samples, and a task that writes them holds or sorts them all.
    """
    events = events_of(spark, sf_dir)
    return events.repartition(max(1, -(-events.count() // EVENTS_PER_TASK)))


def samples_of(spark: SparkSession, sf_dir: str, run_by: str = "parity", spread: bool = False) -> DataFrame:
    return samples_from_events((spread_events if spread else events_of)(spark, sf_dir), run_by)


def raw_of(spark: SparkSession, sf_dir: str, spread: bool = False, **kwargs) -> DataFrame:
    return raw_from_events((spread_events if spread else events_of)(spark, sf_dir), **kwargs)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Averages differ between engines in the last bits of a double."""
    return df.withColumns({c: round_half_up(F.col(c), digits) for c in columns})


# ---- the run reports ---------------------------------------------------------


@query
def latency_percentiles(spark, sf_dir):
    return latency.latency_percentiles(samples_of(spark, sf_dir))


@query
def latency_percentiles_refined(spark, sf_dir):
    return latency.latency_percentiles(samples_of(spark, sf_dir), **SMALL_LIMITS)


@query
def latency_percentiles_by_endpoint(spark, sf_dir):
    by = {"section": "name", "method": "method", "status": "status"}
    return latency.latency_percentiles(samples_of(spark, sf_dir), by)


def _rank_ok(name: str, fraction: float):
    """Whether a value lies within 1 % of the wanted rank of its group.

    Percentiles are reported to 0.1 ms: the rank may lie anywhere between.
    """
    low = F.avg((F.col("value") < F.col(name) - 0.05).cast("int"))
    high = F.avg((F.col("value") <= F.col(name) + 0.05).cast("int"))
    return ((low <= fraction + 0.01) & (high >= fraction - 0.01)).alias(name + "_ok")


@query
def latency_sketch_rank_error(spark, sf_dir):
    samples = samples_of(spark, sf_dir)
    # Settled, because a sketch computed twice may differ.
    sketched = settle(latency.latency_percentiles(samples, method="sketch"), "sketched")
    return (
        latency.durations(samples, latency.BY_NAME, "http_req_duration")
        .join(sketched, "section")
        .groupBy("section", "samples")
        .agg(_rank_ok("p50_ms", 0.50), _rank_ok("p95_ms", 0.95), _rank_ok("p99_ms", 0.99))
    )


@query
def merged_sketch_rank_error(spark, sf_dir):
    """Sketches kept per day, merged to the whole month."""
    samples = samples_of(spark, sf_dir, run_by="day")
    kept = settle(sketches.latency_sketches(samples), "sketches")
    merged = sketches.merged_percentiles(kept, ["section"], {"p50_ms": 0.50, "p95_ms": 0.95})
    return (
        latency.durations(samples, latency.BY_NAME, "http_req_duration")
        .join(settle(merged, "merged"), "section")
        .groupBy("section", "samples")
        .agg(_rank_ok("p50_ms", 0.50), _rank_ok("p95_ms", 0.95))
    )


@query
def sql_over_samples(spark, sf_dir):
    """A question nobody prepared, asked in SQL."""
    samples = samples_of(spark, sf_dir).withColumn("ts", sample_time())
    register_sql(spark, samples)
    return spark.sql("""
        SELECT time_bucket(INTERVAL 6 HOUR, ts) AS bucket, method,
               count(*) AS failures, round_half_up(avg(value), 2) AS avg_ms,
               int_half_even(count(*) / 4) AS quarter
        FROM samples
        WHERE metric_name = 'http_req_duration' AND NOT expected_response
        GROUP BY ALL""")


@query
def p95_quick_start(spark, sf_dir):
    by = {"name": "name"}
    table = latency.p95_by(samples_of(spark, sf_dir), by, alias="p95", count_as="samples")
    return rounded(table, "p95")


@query
def p95_by_name(spark, sf_dir):
    return rounded(latency.p95_by(samples_of(spark, sf_dir), {"name": "name"}), "p95_ms")


@query
def request_phases(spark, sf_dir):
    return requests.request_phases(samples_of(spark, sf_dir))


@query
def phase_averages(spark, sf_dir):
    return rounded(requests.phase_averages(samples_of(spark, sf_dir)), "avg")


@query
def check_pass_rate(spark, sf_dir):
    return requests.check_pass_rate(samples_of(spark, sf_dir))


@query
def pass_rate_by_check(spark, sf_dir):
    return rounded(requests.pass_rate_by_check(samples_of(spark, sf_dir)), "pass_rate")


@query
def error_rate(spark, sf_dir):
    return requests.error_rate(samples_of(spark, sf_dir))


@query
def error_rate_by_method(spark, sf_dir):
    return requests.error_rate(samples_of(spark, sf_dir), by="method")


@query
def status_distribution(spark, sf_dir):
    return requests.status_distribution(samples_of(spark, sf_dir))


@query
def iteration_balance(spark, sf_dir):
    return requests.iteration_balance(samples_of(spark, sf_dir))


@query
def script_overhead(spark, sf_dir):
    return requests.script_overhead(samples_of(spark, sf_dir))


@query
def bytes_received(spark, sf_dir):
    return requests.bytes_received(samples_of(spark, sf_dir))


@query
def latency_histogram(spark, sf_dir):
    return requests.latency_histogram(samples_of(spark, sf_dir))


@query
def latency_histogram_fine(spark, sf_dir):
    """Narrow steps, with a bar of one mark for every four requests."""
    return requests.with_bars(requests.latency_histogram(samples_of(spark, sf_dir), width=5), 4)


@query
def slowest_requests(spark, sf_dir):
    return latency.slowest_requests(samples_of(spark, sf_dir))


@query
def throughput_over_time(spark, sf_dir):
    return timeline.throughput_over_time(samples_of(spark, sf_dir))


@query
def throughput_hourly(spark, sf_dir):
    return timeline.throughput_over_time(samples_of(spark, sf_dir), "1 hour")


@query
def throughput_weekly_refined(spark, sf_dir):
    return timeline.throughput_over_time(samples_of(spark, sf_dir), "7 days", **SMALL_LIMITS)


@query
def throughput_monthly(spark, sf_dir):
    return timeline.throughput_over_time(samples_of(spark, sf_dir), bucket=month_bucket(1))


@query
def compare_runs(spark, sf_dir):
    """One section is missing from run B."""
    both = samples_of(spark, sf_dir).where("NOT (run_id = 'B' AND name = 'section-12')")
    return comparison.compare_runs(both, "A", "B")


def _placed(report: DataFrame, *columns: str) -> DataFrame:
    """The place of each row in a report's order; reports are small."""
    numbered = report.select(*columns, F.monotonically_increasing_id().alias("__at"))
    return numbered.select(*columns, F.row_number().over(Window.orderBy("__at")).cast("bigint").alias("place"))


@query
def order_by_p95(spark, sf_dir):
    """Descending order."""
    return _placed(latency.latency_percentiles(samples_of(spark, sf_dir)), "section")


@query
def order_of_deltas(spark, sf_dir):
    """Descending order, NULL last."""
    both = samples_of(spark, sf_dir).where("NOT (run_id = 'B' AND name = 'section-12')")
    return _placed(comparison.compare_runs(both, "A", "B"), "section")


@query
def order_by_three_keys(spark, sf_dir):
    return _placed(requests.check_pass_rate(samples_of(spark, sf_dir)), "section", "check_name")


@query
def compare_runs_refined(spark, sf_dir):
    keys = latency.BY_NAME
    samples = samples_of(spark, sf_dir)
    rows = latency.durations(samples, {**keys, "run_id": "run_id"}, "http_req_duration")
    return rounded(
        grouped_percentiles(rows, ["section", "run_id"], {"p95": 0.95}, **SMALL_LIMITS), "p95"
    )


# ---- questions asked of a run ------------------------------------------------


@query
def tail_outliers(spark, sf_dir):
    return rounded(latency.tail_outliers(samples_of(spark, sf_dir)), "limit_ms")


@query
def regressions(spark, sf_dir):
    return comparison.regressions(samples_of(spark, sf_dir), "A", "B", threshold_ms=2.0)


@query
def status_timing(spark, sf_dir):
    return latency.status_timing(samples_of(spark, sf_dir))


@query
def status_correlation(spark, sf_dir):
    return rounded(latency.status_correlation(samples_of(spark, sf_dir)), "status_corr")


@query
def status_association(spark, sf_dir):
    return rounded(latency.status_association(samples_of(spark, sf_dir)), "h", "eta_squared")


@query
def regressions_significant(spark, sf_dir):
    """p95 of both runs with bounds; two sections of run B are made half as slow again."""
    slower = (F.col("run_id") == "B") & F.col("name").isin("section-01", "section-07")
    samples = samples_of(spark, sf_dir).withColumn("value", F.col("value") * F.when(slower, 1.5).otherwise(1.0))
    return comparison.regression_bounds(samples, "A", "B")


@query
def breach_spans(spark, sf_dir):
    """Hours in which the p95 of the last three stayed over a limit, per run."""
    return timeline.breach_spans(samples_of(spark, sf_dir), 140.0, "1 hour", buckets=3)


@query
def first_breach(spark, sf_dir):
    return timeline.first_breach(samples_of(spark, sf_dir), limit_ms=200.0, width="1 hour")


@query
def metric_history(spark, sf_dir):
    """p95 per day's run; two runs have no known start."""
    events = events_of(spark, sf_dir)
    samples = samples_from_events(events, run_by="day")
    known = runs_from_events(events).where("run_id NOT IN ('day-2024-01-05', 'day-2024-01-06')")
    history = comparison.metric_history(samples, known)
    return rounded(history, "p95_ms", "change_ms")


# ---- flattening --------------------------------------------------------------


@query
def flatten_rows(spark, sf_dir):
    """Every flattened row of the dirty raw samples, with looked-up map entries."""
    wide = flatten.flatten_samples(raw_of(spark, sf_dir, dirty=True))
    tag, meta = F.col("extra_tags"), F.col("extra_metadata")
    return wide.select(
        "event_id",
        sample_time().alias("ts"),
        "metric_name",
        "metric_type",
        "value_type",
        round_half_up(F.col("value"), 6).alias("value"),
        "scenario",
        F.col("group").alias("group_tag"),
        "name",
        "method",
        F.col("check").alias("check_name"),
        "status",
        "expected_response",
        "vu",
        "iter",
        tag["team"].alias("team"),
        tag["status"].alias("spilled_status"),
        tag["expected_response"].alias("spilled_expected"),
        F.size("extra_tags").alias("n_extra_tags"),
        meta["vu"].alias("spilled_vu"),
        meta["trace_id"].alias("trace_id"),
        F.size("extra_metadata").alias("n_extra_metadata"),
    )


@query
def flatten_edge_texts(spark, sf_dir):
    """Texts next to the border of what parses, made from each event's id."""
    n = F.col("event_id").cast("string")
    texts = {
        "plain": n,
        "plus": F.concat(F.lit("+"), n),
        "minus": F.concat(F.lit("-"), n),
        "zeros": F.concat(F.lit("000"), n),
        "blank": F.concat(F.lit(" "), n),
        "newline": F.concat(n, F.lit("\n")),
        "fraction": F.concat(n, F.lit(".0")),
        "underscore": F.concat(n, F.lit("_0")),
        "too_large": F.concat(F.lit("2147483648"), n),
        "empty": F.lit(""),
    }
    rows = spread_events(spark, sf_dir).select("event_id", "event_type", F.explode(
        F.array(*[F.struct(F.lit(k).alias("form"), v.alias("text")) for k, v in texts.items()])
    ).alias("t"))
    word = F.element_at(
        F.array(*[F.lit(w) for w in ("T", "1", "0", "False", "tRue", "n", "TRUE", "yes")]),
        (F.col("event_id") % 8 + 1).cast("int"),
    )
    raw = rows.select(
        F.lit(0).cast("bigint").alias("ts_unix_nano"),
        F.lit(1.0).alias("value"),
        F.lit(None).cast("struct<name:string,type:string,contains:string,"
                         "sub:struct<parent:string,suffix:string>>").alias("metric"),
        F.create_map(F.lit("status"), F.col("t.text"),
                     F.lit("expected_response"), word).alias("tags"),
        F.create_map(F.lit("vu"), F.col("t.text")).alias("metadata"),
        "event_id",
        F.col("t.form").alias("form"),
    )
    wide = flatten.flatten_samples(raw)
    return wide.select(
        "event_id",
        "form",
        "metric_name",
        "status",
        "vu",
        "expected_response",
        F.col("extra_tags")["status"].alias("spilled_status"),
        F.col("extra_tags")["expected_response"].alias("spilled_expected"),
        F.col("extra_metadata")["vu"].alias("spilled_vu"),
    )


@query
def submetric_split(spark, sf_dir):
    raw, parent = raw_of(spark, sf_dir), F.col("metric.name")
    suffix = F.concat(F.lit("status:"), F.col("tags")["status"])
    named = F.concat(parent, F.lit("{"), suffix, F.lit("}"))
    sub = F.struct(parent.alias("parent"), suffix.alias("suffix"))
    failed = F.col("tags")["status"] == "500"
    metric = F.when(
        failed, F.struct(named.alias("name"), F.col("metric.type").alias("type"),
                         F.col("metric.contains").alias("contains"), sub.alias("sub"))
    ).otherwise(F.col("metric"))
    wide = flatten.flatten_samples(raw.withColumn("metric", metric))
    return wide.groupBy("metric_name", "submetric_parent", "submetric_suffix").agg(
        F.count("*").alias("n")
    )


@query
def containers_exploded(spark, sf_dir):
    """Samples gathered per event into containers, and taken apart again."""
    columns = ["ts_unix_nano", "value", "metric", "tags", "metadata"]
    packed = (
        raw_of(spark, sf_dir)
        .groupBy("event_id")
        .agg(F.collect_list(F.struct(*columns)).alias("samples"))
    )
    wide = flatten.flatten_samples(flatten.explode_containers(packed))
    return wide.groupBy("metric_name").agg(
        F.count("*").alias("n"), round_half_up(F.sum("value"), 4).alias("total")
    )


@query
def unknown_labels(spark, sf_dir):
    samples = samples_of(spark, sf_dir)
    kind = F.when(F.col("event_id") % 40 == 0, "summary").otherwise(F.col("metric_type"))
    return (
        flatten.unknown_labels(samples.withColumn("metric_type", kind))
        .groupBy("metric_name", "metric_type")
        .agg(F.count("*").alias("n"))
    )


@query
def empty_batch(spark, sf_dir):
    """A batch without samples next to one with some gives no rows, and no error."""
    raw = raw_of(spark, sf_dir)
    none = raw.where("event_id < 0")
    return (
        flatten.flatten_samples(none)
        .unionByName(flatten.flatten_samples(raw))
        .groupBy("metric_name")
        .agg(F.count("*").alias("n"))
    )


@query
def custom_tag_percentiles(spark, sf_dir):
    wide = flatten.flatten_samples(raw_of(spark, sf_dir, dirty=True))
    return rounded(latency.tag_percentiles(wide, "team"), "p95_ms")


@query
def custom_tag_filter(spark, sf_dir):
    wide = flatten.flatten_samples(raw_of(spark, sf_dir, dirty=True))
    return requests.error_rate(wide.where(F.col("extra_tags")["team"] == "team-1"))


# ---- tables, files and run records -------------------------------------------


def _table_totals(samples: DataFrame, *keys: str) -> DataFrame:
    return samples.groupBy(*keys).agg(
        F.count("*").alias("n"),
        round_half_up(F.sum("value"), 4).alias("total"),
        F.min("ts").alias("first"),
        F.max("ts").alias("last"),
    )


@query
def sample_table_scan(spark, sf_dir):
    """Raw samples flattened, written as a run table, and read back."""
    path = scratch_path(spark, "table")
    write_samples(flatten.flatten_samples(raw_of(spark, sf_dir, spread=True)), SinkOptions(path))
    return _table_totals(read_samples(spark, path), "run_id", "metric_name")


@query
def sample_table_rebalanced(spark, sf_dir):
    """The same by run and metric, from tasks that each hold rows of all runs."""
    path = scratch_path(spark, "table")
    samples = samples_of(spark, sf_dir, spread=True, run_by="day")
    write_samples(samples, SinkOptions(path, compression="snappy"), rebalance=True, by_metric=True)
    kept = read_samples(spark, path).where(requests.like_request_metric())
    return _table_totals(kept, "run_id", "metric_name")


@query
def run_replaced(spark, sf_dir):
    """Writing run B again replaces it and leaves run A alone."""
    options = SinkOptions(scratch_path(spark, "table"), compression="gzip")
    samples = samples_of(spark, sf_dir, spread=True)
    write_samples(samples, options)
    write_samples(samples.where("run_id = 'B' AND metric_name = 'http_reqs'"), options)
    return _table_totals(read_samples(spark, options.path), "run_id", "metric_name")


@query
def run_replaced_by_metric(spark, sf_dir):
    """Rewriting both runs with one metric leaves nothing of the others, nor of an empty name."""
    options = SinkOptions(scratch_path(spark, "table"))
    samples = samples_of(spark, sf_dir, spread=True)
    unnamed = F.when(F.col("metric_name") != "vus", F.col("metric_name")).otherwise("")
    write_samples(samples.withColumn("metric_name", unnamed), options, by_metric=True)
    before = read_samples(spark, options.path).where("metric_name = ''")
    before = settle(_table_totals(before, "run_id", "metric_name"), "before")
    write_samples(samples.where("metric_name = 'http_reqs'"), options, by_metric=True)
    after = _table_totals(read_samples(spark, options.path), "run_id", "metric_name")
    return before.unionByName(after)


@query
def run_replaced_empty(spark, sf_dir):
    """A run written again without samples is empty; its record agrees, the other run stays."""
    options, runs_path = SinkOptions(scratch_path(spark, "table")), scratch_path(spark, "runs")
    samples = samples_of(spark, sf_dir, spread=True)
    write_samples(samples, options)
    for label in ("A", "B"):
        mine = samples.where(F.col("run_id") == label)
        if label == "B":
            mine = mine.where("value IS NULL AND value IS NOT NULL")
        write_run(mine, runs.RunInfo(run_id=label), options, runs_path)
    kept = read_samples(spark, options.path).groupBy("run_id").agg(F.count("*").alias("n"))
    recorded = read_runs(spark, runs_path).select("run_id", "sample_count")
    return recorded.join(kept, "run_id", "left").select(
        "run_id", "sample_count", F.coalesce("n", F.lit(0).cast("bigint")).alias("n")
    )


@query
def run_files_compared(spark, sf_dir):
    """Two portable runs read in one go and told apart by their files."""
    samples = samples_of(spark, sf_dir, spread=True)
    paths = {}
    for label in ("A", "B"):
        paths[label] = scratch_path(spark, f"run-{label}")
        provenance.write_portable_run(
            samples.where(F.col("run_id") == label),
            runs.RunInfo(run_id=label),
            SinkOptions(paths[label]),
        )
    both = read_samples(spark, *paths.values(), source_file=True)
    return comparison.compare_runs(label_by_source(both, paths), "A", "B", run="run")


@query
def runs_concatenated(spark, sf_dir):
    samples = samples_of(spark, sf_dir)
    older = samples.where("run_id = 'A'").drop("error_code", "check")
    return (
        concatenate([older, samples.where("run_id = 'B'")])
        .groupBy("run_id", F.col("check").alias("check_name"))
        .agg(F.count("*").alias("n"))
    )


def _portable(spark, sf_dir) -> str:
    path = scratch_path(spark, "portable")
    iterations = events_of(spark, sf_dir).count()
    run = runs.RunInfo(
        run_id="nightly-1",
        run_name="nightly",
        tool_version="1.2.3",
        runtime_version="3",
        os="linux",
        arch="amd64",
        hostname="host-1",
        script_path="checkout.js",
        start_time=START,
        end_time=END,
        script_options=f'{{"vus": 12, "tlsAuth": [{{"key": "secret"}}], "iterations": {iterations}}}',
    )
    provenance.write_portable_run(
        samples_of(spark, sf_dir, spread=True), run, SinkOptions(path, row_group_size=1000), single_file=False
    )
    return path


@query
def run_footer_pairs(spark, sf_dir):
    """Footer pairs of a run's files; counts are per file and add up."""
    pairs = provenance.run_metadata(spark, _portable(spark, sf_dir))
    counted = F.col("key").endswith("sample_count")
    text = F.max(F.when(~counted, F.col("value")))
    total = F.sum(F.when(counted, F.col("value")).cast("bigint")).cast("string")
    return pairs.groupBy("key").agg(F.coalesce(text, total).alias("value"))


@query
def run_script_options(spark, sf_dir):
    found = provenance.footer_value(spark, "script_options", _portable(spark, sf_dir))
    vus = F.get_json_object("value", "$.vus").cast("int").alias("vus")
    iterations = F.get_json_object("value", "$.iterations").cast("bigint").alias("iterations")
    return found.select("value", vus, iterations).distinct()


@query
def runs_from_footers(spark, sf_dir):
    pairs = provenance.read_footers(spark, _portable(spark, sf_dir))
    return runs.with_duration(provenance.runs_from_footers(pairs)).select(
        "run_id",
        "run_name",
        "tool_version",
        "sample_count",
        "row_group_size",
        "start_time",
        "end_time",
        F.expr("extract(DAY FROM duration)").cast("int").alias("days"),
    )


@query
def schema_version_check(spark, sf_dir):
    path = _portable(spark, sf_dir)
    provenance.require_schema_version(spark, path)
    counted = provenance.runs_from_footers(provenance.read_footers(spark, path))
    versions = provenance.schema_versions(spark, path).select("schema_version").distinct()
    return versions.join(
        counted.select("schema_version", F.col("sample_count").alias("samples")), "schema_version"
    )


# An older layout: times in milliseconds, values as text, other names.
OLDER = Layout(
    "at_ms BIGINT, metric STRING, kind STRING, amount STRING, section STRING",
    lambda rows: rows.select(
        "source_file",
        (F.col("at_ms") * 1_000_000).alias("ts_unix_nano"),
        F.col("metric").alias("metric_name"),
        F.col("kind").alias("metric_type"),
        F.col("amount").cast("double").alias("value"),
        F.col("section").alias("name"),
    ),
)


@query
def mixed_versions_read(spark, sf_dir):
    """Run A in files of an older schema version, run B in today's: read as one."""
    samples, folder = samples_of(spark, sf_dir, spread=True), scratch_path(spark, "versions")
    # Whole milliseconds, as the older layout has them.
    samples = samples.withColumn("ts_unix_nano", F.expr("ts_unix_nano div 1000000 * 1000000"))
    provenance.write_portable_run(
        samples.where("run_id = 'B'"), runs.RunInfo(run_id="B"), SinkOptions(f"{folder}/B")
    )
    older = samples.where("run_id = 'A'").select(
        F.expr("ts_unix_nano div 1000000").alias("at_ms"),
        F.col("metric_name").alias("metric"),
        F.col("metric_type").alias("kind"),
        F.col("value").cast("string").alias("amount"),
        F.col("name").alias("section"),
    )
    footers.register(spark)
    pairs = json.dumps({"loadgrain.schema_version": "0", "loadgrain.test_run_id": "A"})
    writer = older.write.format("run_file").mode("overwrite").option("footer", pairs)
    writer.option("count_key", "loadgrain.sample_count").save(qualified(spark, f"{folder}/A"))
    register_layout("0", OLDER)
    both = read_samples(spark, f"{folder}/A", f"{folder}/B")
    return both.groupBy("metric_name", "metric_type", F.col("name").alias("section")).agg(
        F.count("*").alias("n"),
        round_half_up(F.sum("value"), 4).alias("total"),
        F.min("ts").alias("first"),
        F.max("ts").alias("last"),
    )


@query
def row_groups_per_file(spark, sf_dir):
    """What footers say of the row groups of two run tables: none is over its cap."""
    path = scratch_path(spark, "table")
    samples = samples_of(spark, sf_dir, spread=True)
    for label, cap in (("A", 500), ("B", 2000)):
        mine = samples.where(F.col("run_id") == label)
        write_run(mine, runs.RunInfo(run_id=label), SinkOptions(path, row_group_size=cap))
    groups = provenance.read_row_groups(spark, path).withColumn(
        "run_id", F.regexp_extract("file", "run_id=([AB])/", 1)
    )
    cap = F.when(F.col("run_id") == "A", 500).otherwise(2000)
    # Rows are sorted by metric: the groups of one file follow each other in its order.
    in_file = Window.partitionBy("file").orderBy("row_group")
    after = F.lead("first_metric").over(in_file)
    groups = groups.withColumn("in_order", F.coalesce(F.col("last_metric") <= after, F.lit(True)))
    return groups.groupBy("run_id").agg(
        F.sum("n_rows").alias("n"),
        F.bool_and(F.col("n_rows") <= cap).alias("cap_kept"),
        F.bool_and("in_order").alias("in_order"),
        F.min("first_metric").alias("first_metric"),
        F.max("last_metric").alias("last_metric"),
    )


@query
def option_checks(spark, sf_dir):
    """What the sink says to options derived from each event, good and bad."""
    options = {
        "path": F.when(F.col("user_id") % 10 != 0, F.concat(F.lit("/runs/"), "event_type")).otherwise(""),
        "compression": F.element_at(
            F.array(*map(F.lit, ("ZSTD", "snappy", "gzip", "uncompressed", "lz4", "brotli"))),
            (F.col("event_id") % 6 + 1).cast("int"),
        ),
        "push_interval": F.concat((F.col("user_id") % 4).cast("string"), F.lit("s")),
        "row_group_size": F.floor("value").cast("string"),
        "page_size": (F.col("event_id") % 5).cast("string"),
    }
    given = events_of(spark, sf_dir).select(*[c.alias(name) for name, c in options.items()])

    ship_code(__name__, SinkOptions.__module__, time_bucket.__module__)

    def said(batches):
        for frame in batches:
            answers = []
            for row in frame.to_dict("records"):
                n = row.pop("n")
                try:
                    SinkOptions.layered(row)
                    answers.append(("accepted", n))
                except ValueError as error:
                    answers.append((str(error), n))
            yield pd.DataFrame(answers, columns=["answer", "n"])

    combinations = given.groupBy(*options).agg(F.count("*").alias("n"))
    answers = combinations.mapInPandas(said, "answer string, n bigint")
    return answers.groupBy("answer").agg(F.sum("n").alias("n"))


@query
def nanosecond_files(spark, sf_dir):
    """Portable files hold nanosecond times; reading keeps every digit."""
    path = scratch_path(spark, "nanos")
    shifted = F.col("ts_unix_nano") + F.col("event_id") % 1000
    samples = samples_of(spark, sf_dir, spread=True).withColumn("ts_unix_nano", shifted)
    provenance.write_portable_run(samples, runs.RunInfo(), SinkOptions(path))
    return (
        read_samples(spark, path)
        .select("ts_unix_nano", "ts", F.col("iter").alias("event_id"), "metric_name", "check")
    )


@query
def run_records(spark, sf_dir):
    """One run's record, its count observed while the samples are written."""
    runs_path = scratch_path(spark, "runs")
    options = SinkOptions(scratch_path(spark, "table"))
    secret = '{"vus": 3, "ext": {"apiKey": "secret"}}'
    samples = samples_of(spark, sf_dir, spread=True)
    for label in ("A", "B"):
        run = runs.RunInfo(run_id=label, start_time=START, script_options=secret)
        write_run(samples.where(F.col("run_id") == label), run, options, runs_path)
    return read_runs(spark, runs_path).select(
        "run_id", "schema_version", "sample_count", "compression", "row_group_size",
        "start_time", "end_time", "script_options",
    )


@query
def run_summaries(spark, sf_dir):
    return runs.summarise_runs(samples_of(spark, sf_dir, run_by="day"))


@query
def redacted_options(spark, sf_dir):
    """Script options, one text per event, cut down to the recorded keys."""
    text = F.format_string(
        '{"vus": %d, "tlsAuth": [{"key": "secret-%d", "password": "p"}], "stages": '
        '[{"target": %d, "duration": "1m"}], "cloud": {"token": "t%d"}, "duration": null, '
        '"ext": {"x": {"apiKey": "a"}}, "noCookiesReset": true}',
        F.col("user_id"), F.col("event_id"), F.col("event_id") % 9, F.col("event_id"),
    )
    given = F.when(F.col("event_id") % 50 == 0, "not json").otherwise(text)
    return events_of(spark, sf_dir).select(
        "event_id", runs.redact_options(given).alias("script_options")
    )


@query
def runs_attached(spark, sf_dir):
    """Samples with their run's host; the runs table misses some runs."""
    events = events_of(spark, sf_dir)
    known = runs_from_events(events).where("run_id < 'day-2024-01-25'")
    samples = samples_from_events(events, run_by="day")
    return (
        runs.attach_runs(samples, known)
        .groupBy("hostname")
        .agg(F.count("*").alias("n"), F.countDistinct("run_id").alias("runs"))
    )


@query
def runs_joined_external(spark, sf_dir):
    """Runs with an outside table: nations stand for the builds of the days."""
    summaries = runs.summarise_runs(samples_of(spark, sf_dir, run_by="day"))
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        F.format_string("day-2024-01-%02d", F.col("n_nationkey") + 1).alias("build"),
        F.col("n_name").alias("annotation"),
    )
    return runs.join_external(summaries, nations, "build").select(
        "run_id", "sample_count", "annotation"
    )


# ---- streams -----------------------------------------------------------------


def _ingested(spark, sf_dir) -> SinkOptions:
    """The raw samples of all events, taken in as a stream of files."""
    options = SinkOptions(scratch_path(spark, "streamed"))
    _stream_into(spark, raw_of(spark, sf_dir, spread=True), options, "live")
    return options


def _stream_into(spark, raw: DataFrame, options: SinkOptions, run_id: str) -> None:
    _arriving(spark, raw, options, scratch_path(spark, "checkpoint"), run_id)


def _arriving(spark, raw: DataFrame, options: SinkOptions, checkpoint: str, run_id: str) -> str:
    """Raw samples land in two goes and are taken in after each; returns their folder."""
    landing = scratch_path(spark, "landing")
    for odd in (0, 1):
        part = raw.where(F.shiftright("event_id", 1) % 2 == odd).drop("run_id", "event_id")
        _land(part, landing)
        _drained(spark, landing, options, checkpoint, run_id)
    return landing


def _land(raw: DataFrame, landing: str) -> None:
    """Add raw samples to a folder as JSON lines, in many small compressed files.

    A compressed file is read by one task, so files have to be many.
    """
    writer = raw.write.mode("append").option("maxRecordsPerFile", str(LANDING_ROWS))
    writer.option("compression", "gzip").json(landing)


def _drained(spark, landing: str, options: SinkOptions, checkpoint: str, run_id: str) -> None:
    """Take in what has landed and not been taken in yet."""
    stream = stream_raw(spark, landing)
    ingest.start_ingest(stream, options, checkpoint, run_id=run_id, drain=True).awaitTermination()


@query
def raw_json_source(spark, sf_dir):
    landing = scratch_path(spark, "landing")
    _land(raw_of(spark, sf_dir, spread=True, dirty=True).drop("run_id", "event_id"), landing)
    wide = flatten.flatten_samples(read_raw(spark, landing))
    return wide.groupBy("metric_name", "status").agg(F.count("*").alias("n"))


@query
def stream_ingest(spark, sf_dir):
    options = _ingested(spark, sf_dir)
    return _table_totals(read_samples(spark, options.path), "run_id", "metric_name")


@query
def stream_finalised(spark, sf_dir):
    options, runs_path = _ingested(spark, sf_dir), scratch_path(spark, "runs")
    run = runs.RunInfo(run_id="live", start_time=START)
    ingest.finalise_run(spark, run, options, runs_path)
    return read_runs(spark, runs_path).select("run_id", "sample_count", "start_time", "end_time")


@query
def stream_two_runs(spark, sf_dir):
    """Two streams, each with its own checkpoint, fill one table."""
    options = SinkOptions(scratch_path(spark, "streamed"))
    raw = raw_of(spark, sf_dir, spread=True)
    for label in ("A", "B"):
        _stream_into(spark, raw.where(F.col("run_id") == label), options, label)
    return _table_totals(read_samples(spark, options.path), "run_id", "metric_name")


@query
def stream_then_batch(spark, sf_dir):
    """A streamed run, a second one written as a batch, and the first one compacted."""
    options = SinkOptions(scratch_path(spark, "streamed"))
    _stream_into(spark, raw_of(spark, sf_dir, spread=True).where("run_id = 'A'"), options, "A")
    write_run(
        samples_of(spark, sf_dir, spread=True).where("run_id = 'B'"), runs.RunInfo(run_id="B"), options
    )
    compact_run(spark, options, "A")
    return _table_totals(read_samples(spark, options.path), "run_id", "metric_name")


def _crash_before_commit(spark, checkpoint: str) -> None:
    """Leave a checkpoint as a stream does that dies after it has written a batch."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    commits = hadoop.Path(checkpoint, "commits")
    fs = commits.getFileSystem(spark._jsc.hadoopConfiguration())
    numbers = [f.getPath().getName() for f in fs.listStatus(commits)]
    last = max(int(n) for n in numbers if n.isdigit())
    fs.delete(hadoop.Path(commits, str(last)), False)


@query
def stream_replayed_after_compaction(spark, sf_dir):
    """A run is compacted; then its stream, restarted, repeats a batch that is part of it."""
    options, checkpoint = SinkOptions(scratch_path(spark, "streamed")), scratch_path(spark, "checkpoint")
    landing = _arriving(spark, raw_of(spark, sf_dir, spread=True), options, checkpoint, "live")
    compact_run(spark, options, "live")
    _crash_before_commit(spark, checkpoint)
    # The same checkpoint, spelt differently.
    _drained(spark, landing, options, checkpoint + "/", "live")
    return _table_totals(read_samples(spark, options.path), "run_id", "metric_name")


@query
def stream_during_compaction(spark, sf_dir):
    """A stream adds to a run between each two steps of its compaction."""
    options, checkpoint = SinkOptions(scratch_path(spark, "streamed")), scratch_path(spark, "checkpoint")
    raw = raw_of(spark, sf_dir, spread=True).withColumn("part", F.col("event_id") % 5)
    landing = scratch_path(spark, "landing")

    def arrive(part: int) -> None:
        rows = raw.where(F.col("part") == part).drop("run_id", "event_id", "part")
        _land(rows, landing)
        _drained(spark, landing, options, checkpoint, "live")

    arrive(0)
    arrive(1)
    compaction = Compaction(spark, options, "live")
    arrive(2)
    compaction.write()
    arrive(3)
    compaction.commit()
    arrive(4)
    compaction.clear()
    return _table_totals(read_samples(spark, options.path), "run_id", "metric_name")


def _streamed_live(spark, sf_dir, start, path: str, run: str | None = None) -> Callable[[], None]:
    """Stream derived samples into a live series, in three goes, the newest events first.

    Returns what starts the stream once more.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    landing, checkpoint = scratch_path(spark, "event-files"), scratch_path(spark, "checkpoint")

    def again() -> None:
        stream = samples_from_events(spark.readStream.schema(events.schema).parquet(landing))
        if run is not None:
            stream = stream.where(F.col("run_id") == run)
        stream = stream.withColumn("ts", sample_time())
        start(stream, path, checkpoint, "1 hour", drain=True).awaitTermination()

    for days in ("> 20", "BETWEEN 11 AND 20", "< 11"):
        events.where(f"day(ts) {days}").write.mode("append").parquet(landing)
        again()

    def repeat() -> None:
        _crash_before_commit(spark, checkpoint)
        again()

    return repeat


@query
def stream_two_live_series(spark, sf_dir):
    """Two streams add to one live series; one is then restarted and repeats a batch."""
    path = scratch_path(spark, "counts")
    repeat = _streamed_live(spark, sf_dir, live.start_value_counts, path, "A")
    _streamed_live(spark, sf_dir, live.start_value_counts, path, "B")
    repeat()
    return live.throughput_from_counts(live.read_value_counts(spark, path))


@query
def stream_throughput(spark, sf_dir):
    """All hours of a streamed run, exact, though its files come newest first."""
    path = scratch_path(spark, "counts")
    _streamed_live(spark, sf_dir, live.start_value_counts, path)
    return live.throughput_from_counts(live.read_value_counts(spark, path))


@query
def stream_throughput_sketch(spark, sf_dir):
    """All hours of a streamed run; whether the sketched p95 has the rank it should."""
    path = scratch_path(spark, "sketches")
    _streamed_live(spark, sf_dir, live.start_bucket_sketches, path)
    table = live.throughput_from_sketches(live.read_bucket_sketches(spark, path))
    table = settle(table, "sketched")
    ranks = (
        latency.durations(samples_of(spark, sf_dir), {"bucket": time_bucket("1 hour")}, "http_req_duration")
        .join(table.select("bucket", "p95_ms"), "bucket")
        .groupBy("bucket")
        .agg(
            F.sum((F.col("value") < F.col("p95_ms") - 0.05).cast("int")).alias("below"),
            F.sum((F.col("value") <= F.col("p95_ms") + 0.05).cast("int")).alias("upto"),
            F.count("*").alias("n"),
        )
    )
    # A sketched quantile is a value of the data: its rank is the next one up or down.
    wanted = 0.95 * F.col("n")
    slack = 1 + 0.001 * F.col("n")
    right = (F.col("below") <= wanted + slack) & (F.col("upto") >= wanted - slack)
    return table.drop("p95_ms").join(ranks.select("bucket", right.alias("p95_ok")), "bucket")
