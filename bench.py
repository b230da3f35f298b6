"""Time the headline reports on two sample tables; prints one JSON line.

Raw samples derived from ``events`` are put into files first, untimed. ``ingest``
flattens them into a run table, which the reports then read. A second table has
every event eight times, a month apart, so that start-up is not all one sees.
DuckDB runs SQL for the same reports, rounded and in order, over the same files.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

import duckdb
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loadgrain.operators import comparison, latency, requests, timeline
from loadgrain.operators.flatten import flatten_samples
from loadgrain.plans.events import raw_from_events, samples_from_events
from loadgrain.schema import RAW, RUN_ID
from loadgrain.session import local_session
from loadgrain.sources.samples import SinkOptions, read_samples, write_samples

REPEATS = 3

REPORTS = {
    "latency_percentiles": latency.latency_percentiles,
    "request_phases": requests.request_phases,
    "check_pass_rate": requests.check_pass_rate,
    "throughput_over_time": timeline.throughput_over_time,
    "script_overhead": requests.script_overhead,
    "status_distribution": requests.status_distribution,
    "error_rate": requests.error_rate,
    "latency_histogram": requests.latency_histogram,
    "slowest_requests": latency.slowest_requests,
    "iteration_balance": requests.iteration_balance,
    "compare_runs": lambda s: comparison.compare_runs(s, "A", "B"),
}

SECTION = """coalesce(name, replace("group", '::', ''))"""
# The same reports over view `s`, from the reports' own definitions.
DUCK = {
    "latency_percentiles": """SELECT name AS section, count(*) AS samples,
        round(quantile_cont(value, 0.5), 1) AS p50, round(quantile_cont(value, 0.95), 1) AS p95,
        round(quantile_cont(value, 0.99), 1) AS p99, round(max(value), 1) AS top
        FROM s WHERE metric_name = 'http_req_duration' GROUP BY section
        ORDER BY p95 DESC NULLS LAST, section""",
    "request_phases": """SELECT name AS section, """
    + ", ".join(
        f"round(avg(value) FILTER (metric_name = '{metric}'), {digits}) AS {column}"
        for metric, column, digits in requests.PHASES
    )
    + """ FROM s WHERE metric_name LIKE 'http_req_%' AND name IS NOT NULL
        AND metric_name NOT IN ('http_req_duration', 'http_req_failed')
        GROUP BY section ORDER BY wait_ms DESC NULLS LAST, section""",
    "check_pass_rate": """SELECT replace("group", '::', '') AS section, "check", count(*) AS n,
        round(avg(value) * 100, 2) AS pass_pct FROM s WHERE metric_name = 'checks'
        GROUP BY ALL ORDER BY pass_pct, section, "check\"""",
    "throughput_over_time": """SELECT ts_unix_nano // 5000000000 AS bucket,
        count(*) FILTER (metric_name = 'http_reqs') AS reqs,
        round(quantile_cont(value, 0.95) FILTER (metric_name = 'http_req_duration'), 1) AS p95,
        CAST(max(value) FILTER (metric_name = 'vus') AS INTEGER) AS vus
        FROM s GROUP BY bucket ORDER BY bucket""",
    "script_overhead": f"""SELECT {SECTION} AS section,
        avg(value) FILTER (metric_name = 'http_req_duration') AS h,
        avg(value) FILTER (metric_name = 'group_duration') AS g,
        round(h, 1) AS http, round(g, 1) AS grouped, round(g - h, 1) AS overhead FROM s
        WHERE metric_name IN ('http_req_duration', 'group_duration') GROUP BY section
        ORDER BY overhead DESC NULLS LAST, section""",
    "status_distribution": """SELECT name AS section, status, count(*) AS n FROM s
        WHERE metric_name = 'http_req_duration' GROUP BY ALL ORDER BY section, status""",
    "error_rate": """SELECT name AS section, count(*) AS n, round(avg(value) * 100, 2) AS pct FROM s
        WHERE metric_name = 'http_req_failed' GROUP BY section ORDER BY pct DESC, section""",
    "latency_histogram": """SELECT CAST(floor(value / 50) * 50 AS BIGINT) AS step, count(*) AS n
        FROM s WHERE metric_name = 'http_req_duration' GROUP BY step ORDER BY step""",
    "slowest_requests": """SELECT ts_unix_nano, name, method, status, round(value, 1) AS ms FROM s
        WHERE metric_name = 'http_req_duration' ORDER BY value DESC, ts_unix_nano, name LIMIT 20""",
    "iteration_balance": """SELECT name AS section, count(*) AS n FROM s
        WHERE metric_name = 'http_reqs' GROUP BY section ORDER BY n DESC, section""",
    "compare_runs": """SELECT name AS section,
        quantile_cont(value, 0.95) FILTER (run_id = 'A') AS a,
        quantile_cont(value, 0.95) FILTER (run_id = 'B') AS b,
        round(a, 1) AS a_ms, round(b, 1) AS b_ms, round(b - a, 1) AS delta FROM s
        WHERE metric_name = 'http_req_duration' GROUP BY section
        ORDER BY delta DESC NULLS LAST, section""",
}
COPIES = 8


def median_time(action, repeats: int = REPEATS) -> float:
    times = []
    for _ in range(repeats):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 4)


def time_reports(spark, table: str, cpus: str, repeats: int) -> tuple[dict, dict, int]:
    """Seconds per report, in Spark and in DuckDB, and the number of samples."""
    samples = read_samples(spark, table)
    rows = samples.count()
    mine = {
        name: median_time(lambda report=report: report(samples).toArrow(), repeats)
        for name, report in REPORTS.items()
    }
    con = duckdb.connect()
    con.execute(f"SET threads = {cpus}")
    con.execute(
        f"CREATE VIEW s AS FROM read_parquet('{table}/*/*/*.parquet', hive_partitioning = true)"
    )
    theirs = {
        name: median_time(lambda sql=sql: con.sql(sql).to_arrow_table(), repeats)
        for name, sql in DUCK.items()
    }
    return mine, theirs, rows


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    work = tempfile.mkdtemp(prefix="bench-")

    events = spark.read.parquet(f"{sf_dir}/events.parquet").repartition(int(cpus))
    raw_from_events(events).drop("event_id").write.parquet(f"{work}/raw")
    raw = spark.read.schema(StructType([*RAW.fields, RUN_ID])).parquet(f"{work}/raw")
    table, large = f"{work}/table", f"{work}/large"
    ingest = median_time(lambda: write_samples(flatten_samples(raw), SinkOptions(table)))
    mine, theirs, rows = time_reports(spark, table, cpus, REPEATS)

    month = F.make_dt_interval(days=F.col("copy") * 31)
    copied = events.select("*", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("copy"))
    copied = samples_from_events(copied.withColumn("ts", F.col("ts") + month))
    write_samples(copied, SinkOptions(large))
    mine_large, theirs_large, rows_large = time_reports(spark, large, cpus, 1)

    print(
        json.dumps(
            {
                "metric": "sum of median report times",
                "value": round(sum(mine.values()), 4),
                "unit": "sec",
                "queries": {
                    **mine,
                    "ingest": ingest,
                    **{f"large_{name}": seconds for name, seconds in mine_large.items()},
                },
                "duckdb": theirs | {f"large_{n}": seconds for n, seconds in theirs_large.items()},
                "samples": rows,
                "samples_large": rows_large,
                "ingest_rows_per_sec": round(rows / ingest),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
