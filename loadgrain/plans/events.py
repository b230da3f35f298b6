"""Load-test samples derived from an ``events`` table.

Each event stands for one request of a test run and yields the samples such a
request would emit. One scan of ``events`` gives all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadgrain.schema import SAMPLES

N_SECTIONS = 13

# The samples of one event. Measured: how the value comes about, with a factor
# for shares of the event's own value. Coverage: `http` samples carry name,
# group, method and status; `group` samples only the group; `none` no such tag.
MEASUREMENTS = (
    # metric, type, value type, measured, factor, coverage, check
    ("http_reqs", "counter", "default", "one", 0.0, "http", None),
    ("http_req_duration", "trend", "time", "share", 1.0, "http", None),
    ("http_req_blocked", "trend", "time", "share", 0.05, "http", None),
    ("http_req_connecting", "trend", "time", "share", 0.10, "http", None),
    ("http_req_tls_handshaking", "trend", "time", "share", 0.15, "http", None),
    ("http_req_sending", "trend", "time", "share", 0.02, "http", None),
    ("http_req_waiting", "trend", "time", "share", 0.60, "http", None),
    ("http_req_receiving", "trend", "time", "share", 0.08, "http", None),
    ("http_req_failed", "rate", "default", "failed", 0.0, "http", None),
    ("checks", "rate", "default", "status", 0.0, "group", "answered in full"),
    ("checks", "rate", "default", "body", 0.0, "group", "has a page"),
    ("group_duration", "trend", "time", "group", 0.0, "group", None),
    ("vus", "gauge", "default", "users", 0.0, "none", None),
    ("data_received", "counter", "data", "bytes", 0.0, "none", None),
)
_FIELDS = "metric_name metric_type value_type measured factor coverage check".split()


def _requests(events: DataFrame, run_by: str) -> DataFrame:
    """One row per event with the request attributes its samples share."""
    error = F.col("event_type") == "error"
    section = F.format_string("section-%02d", F.col("user_id") % N_SECTIONS)
    if run_by == "parity":
        run_id = F.when(F.col("event_id") % 2 == 0, "A").otherwise("B")
    elif run_by == "day":
        run_id = F.concat(F.lit("day-"), F.date_format("ts", "yyyy-MM-dd"))
    else:
        raise ValueError(f"unknown run_by {run_by!r}")
    return events.select(
        "event_id",
        "user_id",
        (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("ts_unix_nano"),
        F.col("value").alias("ms"),
        section.alias("section"),
        run_id.alias("run_id"),
        error.alias("failed"),
        F.when(F.col("event_type").isin("signup", "purchase"), "POST")
        .otherwise("GET")
        .alias("method"),
        F.when(error, 500)
        .when((F.col("event_type") == "view") & (F.col("event_id") % 5 == 0), 302)
        .otherwise(200)
        .alias("status"),
    )


def _measured(events: DataFrame, run_by: str) -> DataFrame:
    """One row per sample: the request's attributes, the labels and the value."""
    literal = lambda v: "null" if v is None else repr(v) + "d" * isinstance(v, float)
    structs = [f"struct({', '.join(map(literal, row))})" for row in MEASUREMENTS]
    labels = F.inline(F.expr(f"array({', '.join(structs)})")).alias(*_FIELDS)
    rows = _requests(events, run_by).select("*", labels)
    flag = lambda cond: F.when(cond, 1.0).otherwise(0.0)
    event_id, measured = F.col("event_id"), F.col("measured")
    value = (
        F.when(measured == "share", F.col("ms") * F.col("factor"))
        .when(measured == "one", F.lit(1.0))
        .when(measured == "failed", flag(F.col("failed")))
        .when(measured == "status", flag(~F.col("failed")))
        .when(measured == "body", flag(event_id % 50 != 0))
        .when(measured == "group", F.col("ms") + 100 + event_id % 7)
        .when(measured == "users", 1.0 + event_id % 12)
        .when(measured == "bytes", 100.0 + event_id % 900)
    )
    coverage = F.col("coverage")
    http = coverage == "http"
    # The users gauge is reported less often than requests are made.
    emitted = (measured != "users") | (event_id % 10 == 0)
    return rows.where(emitted).withColumns(
        {
            "value": value,
            "name": F.when(http, F.col("section")),
            "group": F.when(coverage != "none", F.concat(F.lit("::"), F.col("section"))),
            "method": F.when(http, F.col("method")),
            "status": F.when(http, F.col("status")),
        }
    )


def samples_from_events(events: DataFrame, run_by: str = "parity") -> DataFrame:
    """Wide samples (the 26 columns) plus ``run_id`` and ``event_id``."""
    rows = _measured(events, run_by).withColumns(
        {
            "scenario": F.lit("default"),
            "expected_response": ~F.col("failed"),
            "vu": F.col("user_id"),
            "iter": F.col("event_id"),
        }
    )
    columns = [
        (F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None))
        .cast(f.dataType)
        .alias(f.name)
        for f in SAMPLES
    ]
    return rows.select(*columns, "run_id", "event_id")


def raw_from_events(events: DataFrame, run_by: str = "parity", dirty: bool = False) -> DataFrame:
    """Raw samples plus ``run_id`` and ``event_id``.

    ``dirty`` adds a custom tag, metadata of its own, and tag and metadata texts
    that do not parse, so that they must spill.
    """
    rows = _measured(events, run_by)
    event_id = F.col("event_id")
    text = lambda c: c.cast("string")
    status = text(F.col("status"))
    expected = text(~F.col("failed"))
    vu = text(F.col("user_id"))
    tags = {"scenario": F.lit("default")}
    metadata = {}
    if dirty:
        broken = F.col("status").isNotNull() & (event_id % 97 == 0)
        status = F.when(broken, "cut-off").otherwise(status)
        expected = F.when(event_id % 89 == 0, "yes").otherwise(expected)
        vu = F.when(event_id % 101 == 0, "n/a").otherwise(vu)
        trace = F.concat(F.lit("trace-"), text(event_id))
        metadata["trace_id"] = F.when(event_id % 20 == 0, trace)
        tags["team"] = F.concat(F.lit("team-"), text(F.col("user_id") % 4))
    tags |= {"expected_response": expected, "status": status}
    tags |= {name: F.col(name) for name in ("group", "name", "method", "check")}
    metadata |= {"vu": vu, "iter": text(event_id)}
    metric = F.struct(
        F.col("metric_name").alias("name"),
        F.col("metric_type").alias("type"),
        F.col("value_type").alias("contains"),
        F.lit(None).cast("struct<parent:string,suffix:string>").alias("sub"),
    )
    return rows.select(
        "ts_unix_nano",
        "value",
        metric.alias("metric"),
        _present(tags).alias("tags"),
        _present(metadata).alias("metadata"),
        "run_id",
        "event_id",
    )


def _present(entries: dict[str, Column]) -> Column:
    """A map without the entries whose value is NULL."""
    pairs = [part for key, value in entries.items() for part in (F.lit(key), value)]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def runs_from_events(events: DataFrame, run_by: str = "day") -> DataFrame:
    """Run attributes for the derived runs: one row per run id."""
    return (
        _requests(events, run_by)
        .groupBy("run_id")
        .agg(F.min("ts_unix_nano").alias("first_ns"))
        .select(
            "run_id",
            F.concat(F.lit("nightly "), "run_id").alias("run_name"),
            F.concat(F.lit("host-"), F.substring("run_id", -1, 1)).alias("hostname"),
            F.timestamp_micros(F.expr("first_ns div 1000")).alias("start_time"),
        )
    )
