"""Schemas of raw samples, wide samples and run records."""

from __future__ import annotations

from pyspark.sql import types as T

SCHEMA_VERSION = "1"

# The tags that become columns of their own, and the metadata
# entries that do. Everything else spills into the two map columns.
STRING_TAGS = (
    "scenario",
    "group",
    "service",
    "name",
    "method",
    "url",
    "proto",
    "subproto",
    "tls_version",
    "check",
    "error",
    "ip",
)
INT_TAGS = ("status", "error_code")
BOOL_TAGS = ("expected_response",)
LONG_METADATA = ("vu", "iter")

# The labels a metric may carry.
METRIC_TYPES = ("counter", "gauge", "trend", "rate")
VALUE_TYPES = ("default", "time", "data")

_STR = T.StringType()
_MAP = T.MapType(_STR, _STR)

RAW = T.StructType(
    [
        T.StructField("ts_unix_nano", T.LongType(), False),
        T.StructField("value", T.DoubleType(), False),
        T.StructField(
            "metric",
            T.StructType(
                [
                    T.StructField("name", _STR),
                    T.StructField("type", _STR),
                    T.StructField("contains", _STR),
                    T.StructField(
                        "sub",
                        T.StructType(
                            [T.StructField("parent", _STR), T.StructField("suffix", _STR)]
                        ),
                    ),
                ]
            ),
        ),
        T.StructField("tags", _MAP),
        T.StructField("metadata", _MAP),
    ]
)

RAW_CONTAINERS = T.StructType([T.StructField("samples", T.ArrayType(RAW))])

# The 26 stored columns, in file order.
SAMPLES = T.StructType(
    [
        T.StructField("ts_unix_nano", T.LongType(), False),
        T.StructField("metric_name", _STR, False),
        T.StructField("metric_type", _STR, False),
        T.StructField("value_type", _STR, False),
        T.StructField("value", T.DoubleType(), False),
        T.StructField("submetric_parent", _STR),
        T.StructField("submetric_suffix", _STR),
        T.StructField("scenario", _STR),
        T.StructField("group", _STR),
        T.StructField("service", _STR),
        T.StructField("name", _STR),
        T.StructField("method", _STR),
        T.StructField("status", T.IntegerType()),
        T.StructField("url", _STR),
        T.StructField("proto", _STR),
        T.StructField("subproto", _STR),
        T.StructField("tls_version", _STR),
        T.StructField("check", _STR),
        T.StructField("error", _STR),
        T.StructField("error_code", T.IntegerType()),
        T.StructField("expected_response", T.BooleanType()),
        T.StructField("ip", _STR),
        T.StructField("vu", T.LongType()),
        T.StructField("iter", T.LongType()),
        T.StructField("extra_tags", _MAP),
        T.StructField("extra_metadata", _MAP),
    ]
)
SAMPLE_COLUMNS = tuple(SAMPLES.fieldNames())

# A sample table keeps one folder per run, and in it one per load: a batch write,
# or a batch of a stream.
RUN_ID = T.StructField("run_id", _STR)
LOAD = T.StructField("load", _STR)

RUNS = T.StructType(
    [
        T.StructField("run_id", _STR),
        T.StructField("run_name", _STR),
        T.StructField("schema_version", _STR),
        T.StructField("tool_version", _STR),
        T.StructField("runtime_version", _STR),
        T.StructField("os", _STR),
        T.StructField("arch", _STR),
        T.StructField("hostname", _STR),
        T.StructField("script_path", _STR),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("sample_count", T.LongType()),
        T.StructField("compression", _STR),
        T.StructField("row_group_size", T.LongType()),
        T.StructField("script_options", _STR),
    ]
)
