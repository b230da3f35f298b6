"""Analysis of raw load-test samples on Spark."""

from loadgrain.functions.percentiles import grouped_percentiles
from loadgrain.functions.sql import register_sql
from loadgrain.operators.comparison import (
    compare_runs,
    metric_history,
    regression_bounds,
    regressions,
)
from loadgrain.operators.flatten import explode_containers, flatten_samples, unknown_labels
from loadgrain.operators.latency import (
    latency_percentiles,
    p95_by,
    slowest_requests,
    status_association,
    status_correlation,
    status_timing,
    tag_percentiles,
    tail_outliers,
)
from loadgrain.operators.requests import (
    bytes_received,
    check_pass_rate,
    error_rate,
    iteration_balance,
    latency_histogram,
    pass_rate_by_check,
    phase_averages,
    request_phases,
    script_overhead,
    status_distribution,
)
from loadgrain.operators.runs import (
    RunInfo,
    attach_runs,
    join_external,
    redact_options,
    summarise_runs,
)
from loadgrain.operators.sketches import latency_sketches, merged_percentiles
from loadgrain.operators.timeline import breach_spans, first_breach, throughput_over_time
from loadgrain.session import configure
from loadgrain.sources.provenance import (
    footer_value,
    read_footers,
    read_row_groups,
    require_schema_version,
    run_metadata,
    runs_from_footers,
    write_portable_run,
)
from loadgrain.sources.raw import read_raw, stream_raw
from loadgrain.sources.samples import (
    SinkOptions,
    compact_run,
    concatenate,
    label_by_source,
    read_runs,
    read_samples,
    write_run,
    write_runs,
    write_samples,
)
from loadgrain.sources.versions import Layout, register_layout
from loadgrain.streaming.ingest import finalise_run, start_ingest
from loadgrain.streaming.live import (
    read_bucket_sketches,
    read_value_counts,
    start_bucket_sketches,
    start_value_counts,
    throughput_from_counts,
    throughput_from_sketches,
)

__all__ = [name for name in dir() if not name.startswith("_")]
