"""The same results from ``events`` in SQL, without going through samples."""

from __future__ import annotations

REQUESTS = """
WITH req AS (
  SELECT event_id, user_id, ts, value AS ms,
         printf('section-%02d', user_id % 13) AS section,
         event_type = 'error' AS failed,
         CASE WHEN event_type IN ('signup', 'purchase') THEN 'POST' ELSE 'GET' END AS method,
         CAST(CASE WHEN event_type = 'error' THEN 500
                   WHEN event_type = 'view' AND event_id % 5 = 0 THEN 302
                   ELSE 200 END AS INTEGER) AS status,
         CASE WHEN event_id % 2 = 0 THEN 'A' ELSE 'B' END AS run,
         'day-' || strftime(ts, '%Y-%m-%d') AS day_run,
         CASE WHEN event_id % 10 = 0 THEN CAST(1 + event_id % 12 AS INTEGER) END AS users
  FROM events
)
"""

# Every sample of an event: metric, labels, value and which tags it carries.
SAMPLES = (
    REQUESTS
    + """, smp AS (
  SELECT r.*, m.metric_name, m.metric_type, m.value_type, m.check_name, m.http, m.grouped,
         CASE m.k
           WHEN 'share' THEN r.ms * m.share
           WHEN 'one' THEN 1.0
           WHEN 'failed' THEN CAST(r.failed AS INTEGER)
           WHEN 'ok' THEN 1 - CAST(r.failed AS INTEGER)
           WHEN 'body' THEN CAST(r.event_id % 50 <> 0 AS INTEGER)
           WHEN 'group' THEN r.ms + 100 + r.event_id % 7
           WHEN 'users' THEN 1 + r.event_id % 12
           ELSE 100 + r.event_id % 900 END::DOUBLE AS v
  FROM req r CROSS JOIN (VALUES
    ('http_reqs', 'counter', 'default', 'one', 0::DOUBLE, NULL, true, true),
    ('http_req_duration', 'trend', 'time', 'share', 1.0::DOUBLE, NULL, true, true),
    ('http_req_blocked', 'trend', 'time', 'share', 0.05::DOUBLE, NULL, true, true),
    ('http_req_connecting', 'trend', 'time', 'share', 0.10::DOUBLE, NULL, true, true),
    ('http_req_tls_handshaking', 'trend', 'time', 'share', 0.15::DOUBLE, NULL, true, true),
    ('http_req_sending', 'trend', 'time', 'share', 0.02::DOUBLE, NULL, true, true),
    ('http_req_waiting', 'trend', 'time', 'share', 0.60::DOUBLE, NULL, true, true),
    ('http_req_receiving', 'trend', 'time', 'share', 0.08::DOUBLE, NULL, true, true),
    ('http_req_failed', 'rate', 'default', 'failed', 0::DOUBLE, NULL, true, true),
    ('checks', 'rate', 'default', 'ok', 0::DOUBLE, 'answered in full', false, true),
    ('checks', 'rate', 'default', 'body', 0::DOUBLE, 'has a page', false, true),
    ('group_duration', 'trend', 'time', 'group', 0::DOUBLE, NULL, false, true),
    ('vus', 'gauge', 'default', 'users', 0::DOUBLE, NULL, false, false),
    ('data_received', 'counter', 'data', 'bytes', 0::DOUBLE, NULL, false, false)
  ) AS m(metric_name, metric_type, value_type, k, share, check_name, http, grouped)
  WHERE m.metric_name <> 'vus' OR r.event_id % 10 = 0
)
"""
)

_PERCENTILES = """count(*) AS samples,
  round(quantile_cont(ms, 0.5), 1) AS p50_ms, round(quantile_cont(ms, 0.95), 1) AS p95_ms,
  round(quantile_cont(ms, 0.99), 1) AS p99_ms, round(max(ms), 1) AS max_ms
  FROM req GROUP BY ALL"""

_COMPARED = """
SELECT section, round(a.p, 1) AS a_p95_ms, round(b.p, 1) AS b_p95_ms,
       round(b.p - a.p, 1) AS delta_ms
FROM (SELECT section, quantile_cont(ms, 0.95) AS p FROM req WHERE run = 'A' GROUP BY section) a
FULL JOIN (SELECT section, quantile_cont(ms, 0.95) AS p FROM req WHERE {b} GROUP BY section) b
USING (section)"""

_ORDERED_DELTAS = """
SELECT section, row_number() OVER (ORDER BY round(b - a, 1) DESC NULLS LAST, section) AS place
FROM (SELECT section, quantile_cont(ms, 0.95) FILTER (run = 'A') AS a,
             quantile_cont(ms, 0.95) FILTER (run = 'B' AND section <> 'section-12') AS b
      FROM req GROUP BY section)"""

# p95, and 1.96 deviations of the number of values below it, per square root of n.
_P = 0.95
_SPREAD = 1.96 * (_P * (1 - _P)) ** 0.5

_TOTALS = """count(*) AS n, round(sum(v), 4) AS total, min(ts) AS first, max(ts) AS last
FROM smp"""


def _throughput(bucket: str) -> str:
    return f"""{REQUESTS}
SELECT {bucket} AS bucket, count(*) AS reqs, round(quantile_cont(ms, 0.95), 1) AS p95_ms,
       max(users) AS vus
FROM req GROUP BY 1"""


_DIRTY = """
SELECT event_id, ts, metric_name, metric_type, value_type, round(v, 6) AS value,
  'default' AS scenario,
  CASE WHEN grouped THEN '::' || section END AS group_tag,
  CASE WHEN http THEN section END AS name,
  CASE WHEN http THEN method END AS method,
  check_name,
  CASE WHEN http AND event_id % 97 <> 0 THEN status END AS status,
  CASE WHEN event_id % 89 <> 0 THEN NOT failed END AS expected_response,
  CASE WHEN event_id % 101 <> 0 THEN user_id END AS vu,
  event_id AS iter,
  'team-' || (user_id % 4) AS team,
  CASE WHEN http AND event_id % 97 = 0 THEN 'cut-off' END AS spilled_status,
  CASE WHEN event_id % 89 = 0 THEN 'yes' END AS spilled_expected,
  CAST(1 + CAST(http AND event_id % 97 = 0 AS INTEGER)
         + CAST(event_id % 89 = 0 AS INTEGER) AS INTEGER) AS n_extra_tags,
  CASE WHEN event_id % 101 = 0 THEN 'n/a' END AS spilled_vu,
  CASE WHEN event_id % 20 = 0 THEN 'trace-' || event_id END AS trace_id,
  CAST(nullif(CAST(event_id % 101 = 0 AS INTEGER)
            + CAST(event_id % 20 = 0 AS INTEGER), 0) AS INTEGER) AS n_extra_metadata
FROM smp"""

_EDGE_TEXTS = """
WITH t AS (
  SELECT event_id, f.form,
    CASE f.form WHEN 'plus' THEN '+' WHEN 'minus' THEN '-' WHEN 'zeros' THEN '000'
                WHEN 'blank' THEN ' ' WHEN 'too_large' THEN '2147483648' ELSE '' END
    || CASE f.form WHEN 'empty' THEN '' ELSE event_id::VARCHAR END
    || CASE f.form WHEN 'newline' THEN chr(10) WHEN 'fraction' THEN '.0'
                   WHEN 'underscore' THEN '_0' ELSE '' END AS text,
    ['T', '1', '0', 'False', 'tRue', 'n', 'TRUE', 'yes'][event_id % 8 + 1] AS word
  FROM events CROSS JOIN (VALUES ('plain'), ('plus'), ('minus'), ('zeros'), ('blank'),
    ('newline'), ('fraction'), ('underscore'), ('too_large'), ('empty')) AS f(form)
), p AS (
  SELECT *, form IN ('plain', 'plus', 'minus', 'zeros') AS small,
    CASE form WHEN 'minus' THEN -event_id ELSE event_id END AS n,
    word IN ('T', '1', 'TRUE') AS yes, word IN ('0', 'False') AS no
  FROM t
)
SELECT event_id, form, '' AS metric_name,
  CAST(CASE WHEN small THEN n END AS INTEGER) AS status,
  CASE WHEN small THEN n WHEN form = 'too_large' THEN text::BIGINT END AS vu,
  CASE WHEN yes THEN true WHEN no THEN false END AS expected_response,
  CASE WHEN NOT small THEN text END AS spilled_status,
  CASE WHEN NOT yes AND NOT no THEN word END AS spilled_expected,
  CASE WHEN NOT small AND form <> 'too_large' THEN text END AS spilled_vu
FROM p"""

_FOOTER = """
SELECT 'loadgrain.' || k AS key, v AS value FROM (VALUES
  ('schema_version', '1'), ('test_run_id', 'nightly-1'), ('tool_version', '1.2.3'),
  ('go_version', '3'), ('os', 'linux'), ('arch', 'amd64'),
  ('start_time', '2024-01-01T00:00:00Z'), ('compression', 'zstd'), ('row_group_size', '1000'),
  ('test_run_name', 'nightly'), ('hostname', 'host-1'), ('script_path', 'checkout.js'),
  ('end_time', '2024-01-31T01:02:03.5Z'), ('duration', '721h2m3.5s')) AS t(k, v)
UNION ALL
SELECT 'loadgrain.sample_count', count(*)::VARCHAR FROM smp"""

ORACLES: dict[str, str] = {
    "latency_percentiles": f"{REQUESTS} SELECT section, {_PERCENTILES}",
    "latency_percentiles_refined": f"{REQUESTS} SELECT section, {_PERCENTILES}",
    "latency_percentiles_by_endpoint": f"{REQUESTS} SELECT section, method, status, {_PERCENTILES}",
    "latency_sketch_rank_error": f"""{REQUESTS}
SELECT section, count(*) AS samples, true AS p50_ms_ok, true AS p95_ms_ok, true AS p99_ms_ok
FROM req GROUP BY section""",
    "merged_sketch_rank_error": f"""{REQUESTS}
SELECT section, count(*) AS samples, true AS p50_ms_ok, true AS p95_ms_ok
FROM req GROUP BY section""",
    "sql_over_samples": f"""{REQUESTS}
SELECT time_bucket(INTERVAL 6 HOUR, ts) AS bucket, method, count(*) AS failures,
  round(avg(ms), 2) AS avg_ms, CAST(count(*) / 4.0::DOUBLE AS INTEGER) AS quarter
FROM req WHERE failed GROUP BY ALL""",
    "p95_quick_start": f"""{REQUESTS}
SELECT section AS name, count(*) AS samples, round(quantile_cont(ms, 0.95), 6) AS p95
FROM req GROUP BY section""",
    "p95_by_name": f"""{REQUESTS}
SELECT section AS name, round(quantile_cont(ms, 0.95), 6) AS p95_ms FROM req GROUP BY section""",
    "request_phases": f"""{REQUESTS}
SELECT section,
  round(avg(ms * 0.05::DOUBLE), 1) AS blocked_ms, round(avg(ms * 0.10::DOUBLE), 1) AS connect_ms,
  round(avg(ms * 0.15::DOUBLE), 1) AS tls_ms, round(avg(ms * 0.02::DOUBLE), 2) AS send_ms,
  round(avg(ms * 0.60::DOUBLE), 1) AS wait_ms, round(avg(ms * 0.08::DOUBLE), 1) AS recv_ms
FROM req GROUP BY section""",
    "phase_averages": f"""{SAMPLES}
SELECT section AS name, metric_name, round(avg(v), 6) AS avg
FROM smp WHERE starts_with(metric_name, 'http_req_') AND metric_type = 'trend'
GROUP BY section, metric_name""",
    "check_pass_rate": f"""{SAMPLES}
SELECT section, check_name, count(*) AS n, round(100 * avg(v), 2) AS pass_pct
FROM smp WHERE check_name IS NOT NULL GROUP BY section, check_name""",
    "pass_rate_by_check": f"""{SAMPLES}
SELECT NULL::VARCHAR AS name, check_name AS "check", round(avg(v), 6) AS pass_rate
FROM smp WHERE check_name IS NOT NULL GROUP BY check_name""",
    "error_rate": f"""{REQUESTS}
SELECT section, count(*) AS requests, round(100.0 * sum(failed::INT) / count(*), 2) AS error_pct
FROM req GROUP BY section""",
    "error_rate_by_method": f"""{REQUESTS}
SELECT method AS section, count(*) AS requests,
  round(100.0 * sum(failed::INT) / count(*), 2) AS error_pct
FROM req GROUP BY method""",
    "status_distribution": f"""{REQUESTS}
SELECT section, status, count(*) AS n FROM req GROUP BY section, status""",
    "iteration_balance": f"""{REQUESTS}
SELECT section, count(*) AS iterations FROM req GROUP BY section""",
    "script_overhead": f"""{REQUESTS}
SELECT section, round(avg(ms), 1) AS http_avg_ms,
  round(avg(ms + 100 + event_id % 7), 1) AS group_avg_ms,
  round(avg(ms + 100 + event_id % 7) - avg(ms), 1) AS overhead_ms
FROM req GROUP BY section""",
    "bytes_received": """
SELECT NULL::VARCHAR AS "group", sum(100 + event_id % 900)::DOUBLE AS bytes FROM events""",
    "latency_histogram": """
SELECT CAST(50 * floor(value / 50) AS BIGINT) AS ms_bucket_lower, count(*) AS n
FROM events GROUP BY 1""",
    "latency_histogram_fine": """
SELECT CAST(5 * floor(value / 5) AS BIGINT) AS ms_bucket_lower, count(*) AS n,
  repeat('▇', CAST(count(*) / 4.0::DOUBLE AS INTEGER)) AS bar
FROM events GROUP BY 1""",
    "slowest_requests": f"""{REQUESTS}
SELECT ts, section, method, status, round(ms, 1) AS duration_ms
FROM req ORDER BY ms DESC, ts, section LIMIT 20""",
    "throughput_over_time": _throughput("time_bucket(INTERVAL 5 SECOND, ts)"),
    "throughput_hourly": _throughput("time_bucket(INTERVAL 1 HOUR, ts)"),
    "throughput_weekly_refined": _throughput("time_bucket(INTERVAL 7 DAY, ts)"),
    "throughput_monthly": _throughput("time_bucket(INTERVAL 1 MONTH, ts)"),
    "compare_runs": REQUESTS + _COMPARED.format(b="run = 'B' AND section <> 'section-12'"),
    "compare_runs_refined": f"""{REQUESTS}
SELECT section, run AS run_id, round(quantile_cont(ms, 0.95), 6) AS p95
FROM req GROUP BY section, run""",
    "tail_outliers": f"""{REQUESTS}
SELECT ts, section, method, status, ms AS duration_ms, round(p99, 6) AS limit_ms
FROM (SELECT *, quantile_cont(ms, 0.99) OVER (PARTITION BY section) AS p99 FROM req)
WHERE ms > p99""",
    "regressions": f"""{REQUESTS}
SELECT section, method, round(a, 1) AS a_p95_ms, round(b, 1) AS b_p95_ms,
  round(b - a, 1) AS delta_ms
FROM (SELECT section, method, quantile_cont(ms, 0.95) FILTER (run = 'A') AS a,
             quantile_cont(ms, 0.95) FILTER (run = 'B') AS b FROM req GROUP BY section, method)
WHERE b - a > 2.0""",
    "status_timing": f"""{REQUESTS}
SELECT status, count(*) AS requests, round(avg(ms), 1) AS avg_ms,
  round(quantile_cont(ms, 0.5), 1) AS p50_ms, round(quantile_cont(ms, 0.95), 1) AS p95_ms
FROM req GROUP BY status""",
    "status_correlation": f"""{REQUESTS}
SELECT section, count(*) AS requests, round(corr(status, ms), 6) AS status_corr
FROM req GROUP BY section""",
    "status_association": f"""{REQUESTS}
, ranked AS (
  SELECT section, status, rank() OVER w + (count(*) OVER (PARTITION BY section, ms) - 1) / 2.0::DOUBLE AS rank,
    count(*) OVER (PARTITION BY section, ms) AS ties
  FROM req WINDOW w AS (PARTITION BY section ORDER BY ms)
), per_status AS (
  SELECT section, status, count(*) AS m, sum(rank) AS ranks, sum(ties * ties - 1.0::DOUBLE) AS tied
  FROM ranked GROUP BY section, status
), put AS (
  SELECT section, CAST(sum(m) AS BIGINT) AS requests, count(*) AS statuses,
    sum(ranks * ranks / m) AS squares, sum(tied) AS tied, sum(m)::DOUBLE AS n
  FROM per_status GROUP BY section
), tested AS (
  SELECT *, CASE WHEN statuses > 1 AND n > statuses AND tied < n * (n * n - 1)
    THEN (12 * squares / (n * (n + 1)) - 3 * (n + 1)) / (1 - tied / (n * (n * n - 1))) END AS h FROM put
)
SELECT section, requests, statuses, round(h, 6) AS h, round((h - statuses + 1) / (n - statuses), 6) AS eta_squared
FROM tested""",
    "regressions_significant": f"""{REQUESTS}
, timed AS (
  SELECT section, run, ms * CASE WHEN run = 'B' AND section IN ('section-01', 'section-07')
    THEN 1.5 ELSE 1.0 END AS ms FROM req
), per AS (
  SELECT section, run, quantile_cont(ms, {_P}) AS p, list_sort(list(ms)) AS v,
    CAST(floor(count(*) * {_P}::DOUBLE - sqrt(count(*)::DOUBLE) * {_SPREAD!r}::DOUBLE) AS BIGINT) AS lo,
    CAST(floor(count(*) * {_P}::DOUBLE + sqrt(count(*)::DOUBLE) * {_SPREAD!r}::DOUBLE) AS BIGINT) AS hi
  FROM timed GROUP BY section, run
), held AS (
  SELECT section, run, p, CASE WHEN lo >= 0 THEN v[lo + 1] END AS lower,
    CASE WHEN hi < len(v) THEN v[hi + 1] END AS upper FROM per
)
SELECT section, round(a.p, 1) AS a_ms, round(a.upper, 1) AS a_upper_ms, round(b.lower, 1) AS b_lower_ms,
  round(b.p, 1) AS b_ms, coalesce(b.lower > a.upper, false) AS significant
FROM (FROM held WHERE run = 'A') a FULL JOIN (FROM held WHERE run = 'B') b USING (section)""",
    "breach_spans": f"""{REQUESTS}
, per AS (SELECT run, time_bucket(INTERVAL 1 HOUR, ts) AS b, ms FROM req),
ends AS (SELECT DISTINCT run, b FROM per),
slid AS (
  SELECT e.run, e.b, quantile_cont(p.ms, 0.95) AS q FROM ends e JOIN per p
  ON p.run = e.run AND p.b <= e.b AND p.b > e.b - INTERVAL 3 HOUR GROUP BY e.run, e.b
), over_limit AS (
  SELECT *, b - INTERVAL 1 HOUR * row_number() OVER (PARTITION BY run ORDER BY b) AS island
  FROM slid WHERE q > 140
)
SELECT run AS run_id, min(b) AS started, max(b) AS ended, count(*) AS windows,
  round(max(q), 1) AS worst_p95_ms
FROM over_limit GROUP BY run, island""",
    "first_breach": f"""{REQUESTS}
SELECT bucket, reqs, round(p95, 1) AS p95_ms FROM (
  SELECT time_bucket(INTERVAL 1 HOUR, ts) AS bucket, count(*) AS reqs,
         quantile_cont(ms, 0.95) AS p95 FROM req GROUP BY 1)
WHERE p95 > 200 ORDER BY bucket LIMIT 1""",
    "metric_history": f"""{REQUESTS}
, per_run AS (SELECT section, day_run AS run_id, quantile_cont(ms, 0.95) AS p
              FROM req GROUP BY section, day_run),
starts AS (SELECT day_run AS run_id, min(ts) AS start_time FROM req
           GROUP BY day_run
           HAVING day_run NOT IN ('day-2024-01-05', 'day-2024-01-06'))
SELECT section, run_id, start_time, round(p, 6) AS p95_ms,
  CASE WHEN start_time IS NOT NULL THEN
    round(p - lag(p) OVER (PARTITION BY section, start_time IS NULL ORDER BY start_time), 6)
  END AS change_ms
FROM per_run LEFT JOIN starts USING (run_id)""",
    "flatten_rows": SAMPLES + _DIRTY,
    "flatten_edge_texts": _EDGE_TEXTS,
    "submetric_split": f"""{SAMPLES}
SELECT CASE WHEN failed AND http THEN metric_name || '{{status:500}}' ELSE metric_name END
    AS metric_name,
  CASE WHEN failed AND http THEN metric_name END AS submetric_parent,
  CASE WHEN failed AND http THEN 'status:500' END AS submetric_suffix, count(*) AS n
FROM smp GROUP BY ALL""",
    "containers_exploded": f"""{SAMPLES}
SELECT metric_name, count(*) AS n, round(sum(v), 4) AS total FROM smp GROUP BY metric_name""",
    "unknown_labels": f"""{SAMPLES}
SELECT metric_name, 'summary' AS metric_type, count(*) AS n
FROM smp WHERE event_id % 40 = 0 GROUP BY metric_name""",
    "empty_batch": f"""{SAMPLES}
SELECT metric_name, count(*) AS n FROM smp GROUP BY 1""",
    "order_by_p95": f"""{REQUESTS}
SELECT section, row_number() OVER (ORDER BY round(quantile_cont(ms, 0.95), 1) DESC, section) AS place
FROM req GROUP BY section""",
    "order_of_deltas": REQUESTS + _ORDERED_DELTAS,
    "order_by_three_keys": f"""{SAMPLES}
SELECT section, check_name,
  row_number() OVER (ORDER BY round(100 * avg(v), 2), section, check_name) AS place
FROM smp WHERE check_name IS NOT NULL GROUP BY section, check_name""",
    "custom_tag_percentiles": f"""{REQUESTS}
SELECT 'team-' || (user_id % 4) AS tag, count(*) AS samples,
  round(quantile_cont(ms, 0.95), 6) AS p95_ms FROM req GROUP BY 1""",
    "custom_tag_filter": f"""{REQUESTS}
SELECT section, count(*) AS requests, round(100.0 * sum(failed::INT) / count(*), 2) AS error_pct
FROM req WHERE user_id % 4 = 1 GROUP BY section""",
    "sample_table_scan": f"{SAMPLES} SELECT run AS run_id, metric_name, {_TOTALS} GROUP BY 1, 2",
    "sample_table_rebalanced": f"""{SAMPLES} SELECT day_run AS run_id, metric_name, {_TOTALS}
WHERE http GROUP BY 1, 2""",
    "run_replaced": f"""{SAMPLES} SELECT run AS run_id, metric_name, {_TOTALS}
WHERE run = 'A' OR metric_name = 'http_reqs' GROUP BY 1, 2""",
    "run_replaced_by_metric": f"""{SAMPLES} SELECT run AS run_id,
  CASE WHEN metric_name = 'vus' THEN '' ELSE metric_name END AS metric_name, {_TOTALS}
WHERE metric_name IN ('vus', 'http_reqs') GROUP BY 1, 2""",
    "run_replaced_empty": f"""{SAMPLES}
SELECT run AS run_id, CAST(sum(CAST(run = 'A' AS INTEGER)) AS BIGINT) AS sample_count,
  CAST(sum(CAST(run = 'A' AS INTEGER)) AS BIGINT) AS n
FROM smp GROUP BY 1""",
    "mixed_versions_read": f"""{SAMPLES}
SELECT metric_name, metric_type, CASE WHEN http THEN section END AS section, count(*) AS n,
  round(sum(v), 4) AS total, min(date_trunc('milliseconds', ts)) AS first,
  max(date_trunc('milliseconds', ts)) AS last
FROM smp GROUP BY 1, 2, 3""",
    "row_groups_per_file": f"""{SAMPLES}
SELECT run AS run_id, count(*) AS n, true AS cap_kept, true AS in_order,
  min(metric_name) AS first_metric, max(metric_name) AS last_metric
FROM smp GROUP BY 1""",
    "option_checks": """
SELECT CASE WHEN user_id % 10 = 0 THEN 'no path given to write samples to'
  WHEN floor(value) <= 0 THEN 'row_group_size: at least 1 is needed, '
    || CAST(floor(value) AS BIGINT) || ' was given'
  WHEN event_id % 5 = 0 THEN 'page_size: at least 1 is needed, 0 was given'
  WHEN event_id % 6 >= 4 THEN chr(39) || CASE event_id % 6 WHEN 4 THEN 'lz4' ELSE 'brotli' END
    || chr(39) || ' is no known codec; there are zstd, snappy, gzip, uncompressed'
  WHEN user_id % 4 = 0 THEN 'push_interval: 0s is no time span'
  ELSE 'accepted' END AS answer, count(*) AS n
FROM events GROUP BY 1""",
    "run_files_compared": REQUESTS + _COMPARED.format(b="run = 'B'"),
    "runs_concatenated": f"""{SAMPLES}
SELECT run AS run_id, CASE WHEN run = 'B' THEN check_name END AS check_name, count(*) AS n
FROM smp GROUP BY 1, 2""",
    "run_footer_pairs": SAMPLES + _FOOTER,
    "run_script_options": """
SELECT printf('{"iterations":%d,"vus":12}', count(*)) AS value, 12::INTEGER AS vus,
  count(*) AS iterations FROM events""",
    "runs_from_footers": f"""{SAMPLES}
SELECT 'nightly-1' AS run_id, 'nightly' AS run_name, '1.2.3' AS tool_version,
  count(*) AS sample_count, 1000::BIGINT AS row_group_size,
  TIMESTAMP '2024-01-01 00:00:00' AS start_time,
  TIMESTAMP '2024-01-31 01:02:03.5' AS end_time, 30::INTEGER AS days
FROM smp""",
    "schema_version_check": f"{SAMPLES} SELECT '1' AS schema_version, count(*) AS samples FROM smp",
    "nanosecond_files": f"""{SAMPLES}
SELECT epoch_us(ts) * 1000 + event_id % 1000 AS ts_unix_nano, ts, event_id, metric_name,
  check_name AS "check" FROM smp""",
    "run_records": f"""{SAMPLES}
SELECT run AS run_id, '1' AS schema_version, count(*) AS sample_count, 'zstd' AS compression,
  100000::BIGINT AS row_group_size, TIMESTAMP '2024-01-01 00:00:00' AS start_time,
  max(ts) AS end_time, '{{"vus":3}}' AS script_options
FROM smp GROUP BY run""",
    "run_summaries": f"""{SAMPLES}
SELECT day_run AS run_id, count(*) AS sample_count, min(ts) AS start_time, max(ts) AS end_time
FROM smp GROUP BY day_run""",
    "redacted_options": """
SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN
  printf('{"duration":null,"stages":[{"duration":"1m","target":%d}],"vus":%d}',
         event_id % 9, user_id) END AS script_options
FROM events""",
    "runs_attached": f"""{SAMPLES}
SELECT CASE WHEN day_run < 'day-2024-01-25' THEN 'host-' || right(day_run, 1) END AS hostname,
  count(*) AS n, count(DISTINCT day_run) AS runs
FROM smp GROUP BY 1""",
    "runs_joined_external": f"""{SAMPLES}
SELECT day_run AS run_id, count(*) AS sample_count, any_value(n_name) AS annotation
FROM smp LEFT JOIN nation ON day_run = printf('day-2024-01-%02d', n_nationkey + 1)
GROUP BY day_run""",
    "raw_json_source": f"""{SAMPLES}
SELECT metric_name, CASE WHEN http AND event_id % 97 <> 0 THEN status END AS status,
  count(*) AS n FROM smp GROUP BY 1, 2""",
    "stream_ingest": f"{SAMPLES} SELECT 'live' AS run_id, metric_name, {_TOTALS} GROUP BY 2",
    "stream_finalised": f"""{SAMPLES}
SELECT 'live' AS run_id, count(*) AS sample_count,
  TIMESTAMP '2024-01-01 00:00:00' AS start_time, max(ts) AS end_time FROM smp""",
    "stream_two_runs": f"{SAMPLES} SELECT run AS run_id, metric_name, {_TOTALS} GROUP BY 1, 2",
    "stream_then_batch": f"{SAMPLES} SELECT run AS run_id, metric_name, {_TOTALS} GROUP BY 1, 2",
    "stream_replayed_after_compaction": f"{SAMPLES} SELECT 'live' AS run_id, metric_name, {_TOTALS} GROUP BY 2",
    "stream_during_compaction": f"{SAMPLES} SELECT 'live' AS run_id, metric_name, {_TOTALS} GROUP BY 2",
    "stream_two_live_series": _throughput("time_bucket(INTERVAL 1 HOUR, ts)"),
    "stream_throughput": _throughput("time_bucket(INTERVAL 1 HOUR, ts)"),
    "stream_throughput_sketch": f"""{REQUESTS}
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS bucket, count(*) AS reqs, max(users) AS vus,
  true AS p95_ok
FROM req GROUP BY 1""",
}
