"""Sink options, run tables, portable files, footers, redaction."""

import json
import re
from datetime import UTC, datetime, timedelta

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loadgrain.operators.runs import RunInfo, attach_runs, redact_options, with_duration
from loadgrain.plans.events import samples_from_events
from loadgrain.schema import SAMPLE_COLUMNS, SAMPLES
from loadgrain.sources import footers, provenance, versions
from loadgrain.sources.provenance import duration_text, instant_text
from loadgrain.sources.samples import (
    SinkOptions,
    compact_run,
    concatenate,
    label_by_source,
    read_runs,
    read_samples,
    write_load,
    write_run,
    write_runs,
    write_samples,
)

START = datetime(2025, 2, 3, 4, 5, 6, tzinfo=UTC)


@pytest.fixture(scope="module")
def samples(spark, sf_dir):
    return samples_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def two_rows(spark):
    base = dict.fromkeys(SAMPLE_COLUMNS)
    trend = base | {
        "ts_unix_nano": 1_738_555_506_000_000_013, "metric_name": "http_req_duration",
        "metric_type": "trend", "value_type": "time", "value": 87.25, "group": "", "status": 418,
        "vu": 11, "iter": 204, "extra_tags": {"region": "north"},
    }
    counter = base | {
        "ts_unix_nano": 1, "metric_name": "data_sent", "metric_type": "counter",
        "value_type": "data", "value": 512.0,
    }
    rows = [tuple(r[c] for c in SAMPLE_COLUMNS) for r in (trend, counter)]
    return spark.createDataFrame(rows, SAMPLES)


# ---- options -------------------------------------------------------------------


def test_defaults():
    options = SinkOptions("/x")
    assert (options.push_interval, options.compression) == ("1s", "zstd")
    assert (options.row_group_size, options.page_size) == (100_000, 1_048_576)


@pytest.mark.parametrize(
    ("bad", "message"),
    [
        ({"compression": "zstd"}, "no path given"),
        ({"path": "/x", "push_interval": "-3ms"}, "push_interval"),
        ({"path": "/x", "push_interval": "soon"}, "push_interval"),
        ({"path": "/x", "row_group_size": -7}, "row_group_size: at least 1"),
        ({"path": "/x", "row_group_size": "many"}, "row_group_size"),
        ({"path": "/x", "page_size": 0}, "page_size: at least 1"),
        ({"path": "/x", "compression": "brotli"}, "no known codec"),
        ({"path": "/x", "colour": "red"}, "unknown sink options: colour"),
    ],
)
def test_bad_options(bad, message):
    with pytest.raises(ValueError, match=message):
        SinkOptions.layered(bad)


def test_later_layers_win():
    first = {"path": "/first", "push_interval": "7s", "compression": "snappy"}
    second = {"path": "/second", "compression": "GZIP"}
    options = SinkOptions.layered(first, second)
    assert (options.path, options.push_interval, options.compression) == ("/second", "7s", "gzip")
    assert SinkOptions.layered(first, second, path="/third").path == "/third"


# ---- run tables ------------------------------------------------------------------


@pytest.mark.parametrize("codec", ["zstd", "snappy", "gzip", "uncompressed"])
def test_codec_and_row_groups(samples, tmp_path, codec):
    options = SinkOptions(f"file://{tmp_path}/t", compression=codec, row_group_size=1000)
    write_samples(samples.where("run_id = 'A'").coalesce(1), options)
    (file,) = (tmp_path / "t").glob("run_id=A/load=*/*.parquet")
    meta = pq.read_metadata(file)
    assert meta.row_group(0).column(0).compression == codec.upper()
    assert max(meta.row_group(i).num_rows for i in range(meta.num_row_groups)) <= 1000
    assert meta.row_group(0).column(4).statistics.has_min_max
    assert meta.schema.names[: len(SAMPLE_COLUMNS) - 2] == list(SAMPLE_COLUMNS[:-2])


def test_rerun_replaces_only_its_run(spark, samples, tmp_path):
    options = SinkOptions(str(tmp_path / "t"))
    write_samples(samples, options)
    before = dict(read_samples(spark, options.path).groupBy("run_id").count().collect())
    write_samples(samples.where("run_id = 'A' AND metric_name = 'vus'"), options)
    after = dict(read_samples(spark, options.path).groupBy("run_id").count().collect())
    assert after["B"] == before["B"] and 0 < after["A"] < before["A"]


def test_rewriting_leaves_nothing_in_either_layout(spark, samples, tmp_path):
    options = SinkOptions(str(tmp_path / "t"))
    write_samples(samples, options, by_metric=True)
    write_samples(samples.where("metric_name = 'http_reqs'"), options)
    kept = read_samples(spark, options.path).select("metric_name").distinct().collect()
    assert kept == [("http_reqs",)]
    assert write_run(samples.where("false"), RunInfo(run_id="A"), options) == 0
    assert {r[0] for r in read_samples(spark, options.path).select("run_id").collect()} == {"B"}


def test_empty_metric_names_are_kept(spark, samples, tmp_path):
    options = SinkOptions(str(tmp_path / "t"))
    write_samples(samples.limit(5).withColumn("metric_name", F.lit("")), options, by_metric=True)
    assert read_samples(spark, options.path).where("metric_name = ''").count() == 5


def test_a_repeated_load_replaces_itself(spark, samples, tmp_path):
    options = SinkOptions(str(tmp_path / "t"))
    for load in ("one", "two", "one"):
        write_load(samples.where("metric_name = 'vus'"), options, load)
    assert read_samples(spark, options.path).count() == 2 * samples.where("metric_name = 'vus'").count()


def test_compacted_run(spark, samples, tmp_path):
    """Many loads become few files, sorted, with row groups filled to their cap."""
    options = SinkOptions(str(tmp_path / "t"), row_group_size=400)
    mine = samples.where("run_id = 'A'")
    for third in range(3):
        write_load(mine.where(F.col("event_id") % 3 == third).repartition(4), options, f"s-{third}")
    before = sorted(map(tuple, read_samples(spark, options.path).select("iter", "metric_name", "value").collect()))
    compact_run(spark, options, "A")
    assert before == sorted(
        map(tuple, read_samples(spark, options.path).select("iter", "metric_name", "value").collect())
    )
    files = list((tmp_path / "t").glob("run_id=A/*/*.parquet"))
    assert len({f.parent for f in files}) == 1 and len(files) < 12
    for file in files:
        meta = pq.read_metadata(file)
        sizes = [meta.row_group(i).num_rows for i in range(meta.num_row_groups)]
        assert set(sizes[:-1]) <= {400} and sizes[-1] <= 400


def test_run_ids_stay_text(spark, samples, tmp_path):
    options = SinkOptions(str(tmp_path / "t"))
    write_samples(samples.where("run_id = 'A'").withColumn("run_id", F.lit("0815")), options)
    assert read_samples(spark, options.path).select("run_id").distinct().collect() == [("0815",)]


def test_single_run_folders(spark, samples, tmp_path):
    options = SinkOptions(str(tmp_path / "t"))
    write_samples(samples, options)
    whole = dict(read_samples(spark, options.path).groupBy("run_id").count().collect())
    both = read_samples(spark, f"{options.path}/run_id=A", f"{options.path}/run_id=B")
    assert dict(both.groupBy("run_id").count().collect()) == whole
    only = read_samples(spark, f"{options.path}/run_id=B")
    assert dict(only.groupBy("run_id").count().collect()) == {"B": whole["B"]}


def test_rows_are_clustered_by_metric(samples, tmp_path):
    options = SinkOptions(str(tmp_path / "t"), row_group_size=500)
    write_samples(samples.coalesce(1), options)
    for file in (tmp_path / "t").glob("*/*/*.parquet"):
        meta = pq.read_metadata(file)
        column = meta.schema.names.index("metric_name")
        bounds = [
            meta.row_group(i).column(column).statistics for i in range(meta.num_row_groups)
        ]
        assert all(a.max <= b.min for a, b in zip(bounds, bounds[1:], strict=False))


def rows_scanned(df) -> int:
    """Rows that the scan of ``df`` handed on."""
    df.collect()
    todo, found = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        if node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    assert len(found) == 1
    return found[0]


def test_row_groups_without_a_section_are_not_read(spark, samples, tmp_path):
    """A name between those there are: statistics let it pass, bloom filters don't."""
    options = SinkOptions(f"{tmp_path}/t", row_group_size=2000)
    write_samples(samples, options)
    written = read_samples(spark, options.path)
    of = lambda section: written.where((F.col("name") == section) & (F.col("metric_name") == "http_reqs"))
    there, absent = of("section-05").select("value"), of("section-05x").select("value")
    assert rows_scanned(there) > 0 and there.count() > 0
    assert rows_scanned(absent) == 0
    assert rows_scanned(written.where("`check` = 'has a pagf'").select("value")) == 0
    (file, *_) = (tmp_path / "t").rglob("*.parquet")
    column = pq.read_metadata(file).row_group(0).column(4)
    assert column.has_offset_index and column.has_column_index


def test_run_record_counts_what_was_written(spark, samples, tmp_path):
    options = SinkOptions(str(tmp_path / "t"))
    run = RunInfo(run_id="r1", start_time=START, script_options='{"vus": 1, "cloud": {}}')
    mine = samples.where("run_id = 'A'")
    written = write_run(mine, run, options, str(tmp_path / "runs"))
    (record,) = with_duration(read_runs(spark, str(tmp_path / "runs"))).collect()
    assert written == record.sample_count == mine.count()
    assert record.script_options == '{"vus":1}'
    last = mine.agg(F.max("ts_unix_nano")).first()[0]
    assert record.end_time == datetime(1970, 1, 1) + timedelta(microseconds=last // 1000)
    assert isinstance(record.duration, timedelta)


def test_nothing_written_for_no_rows(spark, samples, tmp_path):
    options = SinkOptions(str(tmp_path / "t"))
    written = write_run(samples.where("false"), RunInfo(run_id="none"), options)
    assert written == 0 and not list((tmp_path / "t").glob("run_id=*"))


def test_random_run_ids_differ():
    assert RunInfo().run_id != RunInfo().run_id


# ---- portable files --------------------------------------------------------------


@pytest.fixture(scope="module")
def portable(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("portable") / "run"
    run = RunInfo(
        run_id="r1",
        start_time=START,
        end_time=START + timedelta(seconds=61.5),
        script_options='{"vus": 5, "tlsAuth": [{"key": "pw-7731"}]}',
    )
    provenance.write_portable_run(
        two_rows(spark), run, SinkOptions(str(path)), namespace="other", generator="loader",
        single_file=True,
    )
    return path


def test_round_trip(spark, portable):
    rows = {r.metric_name: r for r in read_samples(spark, str(portable)).collect()}
    assert set(rows) == {"http_req_duration", "data_sent"}
    trend = rows["http_req_duration"]
    assert (trend.value, trend.group, trend.status, trend.vu, trend.iter) == (87.25, "", 418, 11, 204)
    assert trend.ts_unix_nano == 1_738_555_506_000_000_013
    assert trend.extra_tags == {"region": "north"} and trend.extra_metadata is None
    assert rows["data_sent"].scenario is None and rows["data_sent"].ts_unix_nano == 1


def test_footer(spark, portable):
    pairs = dict(provenance.run_metadata(spark, str(portable)).collect())
    assert pairs["other.schema_version"] == "1" and pairs["other.compression"] == "zstd"
    assert pairs["other.sample_count"] == "2" and pairs["other.test_run_id"] == "r1"
    assert pairs["other.loader_version"] == "unknown"
    assert pairs["other.start_time"] == "2025-02-03T04:05:06Z"
    assert pairs["other.end_time"] == "2025-02-03T04:06:07.5Z"
    assert pairs["other.duration"] == "1m1.5s"
    assert list(pairs) == sorted(pairs) and "other.script_options" not in pairs
    assert dict(provenance.run_metadata(spark, str(portable), namespace="other").collect()) == pairs
    assert provenance.run_metadata(spark, str(portable), namespace="none").count() == 0


def test_footer_leaks_nothing(spark, portable):
    pairs = provenance.read_footers(spark, str(portable)).where("key NOT LIKE 'ARROW%'").collect()
    assert not any("pw-7731" in r.value or "tlsAuth" in r.value for r in pairs)
    (options,) = provenance.footer_value(spark, "script_options", str(portable)).collect()
    assert json.loads(options.value) == {"vus": 5}


def test_others_can_read_it(portable):
    (file,) = portable.glob("*.parquet")
    assert pq.read_schema(file).field("ts_unix_nano").type == pa.timestamp("ns", tz="UTC")
    assert pq.read_schema(file).names == list(SAMPLE_COLUMNS)
    sql = f"SELECT count(*), max(extra_tags['region']) FROM read_parquet('{file}')"
    assert duckdb.sql(sql).fetchall() == [(2, "north")]


def test_footer_paths(spark, portable):
    (file,) = portable.glob("*.parquet")
    whole = provenance.read_footers(spark, str(portable)).count()
    for paths in ([str(file)], [f"file://{file}"], [str(file)[:-9] + "*"], [f"{portable}*"]):
        assert provenance.read_footers(spark, *paths).count() == whole
    assert provenance.read_footers(spark, str(file), str(file)).count() == 2 * whole


def test_tasks_list_folders_and_share_files(spark, portable, tmp_path, monkeypatch):
    (file,) = portable.glob("*.parquet")
    for i in range(5):
        (tmp_path / f"f{i}.parquet").write_bytes(file.read_bytes())
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "deep" / "er" / "g.parquet").write_bytes(file.read_bytes())
    (tmp_path / "_hidden").mkdir()
    (tmp_path / "_hidden" / "h.parquet").write_bytes(b"no footer at all")
    monkeypatch.setattr(footers, "FILES_PER_TASK", 2)
    parts = footers.RunFooterReader({"path": str(tmp_path)}).partitions()
    assert [p.path for p in parts] == [str(tmp_path)] * 3 + [str(tmp_path / "deep")]
    assert [len(p.files()) for p in parts] == [2, 2, 1, 1]
    assert len({f for p in parts for f in p.files()}) == 6
    assert provenance.schema_versions(spark, str(tmp_path)).count() == 6
    with pytest.raises(FileNotFoundError):
        footers.RunFooterReader({"path": str(tmp_path / "none")}).partitions()


def test_filters_reach_the_footers(spark, portable, tmp_path):
    (file,) = portable.glob("*.parquet")
    (tmp_path / "good.parquet").write_bytes(file.read_bytes())
    pairs = provenance.read_footers(spark, str(tmp_path))
    key = "other.test_run_id"
    for condition in (
        F.col("key") == key, F.col("key").isin(key, "x"), F.col("key").endswith(".test_run_id"),
        F.col("key").startswith("other.test_run_i"),
    ):
        kept = pairs.where(condition)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"\bFilter\b", plan)
        assert [(r.key, r.value) for r in kept.collect()] == [(key, "r1")]
    # A file that is not asked for is not opened.
    (tmp_path / "bad.parquet").write_bytes(b"no footer at all")
    good = f"{tmp_path}/good.parquet"
    asked = provenance.read_footers(spark, str(tmp_path)).where(F.col("file").endswith("/good.parquet"))
    assert {r.file.removeprefix("file:") for r in asked.collect()} == {good}
    with pytest.raises(Exception, match="magic"):
        provenance.read_footers(spark, str(tmp_path)).collect()
    # Other conditions are left to Spark.
    some = provenance.read_footers(spark, good).where(F.length("value") > 30).where(F.col("key") != key)
    assert some.count() < provenance.read_footers(spark, good).count()


def test_row_groups(spark, samples, tmp_path):
    options = SinkOptions(f"{tmp_path}/t", row_group_size=300)
    write_samples(samples.where("run_id = 'A'").coalesce(1), options)
    groups = provenance.read_row_groups(spark, options.path).orderBy("row_group").collect()
    assert sum(g.n_rows for g in groups) == samples.where("run_id = 'A'").count()
    assert max(g.n_rows for g in groups) <= 300 and len({g.file for g in groups}) == 1
    assert [g.first_metric for g in groups] == sorted(g.first_metric for g in groups)
    pq.write_table(pa.table({"x": [1]}), tmp_path / "plain.parquet")
    (plain,) = provenance.read_row_groups(spark, f"{tmp_path}/plain.parquet").collect()
    assert (plain.row_group, plain.n_rows, plain.first_metric) == (0, 1, None)


def _older_file(spark, path):
    footers.register(spark)
    rows = spark.createDataFrame([(1, "x", "2.5"), (2, None, "n/a")], "at_ms long, metric string, amount string")
    pairs = '{"loadgrain.schema_version": "0"}'
    rows.coalesce(1).write.format("run_file").mode("overwrite").option("footer", pairs).save(str(path))


def test_files_of_several_versions_are_read_as_one(spark, portable, tmp_path):
    older = versions.Layout(
        "at_ms BIGINT, metric STRING, amount STRING",
        lambda rows: rows.select(
            "source_file", (F.col("at_ms") * 1_000_000).alias("ts_unix_nano"),
            F.col("metric").alias("metric_name"), F.col("amount").try_cast("double").alias("value"),
        ),
    )
    _older_file(spark, tmp_path / "old")
    (file,) = portable.glob("*.parquet")
    (tmp_path / "old" / "new.parquet").write_bytes(file.read_bytes())
    with pytest.raises(ValueError, match="no layout for schema version '0', as of .*/old/"):
        read_samples(spark, str(tmp_path / "old"))
    versions.register_layout("0", older)
    try:
        both = read_samples(spark, str(tmp_path / "old"), source_file=True)
        assert both.count() == 4 and both.columns[-1] == "source_file"
        rows = {(r.metric_name, r.ts_unix_nano, r.value) for r in both.collect()}
        assert {("x", 1_000_000, 2.5), (None, 2_000_000, None)} <= rows
        assert len({r.source_file for r in both.collect()}) == 2
    finally:
        del versions.LAYOUTS["0"]


def test_files_without_footers_are_of_today(spark, tmp_path):
    pq.write_table(pa.table({"ts_unix_nano": [7], "metric_name": ["m"], "value": [1.0]}), tmp_path / "p.parquet")
    (row,) = read_samples(spark, str(tmp_path)).collect()
    assert (row.ts_unix_nano, row.metric_name, row.value, row.status) == (7, "m", 1.0, None)


def test_runs_from_footers(spark, portable):
    (run,) = provenance.runs_from_footers(provenance.read_footers(spark, str(portable))).collect()
    assert (run.run_id, run.sample_count, run.tool_version) == ("r1", 2, "unknown")
    assert run.end_time - run.start_time == timedelta(seconds=61.5)


def test_schema_version_guard(spark, portable, tmp_path):
    provenance.require_schema_version(spark, str(portable))
    with pytest.raises(ValueError, match="unsupported schema version"):
        provenance.require_schema_version(spark, str(portable), supported=("2",))
    pq.write_table(pa.table({"x": [1]}), tmp_path / "plain.parquet")
    with pytest.raises(ValueError, match="None"):
        provenance.require_schema_version(spark, str(tmp_path / "plain.parquet"))


def test_overwrite_and_many_tasks(spark, samples, tmp_path):
    path, rows = str(tmp_path / "run"), samples.where("run_id = 'A'")
    options = SinkOptions(f"file://{path}", row_group_size=100, compression="gzip")
    for _ in range(2):
        provenance.write_portable_run(rows.repartition(3), RunInfo(run_id="A"), options)
    files = sorted((tmp_path / "run").iterdir())
    assert len(files) == 3 and not any(f.name.startswith(".") for f in files)
    for file in files:
        meta = pq.read_metadata(file)
        sizes = [meta.row_group(i).num_rows for i in range(meta.num_row_groups)]
        assert set(sizes[:-1]) <= {100} and sizes[-1] <= 100
        assert meta.metadata[b"loadgrain.sample_count"] == str(meta.num_rows).encode()
    assert read_samples(spark, path).count() == rows.count()


def test_failed_write_leaves_nothing(spark, samples, tmp_path):
    boom = samples.withColumn("value", F.when(F.col("iter") == 500, F.raise_error("boom"))
                              .otherwise(F.col("value")))
    path = tmp_path / "run"
    with pytest.raises(Exception, match="boom"):
        provenance.write_portable_run(boom, RunInfo(), SinkOptions(str(path)))
    assert not path.exists() or not list(path.glob("*.parquet"))


def test_writer_commits_and_aborts(tmp_path):
    batch = pa.record_batch({"ts_unix_nano": [1, 2], "value": [1.0, 2.0]})
    options = {"path": str(tmp_path), "footer": '{"a": "b"}', "row_group_size": "1"}
    writer = footers.RunFileWriter(options, overwrite=False)
    kept, lost = writer.write(iter([batch])), writer.write(iter([batch, batch]))
    assert writer.write(iter([])).final is None and lost.rows == 4
    assert all(f.name.startswith(".") for f in tmp_path.iterdir())
    other = footers.RunFileWriter(options, overwrite=True)
    other.write(iter([batch]))
    other.abort([])
    writer.commit([kept, None])
    (file,) = tmp_path.iterdir()
    assert pq.read_metadata(file).num_row_groups == 2

    def broken():
        yield batch
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        writer.write(broken())
    assert list(tmp_path.iterdir()) == [file]

    renewed = footers.RunFileWriter(options, overwrite=True)
    renewed.commit([renewed.write(iter([batch]))])
    assert [f.name == file.name for f in tmp_path.iterdir()] == [False]


def test_nanosecond_file(spark, tmp_path):
    stamps = pa.array([1, 1_700_000_000_123_456_789], pa.timestamp("ns", tz="UTC"))
    pq.write_table(pa.table({"ts_unix_nano": stamps, "value": [1.0, 2.0]}), tmp_path / "f.parquet")
    rows = read_samples(spark, str(tmp_path / "f.parquet"), run_id="x").orderBy("value").collect()
    assert [r.ts_unix_nano for r in rows] == [1, 1_700_000_000_123_456_789]
    assert rows[1].ts == datetime(2023, 11, 14, 22, 13, 20, 123456)
    assert rows[0].run_id == "x" and rows[0].metric_name is None


def test_labels_by_file_or_folder(spark, samples, tmp_path):
    vus = samples.where("metric_name = 'vus'")
    for name in ("a run", "a+run"):
        vus.coalesce(1).write.parquet(f"{tmp_path}/{name}")
    (file,) = (tmp_path / "a+run").glob("*.parquet")
    both = read_samples(spark, f"{tmp_path}/a run", str(file), source_file=True)
    labelled = label_by_source(both, {"A": f"{tmp_path}/a run/", "B": f"file:{file}"})
    counts = dict(labelled.groupBy("run").count().collect())
    assert counts == {"A": vus.count(), "B": vus.count()}
    only_a = label_by_source(both, {"A": f"{tmp_path}/a"})
    assert only_a.where("run IS NOT NULL").count() == 0


def test_tables_are_concatenated(spark, samples, tmp_path):
    for name in ("t1", "t2"):
        options = SinkOptions(f"{tmp_path}/{name}")
        write_samples(samples.where("metric_name = 'vus'").withColumn("run_id", F.lit(name)),
                      options)
    both = concatenate(read_samples(spark, f"{tmp_path}/{name}") for name in ("t1", "t2"))
    assert {r[0] for r in both.select("run_id").distinct().collect()} == {"t1", "t2"}
    with pytest.raises(ValueError, match="nothing"):
        concatenate([])


# ---- redaction and joins -----------------------------------------------------------


@pytest.mark.parametrize(
    ("given", "kept"),
    [
        ('{"vus": 5, "tlsAuth": [{"domains": ["a.example"], "key": "-----"}], "hosts": {"h": "::1"}}', '{"vus":5}'),
        ('{"collectors": {"c": {"login": "me"}}, "env": {"TOKEN": "abc"}}', "{}"),
        ('{"vus": null, "VUS": 3}', '{"vus":null}'),
        ('{"thresholds": {"a": ["p(95)<5"]}, "tags": {"x": "y"}, "duration": "1m"}',
         '{"duration":"1m","tags":{"x":"y"},"thresholds":{"a":["p(95)<5"]}}'),
        ("[1]", None), ("not json", None), ("", None), (None, None), ("3", None),
    ],
)
def test_redaction(spark, given, kept):
    frame = spark.createDataFrame([(given,)], "o string")
    assert frame.select(redact_options("o")).first()[0] == kept


def test_runs_table_keeps_no_secrets(spark, tmp_path):
    from loadgrain.operators.runs import run_record

    run = RunInfo(script_options='{"ext": {"apiKey": "pw-7731"}, "iterations": 3}')
    write_runs(run_record(spark, run, 0, "zstd", 1), str(tmp_path / "runs"))
    files = list((tmp_path / "runs").rglob("*.parquet"))
    assert files and not any(b"pw-7731" in f.read_bytes() for f in files)


def test_unknown_runs_are_kept(spark, samples):
    runs = spark.createDataFrame([("A", "host")], "run_id string, hostname string")
    joined = attach_runs(samples, runs)
    assert joined.count() == samples.count()
    assert {r[0] for r in joined.select("hostname").distinct().collect()} == {"host", None}
    twice = attach_runs(samples, runs.union(runs).unionByName(runs))
    assert twice.count() == samples.count()


# ---- texts -------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("micros", "text"),
    [
        (0, "0s"), (1, "1µs"), (1500, "1.5ms"), (999_999, "999.999ms"), (1_000_000, "1s"),
        (61_500_000, "1m1.5s"), (3_600_000_000, "1h0m0s"), (90_061_000_001, "25h1m1.000001s"),
        (-2_000_000, "-2s"),
    ],
)
def test_duration_text(micros, text):
    assert duration_text(START, START + timedelta(microseconds=micros)) == text


def test_instant_text():
    assert instant_text(START.replace(microsecond=120)) == "2025-02-03T04:05:06.00012Z"
    assert re.fullmatch(r"[0-9T:.-]+Z", instant_text(datetime.now()))


def test_files_state_their_own_end(spark, tmp_path):
    run = RunInfo(run_id="open", start_time=START)
    provenance.write_portable_run(two_rows(spark), run, SinkOptions(str(tmp_path / "run")))
    pairs = dict(provenance.run_metadata(spark, str(tmp_path / "run")).collect())
    end = datetime.fromisoformat(pairs["loadgrain.end_time"])
    assert timedelta(0) <= datetime.now(UTC) - end < timedelta(minutes=5)
    assert pairs["loadgrain.duration"] == duration_text(START, end)
    assert pairs["loadgrain.hostname"]
