"""Streaming ingest and the live time series."""

import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from loadgrain.functions.timebuckets import sample_time
from loadgrain.operators.flatten import flatten_samples
from loadgrain.operators.runs import RunInfo
from loadgrain.operators.timeline import throughput_over_time
from loadgrain.sources.raw import read_raw, stream_raw
from loadgrain.sources.ledger import Ledger
from loadgrain.sources.samples import (
    Compaction,
    SinkOptions,
    compact_run,
    read_runs,
    read_samples,
    write_run,
)
from loadgrain.streaming import live
from loadgrain.streaming.ingest import finalise_run, start_ingest

SECOND = 1_000_000_000


def line(second, value=1.0, metric="http_req_duration", **tags):
    return {
        "ts_unix_nano": second * SECOND,
        "value": value,
        "metric": {"name": metric, "type": "trend", "contains": "time"},
        "tags": tags,
        "metadata": {"vu": "1"},
    }


def land(folder, name, lines):
    folder.mkdir(exist_ok=True)
    hidden = folder / f".{name}"
    hidden.write_text("\n".join(json.dumps(item) for item in lines))
    hidden.rename(folder / f"{name}.json")


def test_late_samples_are_kept_and_drained(spark, tmp_path):
    landing, options = tmp_path / "in", SinkOptions(str(tmp_path / "out"), push_interval="200ms")
    land(landing, "one", [line(1_000_000 + i) for i in range(10)])
    raw = stream_raw(spark, str(landing))
    query = start_ingest(raw, options, str(tmp_path / "cp"), run_id="r")
    try:
        query.processAllAvailable()
        assert read_samples(spark, options.path).count() == 10
        assert sum(p.numInputRows for p in query.recentProgress) == 10
    finally:
        query.stop()

    land(landing, "late", [line(5, name="late")])
    start_ingest(raw, options, str(tmp_path / "cp"), "r", drain=True).awaitTermination()
    rows = read_samples(spark, options.path)
    assert rows.count() == 11 and rows.where("name = 'late'").count() == 1

    # A second drain finds nothing new and writes nothing twice.
    start_ingest(raw, options, str(tmp_path / "cp"), "r", drain=True).awaitTermination()
    assert read_samples(spark, options.path).count() == 11

    run = RunInfo(run_id="r", start_time=datetime(1970, 1, 1, tzinfo=UTC))
    for _ in range(2):
        finalise_run(spark, run, options, str(tmp_path / "runs"))
    (record,) = read_runs(spark, str(tmp_path / "runs")).collect()
    assert record.sample_count == 11
    assert record.end_time == datetime.fromtimestamp(1_000_009, UTC).replace(tzinfo=None)


def test_unwritten_run_is_finalised_as_empty(spark, tmp_path):
    options = SinkOptions(str(tmp_path / "out"))
    (tmp_path / "out").mkdir()
    record = finalise_run(spark, RunInfo(run_id="x"), options, str(tmp_path / "runs"))
    assert record.first().sample_count == 0


def test_container_stream(spark, tmp_path):
    land(tmp_path / "in", "c", [{"samples": [line(1), line(2)]}, {"samples": []}])
    options = SinkOptions(str(tmp_path / "out"))
    raw = stream_raw(spark, str(tmp_path / "in"), containers=True)
    start_ingest(raw, options, str(tmp_path / "cp"), "r", drain=True).awaitTermination()
    assert read_samples(spark, options.path).count() == 2
    assert read_raw(spark, str(tmp_path / "in"), containers=True).count() == 2


def test_many_streams_and_batches_in_one_table(spark, tmp_path):
    options = SinkOptions(str(tmp_path / "table"))
    for run, n in (("one", 10), ("two", 20)):
        land(tmp_path / run, "a", [line(i, float(i)) for i in range(n)])
        raw = stream_raw(spark, str(tmp_path / run))
        start_ingest(raw, options, str(tmp_path / f"cp-{run}"), run, drain=True).awaitTermination()
    batch = read_samples(spark, options.path).where("run_id = 'one'")
    write_run(batch.withColumn("value", batch["value"] + 1), RunInfo(run_id="three"), options)
    counts = dict(read_samples(spark, options.path).groupBy("run_id").count().collect())
    assert counts == {"one": 10, "two": 20, "three": 10}


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    """The last batch runs again if a stream dies between writing and committing it."""
    options, checkpoint = SinkOptions(str(tmp_path / "table")), tmp_path / "cp"
    land(tmp_path / "in", "a", [line(i) for i in range(7)])
    raw = stream_raw(spark, str(tmp_path / "in"))
    start_ingest(raw, options, str(checkpoint), "r", drain=True).awaitTermination()
    for kept in (checkpoint / "commits").iterdir():
        kept.unlink()
    start_ingest(raw, options, str(checkpoint), "r", drain=True).awaitTermination()
    assert read_samples(spark, options.path).count() == 7


def drained(spark, tmp_path, options, checkpoint="cp", run="r", landing="in"):
    raw = stream_raw(spark, str(tmp_path / landing))
    start_ingest(raw, options, checkpoint, run, drain=True).awaitTermination()


def forget_last_commit(checkpoint):
    last = max((f for f in (checkpoint / "commits").iterdir() if f.name.isdigit()), key=lambda f: int(f.name))
    last.unlink()
    last.with_name(f".{last.name}.crc").unlink()


def test_a_batch_repeated_after_compaction_adds_nothing(spark, tmp_path, monkeypatch):
    options, checkpoint = SinkOptions(str(tmp_path / "table")), tmp_path / "cp"
    for name in "ab":
        land(tmp_path / "in", name, [line(i, name=name) for i in range(7)])
        drained(spark, tmp_path, options, str(checkpoint))
    compact_run(spark, options, "r")
    forget_last_commit(checkpoint)
    monkeypatch.chdir(tmp_path)
    drained(spark, tmp_path, options, f"file:{checkpoint}/")  # the same, spelt differently
    assert read_samples(spark, options.path).count() == 14
    # Further batches count as ever, also after the run was written again.
    land(tmp_path / "in", "c", [line(i) for i in range(3)])
    drained(spark, tmp_path, options, str(checkpoint))
    assert read_samples(spark, options.path).count() == 17
    write_run(read_samples(spark, options.path).limit(5), RunInfo(run_id="r"), options)
    forget_last_commit(checkpoint)
    drained(spark, tmp_path, options, str(checkpoint))
    assert read_samples(spark, options.path).count() == 5


def test_compaction_keeps_what_arrives_meanwhile(spark, tmp_path):
    options = SinkOptions(str(tmp_path / "table"))

    def arrive(name):
        land(tmp_path / "in", name, [line(i) for i in range(10)])
        drained(spark, tmp_path, options, str(tmp_path / "cp"))

    count = lambda: read_samples(spark, options.path).count()
    arrive("a")
    arrive("b")
    lost = Compaction(spark, options, "r")
    lost.write()  # a job that dies here leaves a load nobody sees
    assert count() == 20
    compaction = Compaction(spark, options, "r")
    arrive("c")
    compaction.write()
    assert count() == 30
    compaction.commit()  # and one that dies here is finished by the next
    assert count() == 30
    assert len(list((tmp_path / "table" / "run_id=r").glob("load=s-*"))) == 3
    arrive("d")
    Compaction(spark, options, "r")
    assert len(list((tmp_path / "table" / "run_id=r").glob("load=s-*"))) == 2
    assert count() == 40
    compact_run(spark, options, "r")
    assert count() == 40 and len(Ledger(spark, options.path).loads("run_id=r")) == 1


def test_runs_with_odd_names_are_compacted(spark, tmp_path):
    options = SinkOptions(str(tmp_path / "table"))
    land(tmp_path / "in", "a", [line(i) for i in range(4)])
    for run in ("a/b=c d", "0815", "2024-01-01"):
        drained(spark, tmp_path, options, str(tmp_path / f"cp-{run[:2]}"), run)
        compact_run(spark, options, run)
    counts = dict(read_samples(spark, options.path).groupBy("run_id").count().collect())
    assert counts == {"a/b=c d": 4, "0815": 4, "2024-01-01": 4}


def test_a_replacing_write_that_fails_leaves_the_run(spark, tmp_path):
    options = SinkOptions(str(tmp_path / "table"))
    land(tmp_path / "in", "a", [line(i) for i in range(4)])
    drained(spark, tmp_path, options, str(tmp_path / "cp"))
    rows = read_samples(spark, options.path)
    broken = rows.withColumn("value", F.when(F.col("value") > 0, F.raise_error(F.lit("broken"))))
    with pytest.raises(Exception, match="broken"):
        write_run(broken, RunInfo(run_id="r"), options)
    assert read_samples(spark, options.path).count() == 4
    assert not list((tmp_path / "table" / "_ledger" / "open").glob("*.writing"))


def test_increments_fold_and_stay_few(spark, tmp_path, monkeypatch):
    """Spans of batches fold tier by tier; repeated batches change nothing."""
    monkeypatch.setattr(live, "FOLD", 3)
    spans = live.Spans(spark, str(tmp_path / "live"))
    schema = "bucket timestamp, role string, value double, n bigint"

    def add(stream, batch):
        at = datetime(2024, 1, 1, tzinfo=UTC)
        rows = spark.createDataFrame([(at, "request", None, 1), (at, "duration", float(batch), 2)], schema)
        live.add_increments(spans, stream, batch, rows, live._folded_counts)

    folders = []
    for batch in range(20):
        add("one", batch)
        if batch % 4 == 0:
            add("one", batch)
        folders.append(len(list((tmp_path / "live" / "stream=one").iterdir())))
    add("two", 0)
    add("one", 17)  # long folded
    counts = live.read_value_counts(spark, str(tmp_path / "live"))
    totals = dict(counts.groupBy("role").agg(F.sum("n")).collect())
    assert totals == {"request": 21, "duration": 42}
    assert spans.counted("one") == [(0, 8), (9, 17), (18, 18), (19, 19)]
    assert max(folders) <= 10
    assert counts.where("value = 5").agg(F.sum("n")).first()[0] == 2


def test_an_empty_live_series(spark, tmp_path):
    path = str(tmp_path / "none")
    assert live.throughput_from_counts(live.read_value_counts(spark, path)).collect() == []
    assert live.throughput_from_sketches(live.read_bucket_sketches(spark, path)).collect() == []


@pytest.mark.parametrize("exact", [True, False])
def test_live_equals_batch_also_for_late_samples(spark, tmp_path, exact):
    lines = []
    for i in range(600):
        second = 1_000_000 + i // 10
        lines.append(line(second, float(i % 37)))
        lines.append(line(second, 1.0, "http_reqs"))
        if i % 50 == 0:
            lines.append(line(second, float(i // 50), "vus"))
            lines.append(line(second, 5.0, "data_received"))
    for at, part in enumerate((lines[900:], lines[300:900], lines[:300])):
        land(tmp_path / "in", f"{at}", part)
    landing = str(tmp_path / "in")

    table = SinkOptions(str(tmp_path / "table"))
    start_ingest(stream_raw(spark, landing), table, str(tmp_path / "cp1"), "r",
                 drain=True).awaitTermination()
    batch = throughput_over_time(read_samples(spark, table.path)).collect()
    assert len(batch) == 12

    stream = flatten_samples(stream_raw(spark, landing, maxFilesPerTrigger="1")).withColumn(
        "ts", sample_time()
    )
    start = live.start_value_counts if exact else live.start_bucket_sketches
    path, checkpoint = str(tmp_path / "live"), str(tmp_path / "cp2")
    start(stream, path, checkpoint, drain=True).awaitTermination()
    if exact:
        assert live.throughput_from_counts(live.read_value_counts(spark, path)).collect() == batch
    else:
        found = live.throughput_from_sketches(live.read_bucket_sketches(spark, path)).collect()
        assert [(r.bucket, r.reqs, r.vus) for r in found] == [(r.bucket, r.reqs, r.vus) for r in batch]
        assert all(abs(a.p95_ms - b.p95_ms) <= 2 for a, b in zip(found, batch, strict=True))
