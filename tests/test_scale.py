"""What keeps tasks, files and shuffles bounded."""

import gzip

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from loadgrain.operators.flatten import flatten_samples
from loadgrain.operators.runs import RunInfo
from loadgrain.plans import registry
from loadgrain.schema import RAW
from loadgrain.sources import footers, provenance
from loadgrain.sources.samples import SinkOptions, read_samples, write_run


def test_small_row_groups_make_small_files_of_bounded_footers(spark, sf_dir, tmp_path):
    mine = registry.samples_of(spark, sf_dir).coalesce(1)
    write_run(mine, RunInfo(run_id="A"), SinkOptions(str(tmp_path), row_group_size=10))
    files = list(tmp_path.glob("run_id=A/*/*.parquet"))
    groups = [pq.read_metadata(f).num_row_groups for f in files]
    assert max(groups) <= 200 and len(files) > 1
    # Each of six filters took 64 kB or more of a group.
    assert sum(f.stat().st_size for f in files) < 20_000 * sum(groups)
    assert read_samples(spark, str(tmp_path)).count() == mine.count()


def test_portable_runs_are_batched_by_rows_and_settings_come_back(spark, sf_dir, tmp_path, monkeypatch):
    keys = [f"spark.sql.execution.arrow.max{what}PerBatch" for what in ("Bytes", "Records")]
    before, seen = [spark.conf.get(k) for k in keys], []
    scoped = footers.batches_by_rows

    def watched(session):
        seen.append(session)
        return scoped(session)

    monkeypatch.setattr(footers, "batches_by_rows", watched)
    samples = registry.samples_of(spark, sf_dir)
    provenance.write_portable_run(samples, RunInfo(run_id="A"), SinkOptions(str(tmp_path / "run")))
    assert len(seen) == 1
    assert [spark.conf.get(k) for k in keys] == before
    with scoped(spark):
        assert [spark.conf.get(k) for k in keys] == [str(2**31 - 1), str(footers.BATCH_ROWS)]
    assert read_samples(spark, str(tmp_path / "run")).count() == samples.count()


def test_texts_are_parsed_once(spark):
    wide = flatten_samples(spark.createDataFrame([], RAW))
    wide = wide.select("status", "vu", F.col("extra_tags")["status"], F.col("extra_metadata")["vu"])
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    # Of the columns asked for: two parsed for themselves, and those that what spills depends on.
    assert plan.count("RLIKE") == 4
    assert plan.count("map_filter") == 2


def test_events_are_spread_over_tasks_by_their_number(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(registry, "EVENTS_PER_TASK", 300)
    n = registry.events_of(spark, sf_dir).count()
    spread = registry.samples_of(spark, sf_dir, spread=True)
    assert spread.rdd.getNumPartitions() == -(-n // 300)
    maps = "extra_tags", "extra_metadata"
    rows = [df.drop(*maps) for df in (spread, registry.samples_of(spark, sf_dir))]
    assert rows[0].exceptAll(rows[1]).count() == rows[1].exceptAll(rows[0]).count() == 0


def test_raw_samples_land_in_small_compressed_files(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "LANDING_ROWS", 500)
    raw = registry.raw_of(spark, sf_dir).drop("run_id", "event_id")
    registry._land(raw, str(tmp_path / "landing"))
    lines = [len(gzip.decompress(f.read_bytes()).splitlines()) for f in (tmp_path / "landing").glob("*.json.gz")]
    assert max(lines) <= 500 and sum(lines) == raw.count()
