"""What the plans look like: pushdown, pruning, shuffles, broadcasts."""

import re

import pytest
from pyspark.sql import functions as F

from loadgrain.functions import percentiles
from loadgrain.operators import comparison, latency, requests, runs, timeline
from loadgrain.plans.events import runs_from_events, samples_from_events
from loadgrain.session import scratch_root, settle
from loadgrain.sources.samples import SinkOptions, read_runs, read_samples, write_samples


def scan(df) -> tuple[str, str, str]:
    """Partition filters, pushed filters and columns read, of the first scan."""
    text = re.sub(r"\s+", " ", df._jdf.queryExecution().executedPlan().toString())
    found = re.search(
        r"PartitionFilters: \[(.*?)\], PushedFilters: \[(.*?)\], ReadSchema: struct<(.*?)>", text
    )
    return found.groups()


@pytest.fixture(scope="module")
def tables(spark, sf_dir, tmp_path_factory):
    samples = samples_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"), run_by="day")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    root = tmp_path_factory.mktemp("tables")
    write_samples(samples, SinkOptions(f"{root}/runs"))
    write_samples(samples, SinkOptions(f"{root}/metrics"), rebalance=True, by_metric=True)
    return str(root)


@pytest.fixture
def table(spark, tables):
    return read_samples(spark, f"{tables}/runs")


REPORTS = {
    latency.latency_percentiles: {"metric_name", "value", "name"},
    requests.request_phases: {"metric_name", "value", "name"},
    requests.check_pass_rate: {"metric_name", "value", "group", "check"},
    requests.error_rate: {"metric_name", "value", "name"},
    requests.status_distribution: {"metric_name", "name", "status"},
    requests.iteration_balance: {"metric_name", "name"},
    requests.latency_histogram: {"metric_name", "value"},
    requests.script_overhead: {"metric_name", "value", "name", "group"},
    requests.bytes_received: {"metric_name", "value", "group"},
    requests.phase_averages: {"metric_name", "metric_type", "value", "name"},
    latency.status_timing: {"metric_name", "value", "status"},
    timeline.throughput_over_time: {"metric_name", "value", "ts_unix_nano"},
}


# Reports with percentiles settle their picks first: plans of their own.
PERCENTILES = (latency.latency_percentiles, latency.status_timing, timeline.throughput_over_time)
PLAIN = [r for r in REPORTS if r not in PERCENTILES]


@pytest.mark.parametrize("report", PLAIN, ids=lambda r: r.__name__)
def test_scans_read_and_push_what_they_need(table, report):
    _, pushed, columns = scan(report(table))
    assert {c.split(":")[0] for c in columns.split(",")} == REPORTS[report]
    assert "metric_name" in pushed.replace("IsNotNull(metric_name)", "")


@pytest.mark.parametrize("report", PLAIN, ids=lambda r: r.__name__)
def test_one_shuffle_to_group_and_none_in_python(table, report):
    physical = table.sparkSession and report(table)._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Exchange hashpartitioning") == 1
    assert "Python" not in physical and "CartesianProduct" not in physical
    assert "SinglePartition" not in physical


@pytest.mark.parametrize("report", PERCENTILES, ids=lambda r: r.__name__)
def test_percentiles_read_one_metric_and_what_they_need(table, report, monkeypatch):
    texts, real = [], percentiles.settle
    physical = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(
        percentiles, "settle", lambda df, label: texts.append(physical(df)) or real(df, label)
    )
    texts.append(physical(report(table)))
    scans = [
        found
        for text in texts
        for found in re.findall(
            r"PushedFilters: \[(.*?)\], ReadSchema: struct<(.*?)>", re.sub(r"\s+", " ", text)
        )
        if "metric_name" in found[1]
    ]
    pushed = [x for x in scans if "EqualTo(metric_name,http_req_duration)" in x[0]]
    # The durations are read once, the metric pushed; only a series counts all samples as well.
    assert len(pushed) == 1
    assert len(scans) == (2 if report is timeline.throughput_over_time else 1)
    assert sum(t.count("rangepartitioning(__key") for t in texts) == 1
    for _, columns in scans:
        assert {c.split(":")[0] for c in columns.split(",")} <= REPORTS[report]
    assert not any("Python" in t or "Pandas" in t or "CartesianProduct" in t for t in texts)
    assert sum(t.count("MapInArrow") for t in texts) == 1


def test_run_folders_are_pruned(table):
    folders, _, _ = scan(requests.error_rate(table.where("run_id = 'day-2024-01-02'")))
    assert "day-2024-01-02" in folders


def test_files_by_metric_give_the_same(spark, tables):
    by_metric = read_samples(spark, f"{tables}/metrics")
    a = requests.request_phases(by_metric).collect()
    assert a == requests.request_phases(read_samples(spark, f"{tables}/runs")).collect()


def test_a_dominant_run_is_split_again(spark, tables, tmp_path):
    """Rows of two runs scattered over tasks: a file each, but several for the large one."""
    samples = read_samples(spark, f"{tables}/runs")
    hot = F.when(F.col("iter") % 20 == 0, "cold").otherwise("hot")
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.05",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        scattered = samples.repartition(8).withColumn("run_id", hot)
        write_samples(scattered, SinkOptions(str(tmp_path)), rebalance=True)
    finally:
        for key in settings:
            spark.conf.unset(key)
    files = {run: len(list(tmp_path.glob(f"run_id={run}/*/*.parquet"))) for run in ("hot", "cold")}
    assert files["hot"] > 1 and files["cold"] <= 2
    assert read_samples(spark, str(tmp_path)).count() == samples.count()


def test_top_k_is_not_a_full_sort(table):
    physical = latency.slowest_requests(table)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in physical and "Exchange" not in physical


def test_settled_frames_are_broadcast_only_while_small(spark, table, monkeypatch):
    def physical():
        return latency.tail_outliers(table)._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in physical()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        large = physical()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in large and "Broadcast" not in large


def test_run_attributes_by_size(spark, sf_dir, table, tmp_path):
    records = runs_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
    records.write.parquet(str(tmp_path / "runs"))
    stored = read_runs(spark, str(tmp_path / "runs")).select("run_id", "hostname")
    joined = runs.attach_runs(table, stored)
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == table.count()


def test_history_windows_are_partitioned(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    history = comparison.metric_history(
        samples_from_events(events, run_by="day"), runs_from_events(events)
    )
    physical = history._jdf.queryExecution().executedPlan().toString()
    assert "Window" in physical and "SinglePartition" not in physical


class Session:
    """Just what the scratch folder is looked up in."""

    def __init__(self, configured, master):
        self.conf = {"spark.checkpoint.dir": configured} if configured else {}
        self.sparkContext, self.master, self.folder = self, master, None

    def getCheckpointDir(self):
        return self.folder and f"file:{self.folder}/id"

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_scratch_folder_comes_from_the_session():
    assert scratch_root(Session("hdfs:///shared/", "yarn")) == "hdfs:///shared"
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        scratch_root(Session(None, "yarn"))
    local = Session(None, "local[2]")
    assert scratch_root(local) == scratch_root(local) == f"{local.folder}/id"


def test_settled_frames_lie_in_the_scratch_folder(spark):
    kept = settle(spark.range(5), "five")
    (file,) = {f.rsplit("/", 1)[0] for f in kept.inputFiles()}
    assert kept.count() == 5 and f"{scratch_root(spark).removeprefix('file:')}/five-" in file
