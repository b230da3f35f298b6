"""Edge rows of flattening."""

import random
import re

import pytest
from pyspark.sql import functions as F

from loadgrain.operators.flatten import explode_containers, flatten_samples, unknown_labels
from loadgrain.schema import RAW, RAW_CONTAINERS, SAMPLE_COLUMNS, SAMPLES


def raw(value=1.0, metric=("m", "trend", "time", None), tags=None, metadata=None, ts=0):
    return (ts, value, metric, tags, metadata)


def flat(spark, *rows):
    return flatten_samples(spark.createDataFrame(list(rows), RAW)).collect()


def test_schema_has_the_26_columns_in_order(spark):
    wide = flatten_samples(spark.createDataFrame([], RAW))
    assert tuple(wide.columns) == SAMPLE_COLUMNS and len(SAMPLE_COLUMNS) == 26
    assert [f.dataType for f in wide.schema] == [f.dataType for f in SAMPLES]
    assert wide.count() == 0


def test_promoted_and_spilled(spark):
    tags = {
        "error_code": "-12", "status": "+0307", "expected_response": "T", "scenario": "nightly",
        "method": "PATCH", "ip": "2001:db8::7", "shard": "eu-3", "": "unnamed",
    }
    meta = {"iter": "0", "vu": "9000000000", "span": "s/1", "parent": ""}
    metric = ("page_weight", "gauge", "data", None)
    (row,) = flat(spark, raw(-0.125, metric, tags, meta, ts=-5))
    assert row.ts_unix_nano == -5 and row.value == -0.125
    assert (row.metric_name, row.metric_type, row.value_type) == metric[:3]
    assert (row.error_code, row.status, row.expected_response) == (-12, 307, True)
    assert (row.scenario, row.method, row.ip) == ("nightly", "PATCH", "2001:db8::7")
    assert (row.vu, row.iter) == (9_000_000_000, 0)
    assert row.extra_tags == {"shard": "eu-3", "": "unnamed"}
    assert row.extra_metadata == {"span": "s/1", "parent": ""}


def test_submetric(spark):
    sub = ("page_weight", "kind:image")
    (row, half) = flat(
        spark,
        raw(metric=("page_weight{kind:image}", "trend", "time", sub)),
        raw(metric=("m", "trend", "time", (None, "kind:image"))),
    )
    assert (row.submetric_parent, row.submetric_suffix) == sub
    assert (half.submetric_parent, half.submetric_suffix) == (None, None)


def test_empty_texts_are_not_null(spark):
    (row,) = flat(spark, raw(tags={"group": "", "name": "", "ip": "", "zone": ""}))
    assert (row.group, row.name, row.ip) == ("", "", "")
    assert row.extra_tags == {"zone": ""} and row.extra_metadata is None


@pytest.mark.parametrize("tags", [None, {}])
def test_no_tags(spark, tags):
    (row,) = flat(spark, raw(metric=("retries", "counter", "default", None), tags=tags))
    assert all(row[c] is None for c in SAMPLE_COLUMNS[5:])


def test_null_metric(spark):
    (row,) = flat(spark, raw(metric=None))
    assert (row.metric_name, row.metric_type, row.value_type) == ("", "", "")


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("+200", 200), ("-1", -1), ("007", 7), ("2147483647", 2147483647),
        ("-2147483648", -2147483648), (" 200", None), ("200 ", None), ("200\n", None),
        ("200.0", None), ("2147483648", None), ("", None), ("1_0", None), ("0x1", None),
        ("cut-off", None), ("٣", None), ("+", None),
    ],
)
def test_status_texts(spark, text, number):
    (row,) = flat(spark, raw(tags={"status": text, "error_code": text}))
    assert (row.status, row.error_code) == (number, number)
    spilled = {"status": text, "error_code": text}
    assert row.extra_tags == (spilled if number is None else None)


@pytest.mark.parametrize(
    ("text", "flag"),
    [
        ("1", True), ("t", True), ("T", True), ("TRUE", True), ("true", True), ("True", True),
        ("0", False), ("f", False), ("F", False), ("FALSE", False), ("false", False),
        ("False", False), ("tRue", None), ("n", None), ("yes", None), ("", None), (" 1", None),
    ],
)
def test_expected_response_texts(spark, text, flag):
    (row,) = flat(spark, raw(tags={"expected_response": text}))
    assert row.expected_response is flag
    assert row.extra_tags == ({"expected_response": text} if flag is None else None)


def test_metadata_out_of_range(spark):
    (row,) = flat(spark, raw(metadata={"vu": "n/a", "iter": "9223372036854775808"}))
    assert row.vu is None and row.iter is None
    assert row.extra_metadata == {"vu": "n/a", "iter": "9223372036854775808"}
    (row,) = flat(spark, raw(metadata={"vu": "9223372036854775807"}))
    assert row.vu == 9223372036854775807 and row.extra_metadata is None


def test_null_tag_value_spills_nothing(spark):
    (row,) = flat(spark, raw(tags={"name": None, "status": "200"}))
    assert row.name is None and row.status == 200 and row.extra_tags is None


def test_containers(spark):
    rows = [([raw(1.0), raw(2.0)],), ([],), ([raw(3.0)],), (None,)]
    exploded = explode_containers(spark.createDataFrame(rows, RAW_CONTAINERS))
    values = flatten_samples(exploded).agg(F.sort_array(F.collect_list("value"))).first()[0]
    assert values == [1.0, 2.0, 3.0]


def test_unknown_labels(spark):
    rows = [raw(), raw(metric=("m", "summary", "time", None)), raw(metric=None)]
    wide = flatten_samples(spark.createDataFrame(rows, RAW))
    assert sorted(r.metric_type for r in unknown_labels(wide).collect()) == ["", "summary"]


def test_random_texts_parse_or_spill(spark):
    """Any text either becomes the number it spells or is kept as it is."""
    rng = random.Random(5)
    texts = ["".join(rng.choices("0123456789+- .\n_ex", k=rng.randint(0, 12))) for _ in range(1500)]
    texts += [str(rng.randint(-(2**33), 2**33)) for _ in range(500)]
    rows = [raw(float(i), tags={"status": t}, metadata={"iter": t}) for i, t in enumerate(texts)]
    for row in flat(spark, *rows):
        text = texts[int(row.value)]
        number = int(text) if re.fullmatch(r"[+-]?[0-9]+", text) else None
        small = number is not None and -(2**31) <= number < 2**31
        assert row.status == (number if small else None), repr(text)
        assert row.iter == number, repr(text)
        assert row.extra_tags == (None if small else {"status": text})
        assert row.extra_metadata == ({"iter": text} if number is None else None)
