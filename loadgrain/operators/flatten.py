"""Raw samples to wide samples, in column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadgrain.schema import (
    BOOL_TAGS,
    INT_TAGS,
    LONG_METADATA,
    METRIC_TYPES,
    SAMPLE_COLUMNS,
    STRING_TAGS,
    VALUE_TYPES,
)

# The spellings accepted as booleans.
TRUE_WORDS = ("1", "t", "T", "TRUE", "true", "True")
FALSE_WORDS = ("0", "f", "F", "FALSE", "false", "False")


def parse_integer(text: Column, data_type: str) -> Column:
    """Decimal digits with an optional sign, else NULL; NULL too if out of range.

    A cast alone would accept surrounding blanks, and ``$`` a final newline.
    """
    return F.when(text.rlike(r"\A[+-]?[0-9]+\z"), text.try_cast(data_type))


def parse_boolean(text: Column) -> Column:
    """One of the twelve accepted spellings, else NULL."""
    return F.when(text.isin(*TRUE_WORDS), True).when(text.isin(*FALSE_WORDS), False)


def _spill(entries: Column, texts: dict[str, Column], parsed: dict[str, Column]) -> Column:
    """The entries that got no column of their own; NULL when there are none.

    Most samples have none, which their number of entries tells; only the others
    go through the map entry by entry, once.
    """
    taken = F.lit(0)
    for value in (*texts.values(), *parsed.values()):
        taken = taken + value.isNotNull().cast("int")

    def left_over(key: Column, _: Column) -> Column:
        keep = ~key.isin(*texts, *parsed)
        for name, value in parsed.items():
            keep = keep | ((key == name) & value.isNull())
        return keep

    # Through a one-element array, so that the map is filtered once and not per use.
    rest = F.array(F.map_filter(entries, left_over))
    return F.when(F.size(entries) > taken, F.get(F.filter(rest, lambda r: F.size(r) > 0), 0))


def flatten_samples(raw: DataFrame) -> DataFrame:
    """One wide row per raw sample; other columns of ``raw`` pass through.

    Texts that do not parse as the type of their column stay in the map columns,
    so no tag and no metadata entry is lost.
    """
    tags, metadata = F.col("tags"), F.col("metadata")
    text_tags = {name: tags[name] for name in STRING_TAGS}
    typed_tags = {name: parse_integer(tags[name], "int") for name in INT_TAGS}
    typed_tags |= {name: parse_boolean(tags[name]) for name in BOOL_TAGS}
    typed_metadata = {name: parse_integer(metadata[name], "bigint") for name in LONG_METADATA}
    # Texts are parsed in a step of their own: what spills looks at the results again.
    parsed = {f"__{name}": value for name, value in (typed_tags | typed_metadata).items()}
    columns = raw.columns
    raw = raw.select("*", *[value.alias(name) for name, value in parsed.items()])
    typed_tags = {name: F.col(f"__{name}") for name in typed_tags}
    typed_metadata = {name: F.col(f"__{name}") for name in typed_metadata}
    parent = F.col("metric.sub.parent")

    wide = {
        "ts_unix_nano": F.col("ts_unix_nano"),
        "metric_name": F.coalesce("metric.name", F.lit("")),
        "metric_type": F.coalesce("metric.type", F.lit("")),
        "value_type": F.coalesce("metric.contains", F.lit("")),
        "value": F.col("value"),
        "submetric_parent": parent,
        "submetric_suffix": F.when(parent.isNotNull(), F.col("metric.sub.suffix")),
        **text_tags,
        **typed_tags,
        **typed_metadata,
        "extra_tags": _spill(tags, text_tags, typed_tags),
        "extra_metadata": _spill(metadata, {}, typed_metadata),
    }
    consumed = {"ts_unix_nano", "value", "metric", "tags", "metadata"}
    passing = [c for c in columns if c not in consumed]
    return raw.select(*[wide[name].alias(name) for name in SAMPLE_COLUMNS], *passing)


def explode_containers(containers: DataFrame, column: str = "samples") -> DataFrame:
    """Raw samples out of rows that each hold an array of them."""
    others = [c for c in containers.columns if c != column]
    return containers.select(*others, F.inline(column))


def unknown_labels(samples: DataFrame) -> DataFrame:
    """Samples whose metric type or value type is not one of the known labels."""
    known = F.col("metric_type").isin(*METRIC_TYPES) & F.col("value_type").isin(*VALUE_TYPES)
    return samples.where(~F.coalesce(known, F.lit(False)))
