"""Document fingerprints: bottom-k sketches of shingle hashes, in SQL functions only.

A sketch is the sorted array of the k smallest distinct hashes of a text's word
shingles. Sketches of parts merge into the sketch of the whole. Two sketches
estimate resemblance, containment and the number of distinct shingles; below k
shingles all three are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadgrain.session import settle

SHINGLE_WORDS = 5
SKETCH_SIZE = 128
#: Stands for a NULL id where rows are put in order: after all others, descending.
NO_ID = -(1 << 63)


def words(text: Column) -> Column:
    """What ASCII white space separates."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def sketch(text: Column, shingle: int = SHINGLE_WORDS, k: int = SKETCH_SIZE) -> Column:
    """The sketch of a text; empty for a NULL text or one without words.

    A text with fewer words than a shingle has one shingle, all its words.
    """
    return _sketch_words(words(F.coalesce(text, F.lit(""))), shingle, k)


def _sketch_words(parts: Column, shingle: int, k: int) -> Column:
    # Through a one-element array, so that the words are split once and not per use.
    def of(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - (shingle - 1), F.lit(1)))
        hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, shingle)))
        return F.when(F.size(w) > 0, hashes).otherwise(F.array().cast("array<bigint>"))

    hashes = F.transform(F.array(parts), of)[0]
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merged(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """The sketch of both parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def distinct_count(s: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    share = (F.element_at(s, k).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / share)


def resemblance(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated share of common shingles; 1 for two empty sketches."""

    def share(pair: Column) -> Column:
        common = F.array_intersect(pair["u"], F.array_intersect(pair["a"], pair["b"]))
        return F.size(common).cast("double") / F.size(pair["u"])

    pair = F.struct(merged(a, b, k).alias("u"), a.alias("a"), b.alias("b"))
    found = F.transform(F.array(pair), share)[0]
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(found)


def containment(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has too; 1 if ``a`` has none."""
    both = resemblance(a, b, k) * distinct_count(merged(a, b, k), k)
    share = F.least(F.lit(1.0), both / distinct_count(a, k))
    return F.when(F.size(a) == 0, 1.0).otherwise(share)


def as_text(s: Column) -> Column:
    """A sketch in print: 16 hexadecimal digits a hash, in order."""
    digits = F.transform(s, lambda x: F.lpad(F.hex(x), 16, "0"))
    return F.lower(F.array_join(digits, ""))


def following(keys: DataFrame) -> DataFrame:
    """``id``, ``t`` and the ``next_id``, ``next_t`` of distinct keys; the first's after the last.

    The order is that of descending ``id``, then of ``t``. Keys are dealt into ranges,
    chained inside each, and the ranges by their ends, of which there are as many as
    partitions.
    """
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.struct(F.bitwise_not("id").alias("down"), F.col("t"))
    dealt = settle(
        keys.select("id", "t")
        .distinct()
        .repartitionByRange(n, F.desc("id"), F.asc("t"))
        .select("id", "t", place.alias("place"), F.spark_partition_id().alias("part")),
        "ids",
    )
    ends = dealt.groupBy("part").agg(F.min("place").alias("top"))
    in_order = Window.orderBy("top")  # one row per partition
    ends = ends.select(
        "part",
        F.coalesce(
            F.lead("top").over(in_order),
            F.min("top").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("after"),
    )
    inside = F.lead("place").over(Window.partitionBy("part").orderBy("place"))
    after = F.coalesce("inside", "after")
    return (
        dealt.withColumn("inside", inside)
        .join(ends, "part")
        .select("id", "t", F.bitwise_not(after["down"]).alias("next_id"), after["t"].alias("next_t"))
    )


def edit_likeness(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint against that of its edited text and of the next document.

    The edited text has the last third of the code points (rounded down)
    replaced by as many from the start of the next document, in descending
    order of ``doc_id``; after the last comes the first. A NULL text counts as
    empty, a NULL id comes last. Rows that repeat an id are documents of their own, in
    an order of their texts' hashes.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"), text.alias("text")
    ).withColumn("t", F.xxhash64("text"))
    # Rows that repeat id and text: one is followed by the next document, the others by
    # their like.
    texts = rows.groupBy("id", "t").agg(F.first("text").alias("text"))
    sized = texts.select("id", "t", "text", F.char_length("text").cast("bigint").alias("n_chars"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    # Apart from the texts, which would be shuffled once more to be counted.
    lengths = rows.select("id", "t", F.char_length("text").cast("bigint").alias("n_chars"))
    counted = lengths.groupBy("id", "t").agg(F.first("n_chars").alias("n_chars"), F.count("*").alias("times"))
    one = F.lit(1).cast("bigint")
    link = lambda i, t, n: F.struct(F.col(i).alias("next_id"), F.col(t).alias("next_t"), n.alias("n"))
    both = F.array(link("next_id", "next_t", one), link("id", "t", F.col("times") - 1))
    # How much each document wants goes to the next one, and only that much comes back.
    wanted = (
        counted.select("id", "t", "times", third.alias("third"))
        .join(following(rows.select("id", "t")), ["id", "t"])
        .select("id", "t", "third", F.inline(F.filter(both, lambda x: x["n"] > 0)))
    )
    heads = (
        sized.select(F.col("id").alias("next_id"), F.col("t").alias("next_t"), "text")
        .join(wanted, ["next_id", "next_t"])
        .select(
            "id",
            "t",
            "n",
            F.substring(F.col("text"), F.lit(1), F.col("third")).alias("head"),
            sketch(F.col("text")).alias("next_sketch"),
        )
    )
    kept = F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - third)
    both = (
        sized.join(heads, ["id", "t"])
        .select("id", "n", "n_chars", "text", F.concat(kept, "head").alias("edited"), "next_sketch")
        .select(
            "id",
            "n",
            "n_chars",
            F.sha2(F.col("edited"), 256).alias("edited_sha256"),
            sketch(F.col("text")).alias("own"),
            sketch(F.col("edited")).alias("changed"),
            "next_sketch",
        )
    )
    own, changed = F.col("own"), F.col("changed")
    found = both.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"),
        "n",
        "n_chars",
        "edited_sha256",
        as_text(own).alias("fingerprint"),
        as_text(changed).alias("edited_fingerprint"),
        resemblance(own, changed).alias("near_edited"),
        resemblance(own, F.col("next_sketch")).alias("near_next"),
    )
    return found.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), "n"))).drop("n", "col")
