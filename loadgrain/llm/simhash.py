"""SimHash fingerprints and near-duplicates.

``fingerprint_components`` links documents whose 64-bit fingerprints differ in
few bits; ``keep_one`` keeps one row of each component.

Python only turns texts into fingerprints, in Arrow batches; all linking is
DataFrame joins. Nothing is dropped or capped: blocks shared by many
fingerprints take another, equally complete way.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadgrain.llm.common import connected_components
from loadgrain.session import settle

SHINGLE_WORDS = 3
SEED = 42
MAX_DISTANCE = 2
#: Pieces of a fingerprint. Two that differ in at most two bits agree on two of
#: four pieces, so the blocks are all pairs of pieces: six keys of 32 bits.
PIECES, PIECE_BITS = 4, 16
#: Blocks with more fingerprints than this are linked by midpoints.
PAIRED_BLOCK = 64

# For each byte, a 64-bit word with bit i of the byte (from its low end) in byte i.
_SPREAD = (
    (np.arange(256, dtype=np.uint64)[:, None] >> np.arange(8, dtype=np.uint64)) & np.uint64(1)
).astype(np.uint8)
_SPREAD = np.ascontiguousarray(_SPREAD).view("<u8").ravel()


def majority(hashes: np.ndarray) -> np.ndarray:
    """Bits set in over half of the rows; rows and result are 64-bit words.

    Counts eight bits at once: up to 255 rows add up in the bytes of a word.
    """
    octets = hashes.astype("<u8").view(np.uint8).reshape(len(hashes), -1)
    counts = np.zeros((octets.shape[1], 8), dtype=np.int64)
    for at in range(0, len(octets), 255):
        sums = _SPREAD[octets[at : at + 255]].sum(axis=0, dtype=np.uint64)
        counts += sums.astype("<u8").view(np.uint8).reshape(-1, 8)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").ravel().view("<u8")


def simhash64(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """SimHash of word shingles, repeats included; 0 for a text without words.

    Words are what ASCII white space separates, with A-Z in lower case.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    grams = [b" ".join(g) for g in zip(*(parts[i:] for i in range(words)), strict=False)]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(g, SEED) for g in grams or [b" ".join(parts)]]
    return int(majority(np.array(hashes, dtype=np.uint64)[:, None])[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id`` and ``fp``, the 64 bits as BIGINT; one row per row of ``docs``."""

    def run(batches):
        for batch in batches:
            values = [simhash64(t.as_py(), words) for t in batch.column(1)]
            fp = pa.array(np.array(values, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fp], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, fp bigint"
    )


def _piece(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, i * PIECE_BITS).bitwiseAND((1 << PIECE_BITS) - 1)


def _block_rows(fps: DataFrame) -> DataFrame:
    """One row per fingerprint and block: ``pieces`` (which), ``key``, ``fp``."""
    fp = F.col("fp")
    blocks = [
        F.struct(
            F.lit((1 << i) | (1 << j)).alias("pieces"),
            F.shiftleft(_piece(fp, i), PIECE_BITS).bitwiseOR(_piece(fp, j)).alias("key"),
        )
        for i, j in combinations(range(PIECES), 2)
    ]
    return fps.select("fp", F.inline(F.array(*blocks)))


def fingerprint_links(fps: DataFrame, paired_block: int = PAIRED_BLOCK) -> DataFrame:
    """Links ``a``, ``b`` that join all of ``fps`` (distinct ``fp``) at two bits or fewer.

    Fingerprints at most two bits apart share a block. In blocks of up to
    ``paired_block`` they are joined and their distance verified. In larger
    ones every fingerprint names the words one bit away from it that keep the
    block: two are at most two bits apart exactly if they name a common word.
    At most 65 can name the same word, and all of those are linked to the first.
    So the rows stay linear in the fingerprints, however many share a block.
    """
    blocks = _block_rows(fps)
    sizes = settle(
        blocks.groupBy("pieces", "key").agg(F.count("*").alias("n")).where("n > 1"), "blocks"
    )
    small = blocks.join(sizes.where(F.col("n") <= paired_block), ["pieces", "key"])
    pairs = (
        small.select("pieces", "key", F.col("fp").alias("a"))
        .join(small.select("pieces", "key", F.col("fp").alias("b")), ["pieces", "key"])
        .where(F.col("a") < F.col("b"))
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_DISTANCE)
        .select("a", "b")
    )
    large = blocks.join(sizes.where(F.col("n") > paired_block).drop("n"), ["pieces", "key"])
    in_piece = lambda bit: F.lit(1 << (bit // PIECE_BITS))
    flips = [
        F.when(
            F.col("pieces").bitwiseAND(in_piece(bit)) == 0,
            F.col("fp").bitwiseXOR(F.lit(1 << bit if bit < 63 else -(1 << 63))),
        )
        for bit in range(PIECES * PIECE_BITS)
    ]
    midpoints = (
        large.select("fp", F.explode(F.array(F.col("fp"), *flips)).alias("mid"))
        .where("mid IS NOT NULL")
        .groupBy("mid")
        .agg(F.collect_set("fp").alias("fps"))
        .where(F.size("fps") > 1)
    )
    stars = midpoints.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b"))
    return pairs.unionByName(stars.where("a <> b"))


def _roots(classes: DataFrame) -> DataFrame:
    """``classes`` (one row per ``fp``) with ``root``, the same for all that links reach."""
    labels = settle(connected_components(fingerprint_links(classes.select("fp"))), "labels")
    rooted = classes.join(labels, F.col("fp") == F.col("node"), "left")
    return rooted.select(*classes.columns, F.coalesce("root", "fp").alias("root"))


def fingerprint_components(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint``, ``component_id``.

    A component holds all documents that links of at most two bits reach, and
    is named by its smallest ``doc_id``. A NULL text counts as empty; texts
    without words have fingerprint zero and are linked as any other. Rows that
    repeat an id are separate rows; NULL ids name no component unless alone.
    """
    fps = settle(fingerprints(docs), "fingerprints")
    rooted = _roots(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = settle(rooted.join(named, "root").select("fp", "component_id"), "components")
    return fps.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _fingerprint(text: Column) -> Column:
    """The fingerprint of each text, one text at a time."""

    @F.arrow_udf("bigint")
    def run(texts: pa.Array) -> pa.Array:
        values = [simhash64(t.as_py()) for t in texts]
        return pa.array(np.array(values, dtype=np.uint64).view(np.int64))

    return run(text)


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component of :func:`fingerprint_components`, all columns as they are.

    The one with the smallest ``doc_id`` stays, NULL ids last; of rows that repeat
    that id in a component, one. NULL texts and texts without words have one
    fingerprint, so one of them stays.
    """
    row, fp = "__row", "__fp"
    while {row, fp} & set(docs.columns):
        row, fp = row + "_", fp + "_"
    tagged = docs.withColumn(row, F.monotonically_increasing_id())
    tagged = settle(tagged.withColumn(fp, _fingerprint(docs["text"].cast("string"))), "tagged")
    # The smallest id of a fingerprint first, so that copies never meet in a join.
    own = F.struct(F.col("doc_id").isNull(), F.col("doc_id").cast("bigint"), F.col(row))
    classes = settle(tagged.groupBy(F.col(fp).alias("fp")).agg(F.min(own).alias("own")), "classes")
    roots = settle(_roots(classes), "roots")
    kept = roots.groupBy("root").agg(F.min("own").alias("kept"))
    kept = roots.select(F.col("fp").alias(fp), "root").join(kept, "root").select(fp, "kept")
    # Those that go are fewer than those that stay: whole rows are joined with them.
    gone = tagged.select(row, fp).join(kept, fp).where(F.col(row) != F.col("kept")[row])
    return tagged.join(settle(gone.select(row), "gone"), row, "left_anti").drop(row, fp)
