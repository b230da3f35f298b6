"""What the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadgrain.session import settle

#: Documents of this remainder are kept out of every fit, to measure models on.
HELD_OUT_REMAINDER, FOLDS = 2, 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the held-out quarter of the documents; false for a NULL id."""
    fold = F.crc32(F.col(doc_id).cast("string")) % FOLDS
    return F.coalesce(fold == HELD_OUT_REMAINDER, F.lit(False))


def share_of(key: Column, share: float, seed: int) -> Column:
    """Keeps about ``share`` of all rows, always the same ones."""
    slots = 1 << 30
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(slots)) < F.lit(int(min(1.0, share) * slots))


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node it reaches) of every linked node.

    ``edges`` has two BIGINT columns ``a`` and ``b``. Large-star and small-star
    steps in turn: every node links its larger neighbours, then its smaller
    ones, to the smallest node among them. Nothing gathers a node's neighbours,
    only their minimum; each step is a table in the shared folder.
    """
    here = settle(
        edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .where("hi <> lo")
        .distinct(),
        "edges",
    )
    before = None
    while True:
        both = here.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            here.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = settle(
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("hi"), F.least("u", "m").alias("lo"))
            .distinct(),
            "large-star",
        )
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        joined = large.join(least, "hi")
        here = settle(
            joined.where("lo <> m")
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .unionByName(least.select("hi", F.col("m").alias("lo")))
            .distinct(),
            "small-star",
        )
        now = here.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if now == before:
            break
        before = now
    # Every node but the roots points to its root.
    roots = here.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return here.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots)
