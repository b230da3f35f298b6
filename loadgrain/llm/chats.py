"""Chat formatting of logged conversations, in DataFrame functions only.

A log that is written after every turn holds each conversation many times over,
every time a little longer. Rolling hashes over the turns tell which logged
conversations are the beginning of a longer one; what remains is rendered.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadgrain.session import settle


@dataclass(frozen=True)
class Template:
    """How a turn is written; texts are kept as they are."""

    before_role: str = "<|im_start|>"
    before_text: str = "\n"
    after_text: str = "<|im_end|>\n"

    def turn(self, role: Column, text: Column) -> Column:
        parts = (F.lit(self.before_role), role, F.lit(self.before_text), text)
        return F.concat(*parts, F.lit(self.after_text))


def _prefixes(turns: DataFrame) -> DataFrame:
    """One row per turn: ``conv_id``, its place ``i``, and the hash of all up to it.

    The hash rolls on from turn to turn: each turn's own hash, which covers its
    place, is folded into that of the turns before. Two 64-bit lanes.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    said = [F.xxhash64("role").alias("r"), F.xxhash64("text").alias("t"), F.crc32("text").alias("c")]
    placed = turns.select("conv_id", F.row_number().over(order).alias("i"), *said, "turn", "role", "text")
    lane = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "i", "r", "t", "c")).over(upto)
    return placed.select("conv_id", "i", lane(1).alias("h1"), lane(2).alias("h2"))


def maximal_conversations(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``n_turns``, ``n_copies`` of conversations that no other one continues.

    Turns are compared by role and text, in order of ``turn``. Of conversations
    with the same turns the smallest id stays, with the number of all of them.
    NULL roles and texts count as empty; rows without ``conv_id`` belong to no
    conversation and go. Rows that repeat a turn number are further turns, in order
    of role and text.
    """
    prefixes = settle(_prefixes(_tidy(conversations)), "prefixes")
    last = prefixes.groupBy("conv_id").agg(
        F.max("i").alias("n_turns"), F.max_by(F.struct("h1", "h2"), "i").alias("h")
    )
    logged = last.groupBy("n_turns", "h.h1", "h.h2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies")
    )
    # Beginnings proper: a prefix that is not the whole of its conversation.
    beginnings = (
        prefixes.join(last.select("conv_id", "n_turns"), "conv_id")
        .where("i < n_turns")
        .select(F.col("i").alias("n_turns"), "h1", "h2")
        .distinct()
    )
    return logged.join(beginnings, ["n_turns", "h1", "h2"], "left_anti").select(
        "conv_id", "n_turns", "n_copies"
    )


def _tidy(conversations: DataFrame) -> DataFrame:
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return conversations.select("conv_id", "turn", empty("role"), empty("text")).where(
        "conv_id IS NOT NULL"
    )


def render(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """Maximal conversations as one text each: ``conv_id``, ``n_turns``, ``n_copies``, ``text``.

    A conversation becomes one value, so it must fit into a row; nothing else
    has to.
    """
    kept = settle(maximal_conversations(conversations), "maximal")
    line = F.struct(
        "turn", "role", "text", template.turn(F.col("role"), F.col("text")).alias("line")
    )
    return (
        _tidy(conversations)
        .join(kept.select("conv_id"), "conv_id", "left_semi")
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(line)).alias("lines"))
        .join(kept, "conv_id")
        .select("conv_id", "n_turns", "n_copies", F.array_join("lines.line", "").alias("text"))
    )


#: The same in SQL, with whole turns in place of hashes.
RENDERED_SQL = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), whole AS (
  SELECT conv_id, count(*) AS n_turns,
    list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role, text) AS said
  FROM turns GROUP BY conv_id
), logged AS (
  SELECT said, n_turns, min(conv_id) AS conv_id, count(*) AS n_copies
  FROM whole GROUP BY said, n_turns
), beginnings AS (
  SELECT DISTINCT list_slice(said, 1, k) AS said
  FROM whole, unnest(range(1, n_turns)) AS places(k)
)
SELECT conv_id, CAST(n_turns AS INTEGER) AS n_turns, n_copies,
  list_aggregate(list_transform(said,
    lambda x: '<|im_start|>' || x.r || chr(10) || x.t || '<|im_end|>' || chr(10)), 'string_agg', '') AS text
FROM logged ANTI JOIN beginnings USING (said)
"""
