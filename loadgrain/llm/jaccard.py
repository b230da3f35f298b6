"""Jaccard join on word n-grams with rare-first prefix filtering.

All n-grams have one global order, rare ones first. Two sets that resemble each
other by t must share an n-gram among the first ``n - ceil(t * n) + 1`` of each, so
only these prefixes are joined. A pair that meets there has to pass by its lengths,
by the places of the shared n-gram in both orders, and by how many n-grams of each
lie in 64 fixed parts of the suffix; it is then verified once, on the whole sets.

How rare an n-gram is comes from counts over the whole corpus in a fixed number of
slots: any order would give the same links, this one keeps n-grams of passages that
many documents share out of the prefixes. Equal sets are one class before anything
is joined, so copies never meet.

Blocks of a prefix n-gram that many classes share are not paired at once. All are
compared with one of them, then those not yet known to belong together with further
ones, more each round, until no pair of different components is left.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadgrain.llm.common import connected_components
from loadgrain.session import settle

#: Slots of the counts, as bits of the n-gram's hash.
SLOT_BITS = 18
#: Fixed parts whose sizes are compared before sets are.
PARTS = 64
#: Large blocks are compared in squares of about so many by so many classes; the first
#: round sees that many rows of squares.
SQUARE, ROUND = 1024, 4
#: Whole sets are built where a bit tells that they may be needed: so many bits for
#: each that is, as a power of two, and never more than these (32 MB).
BITS_EACH, MOST_BITS = 16, 1 << 28
#: Stands for a NULL id when a class's text is looked up.
NO_ID = (1 << 63) - 1
_REST = np.uint64(64 - SLOT_BITS)
#: Values that a task puts into one Arrow batch.
_VALUES = 1 << 18


@dataclass(frozen=True)
class Likeness:
    """Sets of ``words``-word n-grams link where 100 * common >= ``percent`` * all.

    Blocks of more than ``paired`` classes are compared in rounds.
    """

    words: int = 3
    percent: int = 90
    paired: int = 64

    def prefix(self, n: int) -> int:
        return n - -(-self.percent * n // 100) + 1


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def ngrams(text: str | None, words: int) -> np.ndarray:
    """64-bit hashes of all n-grams, repeats included; of the whole text, if it is shorter.

    Words are what ASCII white space separates, with A-Z in lower case.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    own = np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(parts))
    n = max(1, len(own) - words + 1)
    grams = np.full(n, min(words, len(own)), dtype=np.uint64)
    for at in range(min(words, len(own))):
        grams = _mix(grams * np.uint64(31) + own[at : at + n])
    return grams


def slot_order(docs: DataFrame, words: int) -> np.ndarray:
    """The rank of each slot, by how many n-grams of the corpus fall into it.

    The driver gets one number per slot, whatever the size of the corpus.
    """
    slots = 1 << SLOT_BITS

    def run(batches):
        counts = np.zeros(slots, dtype=np.int64)
        waiting, size = [], 0
        for batch in batches:
            for text in batch.column(0):
                waiting.append(ngrams(text.as_py(), words) >> _REST)
                size += len(waiting[-1])
                if size >= slots:
                    counts += np.bincount(np.concatenate(waiting).astype(np.int64), minlength=slots)
                    waiting, size = [], 0
        if waiting:
            counts += np.bincount(np.concatenate(waiting).astype(np.int64), minlength=slots)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(counts[used])], ["slot", "n"]
        )

    found = (
        docs.select(F.col("text").cast("string"))
        .mapInArrow(run, "slot int, n bigint")
        .groupBy("slot")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    counts = np.zeros(slots, dtype=np.int64)
    counts[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    ranks = np.empty(slots, dtype=np.uint32)
    ranks[np.argsort(counts, kind="stable")] = np.arange(slots, dtype=np.uint32)
    return ranks


def rare_first(grams: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The n-grams renamed, one to one, so that smaller numbers are rarer."""
    low = grams & np.uint64((1 << int(_REST)) - 1)
    return (ranks[grams >> _REST].astype(np.uint64) << _REST) | low


_SETS = (
    "doc_id bigint, t bigint, n bigint, h1 bigint, h2 bigint, prefix array<bigint>, "
    "parts array<smallint>"
)


def _sets(docs: DataFrame, ranks: np.ndarray, how: Likeness) -> DataFrame:
    """What is kept of each row: its set's size, 128-bit name, prefix and part sizes."""

    def describe(text: str | None):
        own = np.unique(ngrams(text, how.words))
        if not len(own):
            return 0, None, None, None, None
        name = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), dtype="<i8")
        size = how.prefix(len(own))
        named = rare_first(own, ranks)
        prefix = np.sort(np.partition(named, size - 1)[:size]).view(np.int64)
        parts = np.bincount((own & np.uint64(PARTS - 1)).astype(np.int64), minlength=PARTS)
        # Cut sizes still differ by no more than the sizes do.
        return len(own), name[0], name[1], prefix, np.minimum(parts, 32767).astype(np.int16)

    def packed(ids, marks, rows):
        n, h1, h2, prefix, parts = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array(marks, pa.int64()),
                pa.array(n, pa.int64()),
                pa.array(h1, pa.int64()),
                pa.array(h2, pa.int64()),
                pa.array(prefix, pa.list_(pa.int64())),
                pa.array(parts, pa.list_(pa.int16())),
            ],
            ["doc_id", "t", "n", "h1", "h2", "prefix", "parts"],
        )

    def run(batches):
        for batch in batches:
            ids, marks, rows, size = [], [], [], 0
            for doc_id, mark, text in zip(*batch.columns, strict=True):
                ids.append(doc_id.as_py())
                marks.append(mark.as_py())
                rows.append(describe(text.as_py()))
                size += PARTS + (0 if rows[-1][3] is None else len(rows[-1][3]))
                if size >= _VALUES:
                    yield packed(ids, marks, rows)
                    ids, marks, rows, size = [], [], [], 0
            if rows:
                yield packed(ids, marks, rows)

    rows = docs.select("doc_id", "t", "text").mapInArrow(run, _SETS)
    return settle(rows.withColumn("row", F.monotonically_increasing_id()), "ngram-sets")


def _needed(how: Likeness, a: str, b: str) -> Column:
    """The fewest n-grams that sets of these sizes must share."""
    return F.ceil((F.col(a) + F.col(b)) * how.percent / F.lit(100 + how.percent))


def _lengths(how: Likeness) -> Column:
    small, large = F.least("na", "nb"), F.greatest("na", "nb")
    return small * 100 >= large * how.percent


def _places(how: Likeness) -> Column:
    before = F.least("pa", "pb")
    after = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    return before + after >= _needed(how, "na", "nb")


def _suffixes(how: Likeness) -> Column:
    """Whether the parts' sizes leave room: they differ by no more than the sets do."""
    part = lambda x, i: F.get(x, F.lit(i)).cast("int")
    # Spelt out, so that it is compiled with the join.
    apart = sum((F.abs(part("xa", i) - part("xb", i)) for i in range(PARTS)), F.lit(0))
    return apart <= F.col("na") + F.col("nb") - 2 * _needed(how, "na", "nb")


def _side(rows: DataFrame, x: str, **more: str) -> DataFrame:
    names = {"row": x, "n": f"n{x}", **more}
    return rows.select("token", *[F.col(old).alias(new) for old, new in names.items()])


def _small_blocks(members: DataFrame, classes: DataFrame, how: Likeness) -> DataFrame:
    """Pairs of blocks that are paired, once each, with both sizes; all filters passed."""
    small = members.where(F.col("m") <= how.paired)
    met = (
        _side(small, "a", place="pa")
        .join(_side(small, "b", place="pb"), "token")
        .where("a < b")
        .where(_lengths(how) & _places(how))
        .select("a", "b", "na", "nb")
        .distinct()
    )
    own = lambda x: classes.select(F.col("row").alias(x), F.col("parts").alias(f"x{x}"))
    passed = met.join(own("a"), "a").join(own("b"), "b").where(_suffixes(how))
    return passed.select("a", "b", "na", "nb")


def _stars(large: DataFrame, how: Likeness) -> DataFrame:
    """Each of a large block (``row``) beside the one that most large blocks share (``pivot``)."""
    rank = F.struct(F.size("shared").alias("degree"), F.col("row"))
    pivots = large.groupBy("token").agg(F.max(rank).alias("rank"))
    pivots = pivots.select("token", F.col("rank.row").alias("row"))
    centre = _side(large.join(pivots, ["token", "row"]), "a", parts="xa")
    joined = centre.join(_side(large, "b", parts="xb"), "token").where("a <> b").where(_lengths(how))
    return joined.where(_suffixes(how)).select(
        F.col("a").alias("pivot"), F.col("b").alias("row"), F.col("na").alias("np"), F.col("nb").alias("n")
    ).distinct()


def _as_pairs(stars: DataFrame) -> DataFrame:
    first = F.col("pivot") < F.col("row")
    return stars.select(
        F.least("pivot", "row").alias("a"),
        F.greatest("pivot", "row").alias("b"),
        F.when(first, F.col("np")).otherwise(F.col("n")).alias("na"),
        F.when(first, F.col("n")).otherwise(F.col("np")).alias("nb"),
    )


def _within_squares(how: Likeness):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            rows, roots, n, parts = (np.stack(right[c].to_numpy()) for c in ("row", "root", "n", "parts"))
            parts, shared = parts.astype(np.int32), [set(x) for x in right["shared"]]
            same = left["i"].iloc[0] == right["j"].iloc[0]
            token = left["token"].iloc[0]
            for one in left.itertuples(index=False):
                both = one.n + n
                needed = -(-how.percent * both // (100 + how.percent))
                fits = (np.minimum(one.n, n) * 100 >= np.maximum(one.n, n) * how.percent) & (roots != one.root)
                # In a square on the diagonal each pair would be met twice.
                fits &= (rows > one.row) if same else (rows != one.row)
                at = np.flatnonzero(fits)
                apart = np.abs(parts[at] - np.asarray(one.parts, dtype=np.int32)).sum(axis=1)
                own = set(one.shared)
                for k in at[apart <= both[at] - 2 * needed[at]].tolist():
                    if min(own & shared[k]) == token:
                        pair = sorted(((one.row, one.n), (int(rows[k]), int(n[k]))))
                        out.append((pair[0][0], pair[1][0], pair[0][1], pair[1][1]))
        return pd.DataFrame(out, columns=["a", "b", "na", "nb"])

    return run


def _open_pairs(rooted: DataFrame, before: int, upto: int, how: Likeness) -> DataFrame:
    """Pairs of blocks that may link and are not known to belong together, once each.

    Blocks are cut into squares, the rows from ``before`` to ``upto`` of which are
    looked at. A pair that shares several large blocks is met in the first of them.
    """
    square = F.floor(F.col("turn") / SQUARE).cast("int")
    last = F.floor((F.col("m") - 1) / SQUARE).cast("int")
    dealt = rooted.withColumn("square", square).withColumn("last", last)
    left = dealt.where((F.col("square") >= before) & (F.col("square") < upto)).select(
        "*", F.col("square").alias("i"), F.explode(F.sequence("square", "last")).alias("j")
    )
    ends = F.least(F.col("square"), F.lit(upto - 1))
    right = dealt.select(
        "*", F.col("square").alias("j"), F.explode(F.sequence(F.lit(before), ends)).alias("i")
    )
    key = ["token", "i", "j"]
    columns = [*key, "row", "n", "root", "parts", "shared"]
    cells = left.select(*columns).groupBy(*key).cogroup(right.select(*columns).groupBy(*key))
    return cells.applyInPandas(_within_squares(how), "a bigint, b bigint, na bigint, nb bigint")


def _wanted_bits(speakers: DataFrame) -> np.ndarray:
    """A bitmap of the slots of ``speakers``; at most ``MOST_BITS``, whatever their number."""
    bits = 1 << 15
    while bits < min(MOST_BITS, BITS_EACH * speakers.count()):
        bits *= 2
    slot = _slot(bits)
    found = (
        speakers.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 15).alias("at"))
        .agg(F.bitmap_construct_agg(F.col("slot").bitwiseAND((1 << 15) - 1)).alias("bits"))
        .collect()
    )
    bitmap = np.zeros((bits >> 15, 1 << 12), dtype=np.uint8)
    for row in found:
        bitmap[row["at"]] = np.frombuffer(row["bits"], dtype=np.uint8)
    return bitmap.ravel()


def _slot(bits: int) -> Column:
    return F.pmod(F.xxhash64("id", "t"), F.lit(bits))


def _whole_sets(docs: DataFrame, classes: DataFrame, involved: DataFrame, how: Likeness) -> DataFrame:
    """``row`` and ``grams`` of the classes in ``involved``, from one text of each.

    Texts are not shuffled: where they are read, a bitmap tells which may be wanted,
    and only the n-grams of those go on.
    """
    speakers = settle(
        classes.join(involved, "row", "left_semi").select(
            "row", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "t"
        ),
        "speakers",
    )
    bitmap = _wanted_bits(speakers)

    def packed(ids, marks, found):
        offsets = np.cumsum([0, *map(len, found)], dtype=np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found), pa.int64()))
        arrays = [pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), lists]
        return pa.RecordBatch.from_arrays(arrays, ["id", "t", "grams"])

    def run(batches):
        for batch in batches:
            slots = batch.column(2).to_numpy()
            wanted = np.flatnonzero(bitmap[slots >> 3] >> (slots & 7).astype(np.uint8) & 1)
            ids, marks, found, size = [], [], [], 0
            for at in wanted.tolist():
                ids.append(batch.column(0)[at].as_py())
                marks.append(batch.column(1)[at].as_py())
                found.append(np.unique(ngrams(batch.column(3)[at].as_py(), how.words)).view(np.int64))
                size += len(found[-1])
                if size >= _VALUES:
                    yield packed(ids, marks, found)
                    ids, marks, found, size = [], [], [], 0
            if found:
                yield packed(ids, marks, found)

    texts = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "t", "text")
    built = texts.select("id", "t", _slot(len(bitmap) * 8).alias("slot"), "text").mapInArrow(
        run, "id bigint, t bigint, grams array<bigint>"
    )
    # Rows that repeat both id and text are one here.
    one = (
        built.join(speakers, ["id", "t"])
        .groupBy("id", "t", "row")
        .agg(F.first("grams").alias("grams"))
    )
    return settle(one.select("row", "grams"), "whole-sets")


def _verified(pairs: DataFrame, sets: DataFrame, how: Likeness) -> DataFrame:
    """The pairs whose whole sets link."""
    own = lambda x: sets.select(F.col("row").alias(x), F.col("grams").alias(f"g{x}"))
    common = F.size(F.array_intersect("ga", "gb"))
    both = F.col("na") + F.col("nb")
    return (
        pairs.join(own("a"), "a")
        .join(own("b"), "b")
        .where(common * 100 >= (both - common) * how.percent)
        .select("a", "b")
    )


def _closed(
    large: DataFrame, labels: DataFrame, links: DataFrame, sets: DataFrame, how: Likeness
) -> DataFrame:
    """``links`` and those of all pairs that large blocks leave open.

    ``labels`` tell of some rows which others they belong to. Members take turns in an
    order of their hashes. A round looks at the next of each block beside all that come
    after and are not known to belong to them by then.
    """
    turn = F.shiftrightunsigned(F.xxhash64("row"), 11) / F.lit(float(1 << 53)) * F.col("m")
    members = large.withColumn("turn", turn)
    before, upto = 0, ROUND
    while True:
        rooted = members.join(labels, F.col("row") == F.col("node"), "left").select(
            *members.columns, F.coalesce("root", "row").alias("root")
        )
        ends = rooted.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
        rooted = rooted.join(ends.where("lo <> hi").select("token"), "token")
        rooted = settle(rooted, "open-blocks")
        pairs = settle(_open_pairs(rooted, before, upto, how), "open-pairs")
        links = settle(links.unionByName(_verified(pairs, sets, how)), "links")
        members = rooted.where(F.col("turn") >= upto * SQUARE).drop("root")
        if members.isEmpty():
            return links
        labels = settle(connected_components(links), "labels")
        before, upto = upto, 4 * upto


def linked(docs: DataFrame, how: Likeness = Likeness()) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for every row of ``docs``.

    ``docs`` has ``doc_id`` and ``text``; other columns are not looked at. A text of
    fewer words than an n-gram has one n-gram, all of it; a NULL text, or one without
    words, has none and is linked with nothing, not even with its like. Rows that
    repeat an id are rows of their own. A component is named by its smallest id; NULL
    ids name none.
    """
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).withColumn("t", F.xxhash64("text"))
    ranks = slot_order(source, how.words)
    rows = _sets(source, ranks, how)
    name = ["h1", "h2"]
    named = settle(
        rows.where("n > 0").groupBy(*name).agg(F.min("row").alias("row"), F.min("doc_id").alias("least")),
        "classes",
    )
    classes = rows.join(named.select("row"), "row", "left_semi")
    posted = classes.select("row", "n", F.posexplode("prefix").alias("place", "token"))
    shared = posted.groupBy("token").agg(F.count("*").alias("m")).where("m > 1")
    members = settle(posted.join(settle(shared, "shared-tokens"), "token"), "members")
    parts = settle(
        classes.join(members.select("row"), "row", "left_semi").select("row", "doc_id", "t", "parts"),
        "meeting-classes",
    )
    crowded = members.where(F.col("m") > how.paired).select("token", "row", "n", "m")
    shared_blocks = crowded.groupBy("row").agg(F.collect_list("token").alias("shared"))
    large = crowded.join(shared_blocks, "row").join(parts.select("row", "parts"), "row")
    large = settle(large, "large-blocks")
    stars = settle(_stars(large, how), "stars")
    pairs = _small_blocks(members, parts, how).unionByName(_as_pairs(stars)).distinct()
    pairs = settle(pairs, "pairs")
    ends = [frame.select(F.col(x).alias("row")) for frame, x in ((pairs, "a"), (pairs, "b"))]
    involved = ends[0].unionByName(ends[1]).unionByName(large.select("row")).distinct()
    sets = _whole_sets(source, parts, involved, how)
    links = settle(_verified(pairs, sets, how), "links")
    if not large.isEmpty():
        # What is linked to a block's pivot belongs to it.
        either = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        either = either.select(F.col("a").alias("row"), F.col("b").alias("pivot"))
        tied = either.join(stars, ["row", "pivot"]).groupBy("row").agg(F.min("pivot").alias("root"))
        labels = settle(tied.select(F.col("row").alias("node"), "root"), "tied")
        links = _closed(large, labels, links, sets, how)
    labels = settle(connected_components(links), "labels")

    rooted = named.join(labels, F.col("row") == F.col("node"), "left").select(
        *name, "least", F.coalesce("root", "row").alias("root")
    )
    components = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = settle(rooted.join(components, "root").select(*name, "component_id"), "components")
    worded = rows.where("n > 0").join(by_class, name)
    empty = rows.where("n = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    return worded.select(*columns).unionByName(empty.select(*columns))
