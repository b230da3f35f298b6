"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each table projects unit vectors on a few random directions and cuts the lines
into cells; the cells' numbers are the bucket. A query visits its own bucket and
then, in order of estimated success, buckets one cell off in one or more
directions (the closer a cell's border, the likelier that a neighbour lies
beyond it). Candidates of all buckets and tables are reranked by exact cosine in
double precision.

Equal vectors are searched as one, however many there are. Buckets are matched
in blocks of bounded size, so a bucket that holds much of the table is spread
over tasks and nothing is dropped. Queries whose buckets hold fewer candidates than
they ask for are searched once more, against all rows, in the same blocks.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadgrain.session import settle

#: Candidates, and queries, that a block holds about.
BLOCK = 256
SALTS = 64


@dataclass(frozen=True)
class Search:
    """``tables`` of ``directions`` projections; ``width`` of a cell on the unit
    sphere's scale; ``probes`` buckets are visited in each table."""

    k: int = 5
    tables: int = 8
    directions: int = 4
    width: float = 1.1
    probes: int = 48
    seed: int = 5

    def projections(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng([self.seed, size])
        along = rng.normal(size=(self.tables, size, self.directions))
        return along, rng.uniform(0, self.width, size=(self.tables, 1, self.directions))


def perturbations(directions: int, probes: int) -> list[tuple[int, ...]]:
    """Sets of border ranks to cross, likeliest first; the empty set is the own bucket.

    With the distances to all ``2 * directions`` cell borders in ascending order,
    the expected square of the j-th is known; a set's score is the sum of its
    members', and small sums succeed most. Sets that cross both borders of one
    direction make no sense and are passed over.
    """
    m, top = directions, 2 * directions
    expected = []
    for j in range(1, top + 1):
        if j <= m:
            expected.append(j * (j + 1) / (4 * (m + 1) * (m + 2)))
        else:
            back = top + 1 - j
            expected.append(1 - back / (m + 1) + back * (back + 1) / (4 * (m + 1) * (m + 2)))
    found: list[tuple[int, ...]] = [()]
    queue = [(expected[0], (1,))]
    while queue and len(found) < probes:
        score, ranks = heapq.heappop(queue)
        if all(top + 1 - r not in ranks for r in ranks):
            found.append(ranks)
        last = ranks[-1]
        if last < top:
            step = expected[last] - expected[last - 1]
            heapq.heappush(queue, (score + step, (*ranks[:-1], last + 1)))
            heapq.heappush(queue, (score + expected[last], (*ranks, last + 1)))
    return found


def _unit(frame: pd.DataFrame) -> np.ndarray:
    vectors = np.stack(frame["vector"].to_numpy()).astype(np.float64)
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)  # very large ones must not overflow
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _cells(units: np.ndarray, search: Search):
    """Per table: how far along each direction, in cells."""
    along, shift = search.projections(units.shape[1])
    for t in range(search.tables):
        yield t, (units @ along[t] + shift[t]) / search.width


def _rows(frame: pd.DataFrame, table: int, cells: np.ndarray, at: np.ndarray) -> pd.DataFrame:
    names = [",".join(map(str, row)) for row in cells.astype(np.int64).tolist()]
    picked = frame.iloc[at]
    return pd.DataFrame(
        {
            "size": picked["size"].to_numpy(),
            "table": table,
            "bucket": names,
            "id": picked["id"].to_numpy(),
            "least": picked["least"].to_numpy(),
            "vector": picked["vector"].to_numpy(),
        }
    )


_BUCKETED = "size int, table int, bucket string, id bigint, least bigint, vector array<float>"


def _by_size(batches):
    for frame in batches:
        for _, part in frame.groupby("size", sort=False):
            yield part


def bucketed(vectors: DataFrame, search: Search) -> DataFrame:
    """One row per vector and table: the bucket it is kept in."""

    def run(batches):
        for part in _by_size(batches):
            everyone = np.arange(len(part))
            for table, x in _cells(_unit(part), search):
                yield _rows(part, table, np.floor(x), everyone)

    return vectors.select("size", "id", "least", "vector").mapInPandas(run, _BUCKETED)


def probed(queries: DataFrame, search: Search) -> DataFrame:
    """One row per query, table and probe: the bucket it visits."""
    sets = perturbations(search.directions, search.probes)
    m = search.directions

    def run(batches):
        for part in _by_size(batches):
            everyone = np.arange(len(part))
            for table, x in _cells(_unit(part), search):
                home = np.floor(x)
                inside = x - home
                # Borders below come first, those above after them.
                order = np.argsort(np.hstack((inside, 1 - inside)), axis=1, kind="stable")
                for ranks in sets:
                    cells = home.copy()
                    for rank in ranks:
                        border = order[:, rank - 1]
                        cells[everyone, border % m] += np.where(border < m, -1, 1)
                    yield _rows(part, table, cells, everyone)

    return queries.select("size", "id", "least", "vector").mapInPandas(run, _BUCKETED)


def usable(vector: Column) -> Column:
    """Neither NULL nor zero, and no component NULL or not finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~odd & F.exists(vector, lambda x: x != 0)


def _classes(rows: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: ``size``, ``vector``, ``id``, ``own`` and ``least``.

    ``id`` is its smallest row number, ``own`` the ``k + 1`` of its rows with the smallest
    ``vec_id`` (``least`` the first): more can't be among anyone's ``k`` nearest. They are gathered by salt
    first, so many copies are no single task's burden.
    """
    fewest = lambda c: F.slice(F.sort_array(c), 1, k + 1)
    salted = rows.groupBy("vector", F.pmod(F.xxhash64("row"), F.lit(SALTS)).alias("salt")).agg(
        fewest(F.collect_list(F.struct("vec_id", "row"))).alias("own"), F.min("row").alias("id")
    )
    return (
        salted.groupBy("vector")
        .agg(fewest(F.flatten(F.collect_list("own"))).alias("own"), F.min("id").alias("id"))
        .select(
            F.size("vector").alias("size"), "vector", "id", "own", F.col("own")[0]["vec_id"].alias("least")
        )
    )


def _nearest_in_block(k: int):
    def run(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if candidates.empty or queries.empty:
            return pd.DataFrame({"query": [], "id": [], "score": []})
        x = np.stack(queries["vector"].to_numpy()).astype(np.float64)
        y = np.stack(candidates["vector"].to_numpy()).astype(np.float64)
        scale = lambda v: np.abs(v).max(axis=1, keepdims=True)
        x, y = x / scale(x), y / scale(y)
        norms = np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))
        scores = np.clip((x @ y.T) / norms, -1.0, 1.0)
        ids = candidates["id"].to_numpy()
        ties = np.broadcast_to(candidates["least"].to_numpy(), scores.shape)
        order = np.lexsort((ties, -scores), axis=1)[:, : k + 1]
        return pd.DataFrame(
            {
                "query": np.repeat(queries["id"].to_numpy(), order.shape[1]),
                "id": ids[order].ravel(),
                "score": np.take_along_axis(scores, order, axis=1).ravel(),
            }
        )

    return run


def nearest(vectors: DataFrame, is_query: Column, search: Search = Search()) -> DataFrame:
    """The ``search.k`` nearest found of each query among all other rows.

    ``vectors`` has ``vec_id`` and ``embedding``. Result: ``query_id``, ``rank``
    (from 1), ``vec_id``, ``score`` (cosine), nearest first, ties to the smaller
    id; all other rows, if there are fewer. Vectors that are NULL, zero, or hold NULL
    or non-finite components take no part, nor do rows without id; components are
    taken as floats, and one beyond their range is not finite. Vectors of different
    lengths are never compared. Rows that repeat an id are vectors of their own.
    """
    k = search.k
    vector = F.col("embedding").cast("array<float>")
    rows = settle(
        vectors.select(
            F.col("vec_id").cast("bigint").alias("vec_id"),
            vector.alias("vector"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
        )
        .where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
        .withColumn("row", F.monotonically_increasing_id()),
        "vectors",
    )
    classes = settle(_classes(rows, k), "vector-classes")
    asking = rows.where("asks").select("vec_id", "row", "vector")
    asking = settle(
        asking.join(classes.select("vector", "id", "size"), "vector").select("vec_id", "row", "id", "size"),
        "asking",
    )
    queries = classes.join(asking.select("id").distinct(), "id", "left_semi")
    found = settle(_in_blocks(bucketed(classes, search), probed(queries, search), k), "found")
    near = _named(asking, found, classes, k)

    # What the buckets missed: fewer rows than asked for, though there are more.
    there = classes.groupBy("size").agg(F.sum(F.size("own")).alias("there"))
    got = near.groupBy("query_row").agg(F.count("*").alias("got"))
    lacking = (
        asking.join(there, "size")
        .join(got, asking["row"] == got["query_row"], "left")
        .where(F.coalesce("got", F.lit(0)) < F.least(F.lit(k), F.col("there") - 1))
    )
    lacking = settle(lacking.select("vec_id", "row", "id", "size"), "lacking")
    if not lacking.isEmpty():
        whole = lambda df: df.select(
            "size", F.lit(0).alias("table"), F.lit("").alias("bucket"), "id", "least", "vector"
        )
        again = classes.join(lacking.select("id").distinct(), "id", "left_semi")
        every = _in_blocks(whole(classes), whole(again), k)
        near = near.join(lacking.select(F.col("row").alias("query_row")), "query_row", "left_anti")
        near = near.unionByName(_named(lacking, settle(every, "found"), classes, k))
    return near.select("query_id", "rank", "vec_id", "score")


def _in_blocks(kept: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """``query``, ``id``, ``score``: the best that each query meets in the buckets it visits."""
    keys = ["size", "table", "bucket"]
    kept, visits = settle(kept, "buckets"), settle(visits, "probes")
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    grid = (
        kept.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .join(visits.groupBy(*keys).agg(F.count("*").alias("m")), keys)
        .select(*keys, blocks("n").alias("rows"), blocks("m").alias("columns"))
    )
    grid = settle(grid, "grid")
    mine = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = kept.join(grid, keys).select(
        *keys, "id", "least", "vector", mine("rows").alias("row"), every("columns").alias("column")
    )
    right = visits.join(grid, keys).select(
        *keys, "id", "least", "vector", mine("columns").alias("column"), every("rows").alias("row")
    )
    cell = [*keys, "row", "column"]
    found = (
        left.groupBy(*cell)
        .cogroup(right.groupBy(*cell))
        .applyInPandas(_nearest_in_block(k), "query bigint, id bigint, score double")
        .groupBy("query", "id")
        .agg(F.max("score").alias("score"))
    )
    return found


def _named(asking: DataFrame, found: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest rows of each asking row, of the classes found for it."""
    least = classes.select("id", "least")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "least", "id")
    top = (
        found.join(least, "id")
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= k + 1)
        .select("query", "id", "score")
    )
    named = (
        asking.select(F.col("vec_id").alias("query_id"), F.col("row").alias("query_row"), F.col("id").alias("query"))
        .join(top, "query")
        .join(classes.select("id", "own"), "id")
        .select("query_id", "query_row", "score", F.inline("own"))
        .where("row <> query_row")
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    ranked = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "query_row", "rank", "vec_id", "score")
