"""Hard negatives for contrastive training, by integer inner product.

For an anchor, its positives are the rows of its label with the largest inner
products. For each positive, the hard negatives are the rows of other labels with
the largest inner products inside a window below the positive's.

Candidates get one more coordinate that gives all of them the same norm, so that
inner product falls as distance grows. They are dealt to blocks round a bounded
number of centres, and each block is a cover tree: every node's children lie
within half its scale of it and further than that from each other, and every node
knows the radius that covers all below it. The radius bounds the inner product of
anything below a node from both sides. A search goes down best bound first, passes
over nodes that lie outside its window or below what it has found, and verifies
what is left at the leaves in whole numbers.

Anchors are a stated set; they meet blocks in groups of bounded size. The block
that promises most comes first, and what it yields decides which other blocks an
anchor has to see at all.
"""

from __future__ import annotations

import heapq
import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadgrain.session import settle

#: Rows of a block, anchors of a group, blocks whose bounds are compared at a time.
BLOCK, GROUP, SHELF = 2048, 512, 1024
#: Centres that deal candidates to blocks; a sample of this size at most.
CENTRES = 1024
#: Nodes with no more points than this have no children.
LEAF = 32
_FAR = 1 << 62


@dataclass(frozen=True)
class Mining:
    """``negatives`` for each of ``positives``; a negative's score lies between ``low``
    and ``high`` hundredths of the positive's; components are scaled by ``scale``."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    scale: int = 256
    block: int = BLOCK
    group: int = GROUP


# --- the tree ---------------------------------------------------------------


def augmented(points: np.ndarray, norm: float) -> np.ndarray:
    """``points`` with one more coordinate, so that each has the given norm."""
    missing = np.maximum(norm**2 - (points**2).sum(axis=1), 0.0)
    return np.hstack((points, np.sqrt(missing)[:, None]))


def cover_tree(points: np.ndarray, leaf: int = LEAF) -> dict:
    """A cover tree over ``points`` (already augmented).

    ``node_point``: the point a node stands on; ``radius``: what covers all below it;
    ``children``: its children, or None for a leaf; ``members``: a leaf's points.
    Children are picked farthest first, until all of a node's points are within half
    its scale of one, so they are further than that apart.
    """
    node_point, radius, children, members = [], [], [], []

    def add(point: int, own: np.ndarray, far: np.ndarray) -> int:
        node_point.append(point)
        radius.append(float(far.max()) if len(far) else 0.0)
        children.append(None)
        members.append(own)
        return len(node_point) - 1

    everyone = np.arange(len(points))
    if not len(everyone):
        return {"node_point": [], "radius": [], "children": [], "members": []}
    open_nodes = [add(0, everyone, np.linalg.norm(points - points[0], axis=1))]
    while open_nodes:
        node = open_nodes.pop()
        own, scale = members[node], radius[node] / 2
        if len(own) <= leaf or radius[node] == 0:
            continue
        x = points[own]
        nearest = np.linalg.norm(x - points[node_point[node]], axis=1)
        picked, of = [node_point[node]], np.zeros(len(own), dtype=np.int64)
        while nearest.max() > scale:
            new = int(nearest.argmax())
            far = np.linalg.norm(x - x[new], axis=1)
            closer = far < nearest
            of[closer], nearest = len(picked), np.where(closer, far, nearest)
            picked.append(int(own[new]))
        below = []
        order = np.argsort(of, kind="stable")
        bounds = np.searchsorted(of[order], np.arange(len(picked) + 1))
        for i, point in enumerate(picked):
            at = order[bounds[i] : bounds[i + 1]]
            below.append(add(point, own[at], nearest[at]))
        children[node], members[node] = np.array(below), None
        open_nodes += below
    return {"node_point": node_point, "radius": radius, "children": children, "members": members}


def bounds(products: np.ndarray, radius: np.ndarray, length: float, norm: float):
    """The least and the largest inner product of a query with anything below nodes.

    ``products`` are the query's with the nodes' centres, ``length`` is its own norm,
    ``norm`` that of all augmented points. With the query stretched to that norm, the
    distances to a node's points differ from the one to its centre by the radius at
    most; the inner product itself differs by ``length * radius`` at most.
    """
    if length == 0 or norm == 0:
        return np.zeros_like(products), np.zeros_like(products)
    stretch = norm / length
    apart = np.sqrt(np.maximum(2 * norm**2 - 2 * stretch * products, 0.0))
    near, far = np.maximum(apart - radius, 0.0), apart + radius
    upper = np.minimum(products + length * radius, (2 * norm**2 - near**2) / (2 * stretch))
    lower = np.maximum(products - length * radius, (2 * norm**2 - far**2) / (2 * stretch))
    slack = 1e-6 * length * norm + 1e-6  # rounding must not hide a row
    return lower - slack, upper + slack


def exact_products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Whole-number inner products; beyond BIGINT they stop at its ends."""
    if not vectors.size:
        return np.zeros(len(vectors), dtype=np.int64)
    largest = float(np.abs(vectors.astype(np.float64)).max()) * float(
        np.abs(query.astype(np.float64)).max()
    )
    if largest * len(query) < 1 << 53:
        return (vectors.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    wide = [sum(a * b for a, b in zip(v, query.tolist(), strict=True)) for v in vectors.tolist()]
    ends = (1 << 63) - 1
    return np.array([max(-ends - 1, min(ends, w)) for w in wide], dtype=np.int64)


class Block:
    """Candidates of one block and the tree over them."""

    def __init__(self, rows, ids, labels, vectors, norm):
        self.rows, self.ids, self.labels, self.norm = rows, ids, labels, norm
        self.vectors = vectors
        tree = cover_tree(augmented(vectors.astype(np.float64), norm))
        self.children, self.members = tree["children"], tree["members"]
        self.radius = np.array(tree["radius"])
        self.centres = vectors[np.array(tree["node_point"], dtype=np.int64)].astype(np.float64)

    def search(self, query, row, label, same, windows, k):
        """For each window (key, low, high, floor): up to ``k`` (key, place, score).

        Rows of the query's label, or of others; never the row itself; scores inside
        the window and not below ``floor``; best first, ties to the smaller id.
        """
        q = query.astype(np.float64)
        length = float(np.sqrt(q @ q))
        low, high = bounds(self.centres @ q, self.radius, length, self.norm)
        for key, least, most, floor in windows:
            found = self._descend(query, row, label, same, max(least, floor), most, k, low, high)
            for score, place in found:
                yield key, place, score

    def _descend(self, query, row, label, same, least, most, k, low, high):
        best: list[tuple] = []  # (-score, id, row, place), best first
        queue = [(-high[0], 0)] if len(high) and high[0] >= least and low[0] <= most else []
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < least:
                break
            below = self.children[node]
            if below is not None:
                inside = below[(high[below] >= least) & (low[below] <= most)]
                leaves = [c for c in inside.tolist() if self.children[c] is None]
                for child in inside.tolist():
                    if self.children[child] is not None:
                        heapq.heappush(queue, (-high[child], child))
                # Small leaves are verified together, a bounded number at a time.
                leaves.sort(key=lambda c: -high[c])
                for at in range(0, len(leaves), 2 * LEAF):
                    some = [c for c in leaves[at : at + 2 * LEAF] if high[c] >= least]
                    if not some:
                        break
                    least = self._verify(some, query, row, label, same, least, most, k, best)
            else:
                least = self._verify([node], query, row, label, same, least, most, k, best)
        return [(-s, place) for s, _, _, place in best]

    def _verify(self, leaves, query, row, label, same, least, most, k, best):
        places = np.concatenate([self.members[leaf] for leaf in leaves])
        places = places[(self.labels[places] == label) == same]
        places = places[self.rows[places] != row]
        scores = exact_products(self.vectors[places], query)
        inside = (scores >= least) & (scores <= most)
        for place, score in zip(places[inside].tolist(), scores[inside].tolist(), strict=True):
            best.append((-score, int(self.ids[place]), int(self.rows[place]), place))
        best.sort()
        del best[k:]
        # Equal scores may still win by a smaller id.
        return max(least, -best[-1][0]) if len(best) == k else least


# --- the work on Spark --------------------------------------------------------


def candidates(vectors: DataFrame, is_anchor: Column, label: Column, scale: int) -> DataFrame:
    """The rows that take part: ``row``, ``vec_id``, ``label``, ``v``, ``size``, ``norm2``, ``asks``."""
    component = lambda x: F.floor(x.cast("double") * scale).cast("bigint")
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    vector = F.col("embedding")
    chosen = vectors.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vector.isNotNull()
    ).where(~F.exists(vector, odd))
    v = F.transform(vector, component)
    squares = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    return (
        chosen.select(
            F.col("vec_id").cast("bigint").alias("vec_id"),
            label.cast("bigint").alias("label"),
            v.alias("v"),
            F.coalesce(is_anchor, F.lit(False)).alias("asks"),
        )
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("size", F.size("v"))
        .withColumn("norm2", squares)
    )


def _matrix(frame: pd.DataFrame) -> np.ndarray:
    width = len(frame["v"].iloc[0])
    return np.array([np.asarray(v, dtype=np.int64) for v in frame["v"]]).reshape(len(frame), width)


def _forest(rows: DataFrame, block: int) -> DataFrame:
    """``size``, ``block``, ``centre``, ``radius``, ``norm`` and ``tree`` of every block."""
    counts = rows.groupBy("size").agg(F.count("*").alias("n"), F.max("norm2").alias("norm2"))
    known = {r["size"]: (r["n"], r["norm2"] ** 0.5) for r in counts.collect()}
    centres = {}
    for size, (n, norm) in known.items():
        # A sample of at most CENTRES rows; every row is dealt to the nearest.
        few = min(CENTRES, -(-n // block))
        of_size = rows.where(F.col("size") == size)
        picked = of_size.orderBy(F.xxhash64("row"), "row").limit(few).select("v").collect()
        points = np.array([r["v"] for r in picked], dtype=np.float64).reshape(len(picked), size)
        centres[size] = augmented(points, norm)

    def deal(batches):
        for frame in batches:
            for size, part in frame.groupby("size", sort=False):
                norm, points = known[size][1], centres[size]
                x = augmented(_matrix(part).astype(np.float64), norm)
                # All points have one norm: the nearest has the largest product.
                part = part.assign(cell=(x @ points.T).argmax(axis=1), norm=norm)
                yield part[["row", "vec_id", "label", "v", "size", "norm", "cell"]]

    dealt = settle(
        rows.select("row", "vec_id", "label", "v", "size").mapInPandas(
            deal,
            "row bigint, vec_id bigint, label bigint, v array<bigint>, size int, norm double, cell int",
        ),
        "dealt",
    )
    # Cells of any size are split into blocks of about ``block`` rows.
    pieces = dealt.groupBy("size", "cell").agg(F.ceil(F.count("*") / block).alias("pieces"))
    piece = F.pmod(F.xxhash64("row"), F.col("pieces"))

    def grow(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("row")
        norm, vectors = float(part["norm"].iloc[0]), _matrix(part)
        own = Block(
            part["row"].to_numpy(), part["vec_id"].to_numpy(), part["label"].to_numpy(), vectors, norm
        )
        return pd.DataFrame(
            {
                "size": [part["size"].iloc[0]],
                "centre": [own.centres[0]],
                "radius": [own.radius[0]],
                "norm": [norm],
                "tree": [pickle.dumps(own)],
            }
        )

    grown = (
        dealt.join(pieces, ["size", "cell"])
        .withColumn("piece", piece)
        .groupBy("size", "cell", "piece")
        .applyInPandas(
            grow, "size int, centre array<double>, radius double, norm double, tree binary"
        )
    )
    return settle(grown.withColumn("block", F.monotonically_increasing_id()), "forest")


_VISIT = "row bigint, group bigint, block bigint, promise double"


def _visits(asking: DataFrame, roots: DataFrame, only_best: bool, group: int) -> DataFrame:
    """Which blocks an anchor has to see: ``row``, ``group``, ``block``, ``promise``.

    Groups of anchors meet shelves of block roots, both of bounded size. With
    ``only_best`` there is one row per anchor and shelf.
    """

    def judge(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            centres = np.array([np.asarray(c) for c in right["centre"]]).reshape(len(right), -1)
            radius, blocks = right["radius"].to_numpy(), right["block"].to_numpy()
            norm = float(right["norm"].iloc[0])
            matrix = _matrix(left).astype(np.float64)
            for i, q in enumerate(matrix):
                low, high = bounds(centres @ q, radius, float(np.sqrt(q @ q)), norm)
                one = left.iloc[i]
                least = np.maximum(one["lows"], one["floors"])[:, None]
                most = np.asarray(one["highs"])[:, None]
                seen = ((high >= least) & (low <= most)).any(axis=0) & (blocks != one["first"])
                at = np.flatnonzero(seen)
                if only_best and len(at):
                    at = at[[int(high[at].argmax())]]
                out += [(one["row"], one["group"], blocks[j], high[j]) for j in at]
        return pd.DataFrame(out, columns=["row", "group", "block", "promise"])

    shelf = F.pmod(F.xxhash64("block"), F.col("shelves"))
    counted = roots.groupBy("size").agg(F.ceil(F.count("*") / SHELF).alias("shelves"))
    groups = asking.groupBy("size").agg((F.max("group") + 1).alias("groups"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    left = asking.join(counted, "size").withColumn("shelf", every("shelves"))
    right = (
        roots.join(counted, "size")
        .withColumn("shelf", shelf)
        .join(groups, "size")
        .withColumn("group", every("groups"))
    )
    key = ["size", "group", "shelf"]
    return (
        left.drop("shelves").groupBy(*key).cogroup(right.drop("shelves", "groups").groupBy(*key))
        .applyInPandas(judge, _VISIT)
    )


_FOUND = "row bigint, key bigint, candidate bigint, vec_id bigint, score bigint"


def _seek(visits: DataFrame, asking: DataFrame, forest: DataFrame, same: bool, k: int) -> DataFrame:
    """What the visited blocks hold for each anchor and window: ``k`` rows each at most."""

    def seek(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            block: Block = pickle.loads(left["tree"].iloc[0])
            for i, query in enumerate(_matrix(right)):
                one = right.iloc[i]
                windows = zip(one["keys"], one["lows"], one["highs"], one["floors"], strict=True)
                for key, place, score in block.search(
                    query, one["row"], one["label"], same, [tuple(map(int, w)) for w in windows], k
                ):
                    out.append((one["row"], key, block.rows[place], block.ids[place], score))
        return pd.DataFrame(out, columns=["row", "key", "candidate", "vec_id", "score"])

    pair = ["block", "group"]
    met = visits.select(*[F.col(c).alias(c) for c in pair]).distinct()
    trees = forest.select("block", "tree").join(met, "block")
    queries = visits.select("row", *pair).join(asking.drop("group", "size", "first"), "row")
    return trees.groupBy(*pair).cogroup(queries.groupBy(*pair)).applyInPandas(seek, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row", "key").orderBy(F.desc("score"), "vec_id", "candidate")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(asking: DataFrame, forest: DataFrame, same: bool, k: int, group: int) -> DataFrame:
    """The best ``k`` rows of each anchor and window (``keys``, ``lows``, ``highs``)."""
    roots = forest.drop("tree")
    start = asking.withColumn("floors", F.transform("lows", lambda _: F.lit(-_FAR))).withColumn(
        "first", F.lit(-1).cast("bigint")
    )
    promise = F.struct("promise", "block", "group")
    first = _visits(start, roots, True, group).groupBy("row").agg(F.max(promise).alias("p"))
    first = settle(first.select("row", "p.block", "p.group"), "first-visits")
    begun = settle(_seek(first, start, forest, same, k), "first-found")
    # The k-th score of a window, where the first block has so many, is a floor for all others.
    floor = _best(begun, k).where(F.col("rank") == k).groupBy("row").agg(
        F.map_from_entries(F.collect_list(F.struct("key", "score"))).alias("known")
    )
    going = (
        start.drop("floors", "first")
        .join(floor, "row", "left")
        .join(first.select("row", F.col("block").alias("first")), "row")
        .withColumn(
            "floors",
            F.transform(
                "keys", lambda key: F.coalesce(F.try_element_at("known", key), F.lit(-_FAR))
            ),
        )
        .drop("known")
    )
    going = settle(going, "going")
    visits = settle(_visits(going, roots, False, group).drop("promise"), "visits")
    rest = _seek(visits, going, forest, same, k)
    return _best(begun.unionByName(rest), k)


def mine(
    vectors: DataFrame, is_anchor: Column, label: Column | None = None, how: Mining = Mining()
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``vectors`` has ``vec_id``, ``embedding`` and ``label`` (or the column given).
    Rows with a NULL id, label or vector, or a NULL or non-finite component take no
    part; an empty vector is a vector. Components become ``floor(scale * x)``, cut
    at the ends of BIGINT; scores beyond 2**62 either way are not found. Vectors of different lengths are never
    compared. Rows that repeat an id are rows of their own: each may be an anchor, a
    positive and a negative, and ties between them have no order. An anchor without
    positives, or a positive without negatives in its window, has no rows.
    """
    own = F.col("label") if label is None else label
    rows = settle(candidates(vectors, is_anchor, own, how.scale), "candidates")
    forest = _forest(rows, how.block)
    anchors = rows.where("asks").select("row", "vec_id", "label", "v", "size")
    many = anchors.groupBy("size").agg(F.ceil(F.count("*") / how.group).alias("groups"))
    grouped = F.pmod(F.xxhash64("row"), F.col("groups"))
    anchors = settle(anchors.join(many, "size").select("*", grouped.alias("group")), "anchors")
    ends = lambda x: F.array(F.lit(x).cast("bigint"))
    asking = anchors.drop("groups", "vec_id").select(
        "*", ends(0).alias("keys"), ends(-_FAR).alias("lows"), ends(_FAR).alias("highs")
    )
    positives = settle(_search(asking, forest, True, how.positives, how.group), "positives")

    # A window per positive; whole scores between low and high hundredths of it.
    least = F.expr(f"cast(ceil(cast(score AS decimal(38, 0)) * {how.low} / 100) AS bigint)")
    most = F.expr(f"cast(floor(cast(score AS decimal(38, 0)) * {how.high} / 100) AS bigint)")
    windows = (
        positives.select("row", "candidate", least.alias("low"), most.alias("high"))
        .where("low <= high")
        .groupBy("row")
        .agg(F.collect_list(F.struct("candidate", "low", "high")).alias("w"))
        .select("row", "w.candidate", "w.low", "w.high")
        .toDF("row", "keys", "lows", "highs")
    )
    asking = settle(anchors.drop("groups", "vec_id").join(windows, "row"), "windows")
    negatives = _search(asking, forest, False, how.negatives, how.group)
    named = positives.select(
        "row", F.col("candidate").alias("key"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return (
        negatives.select(
            "row", "key", "rank", F.col("vec_id").alias("negative_id"),
            F.col("score").alias("negative_score"),
        )
        .join(named, ["row", "key"])
        .join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
