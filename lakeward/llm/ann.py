"""Nearest neighbours by stable projections to few dimensions, indexed by kd-trees.

Inner products become distances: each vector gets one more component that gives all the same
length, a query a zero. A 2-stable (Gaussian) projection keeps distances in the sense that the
squared projected distance over the squared distance follows a chi-square law. Neighbours
are taken in the order of their projected distance and verified on the original vectors,
until that law says that a nearer one is unlikely to come.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.common import blocks_for
from lakeward.session import settled

NEAREST = 20
# Dimensions of the projection (even), and the share of true neighbours that a stop may miss.
DIMENSIONS, MISSED = 8, 0.02
SEED = 17
# Vectors of a block of the index, the sample from which the cells are cut, and the most cells.
BLOCK, SAMPLE, CELLS = 16_384, 100_000, 4096
# Points of a leaf of a block's tree, verified together.
LEAF = 128
# Queries of a group that meet one block.
QUERIES = 16_384


def chi_square_share(x: float, dimensions: int = DIMENSIONS) -> float:
    """The chi-square distribution function for an even number of dimensions."""
    half = x / 2
    return 1 - math.exp(-half) * sum(half**i / math.factorial(i) for i in range(dimensions // 2))


@lru_cache(8)
def stop_factor(missed: float = MISSED, dimensions: int = DIMENSIONS) -> float:
    """Squared projected over squared true distance that only a share `missed` of neighbours passes."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_share(mid, dimensions) < 1 - missed else (low, mid)
    return high


def projection(width: int) -> np.ndarray:
    """A Gaussian matrix, each row scaled to its expected length: a difference in one component alone,
    such as the one added, then has the mean of the chi-square law and not one draw of it for all vectors."""
    rows = np.random.default_rng(SEED).standard_normal((width, DIMENSIONS))
    return rows * np.sqrt(DIMENSIONS / (rows**2).sum(axis=1, keepdims=True))


class KdTree:
    """Points in few dimensions, in leaves of at most LEAF that halve the widest side again and again.

    `rows` are the points of each leaf, `low` and `high` the corners of their boxes.
    """

    def __init__(self, points: np.ndarray):
        self.rows: list[np.ndarray] = []
        self._build(points, np.arange(len(points)))
        self.low = np.array([points[r].min(axis=0) for r in self.rows])
        self.high = np.array([points[r].max(axis=0) for r in self.rows])

    def _build(self, points: np.ndarray, rows: np.ndarray) -> None:
        if len(rows) <= LEAF:
            self.rows.append(rows)
            return
        own = points[rows]
        axis = int(np.argmax(np.ptp(own, axis=0)))
        middle = len(rows) // 2
        halves = rows[np.argpartition(own[:, axis], middle)]
        self._build(points, halves[:middle])
        self._build(points, halves[middle:])

    def distances(self, shadows: np.ndarray) -> np.ndarray:
        """The squared projected distance from each query to the box of each leaf."""
        out = np.zeros((len(shadows), len(self.rows)))
        for axis in range(shadows.shape[1]):
            at = shadows[:, axis, None]
            out += np.maximum(0.0, np.maximum(self.low[:, axis] - at, at - self.high[:, axis])) ** 2
        return out


def _best(owner: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Places of the NEAREST + 1 best of each owner, best first; equal scores by id."""
    order = np.lexsort((ids, -scores, owner))
    sorted_owner = owner[order]
    head = np.concatenate(([True], sorted_owner[1:] != sorted_owner[:-1]))
    first = np.flatnonzero(head)
    rank = np.arange(len(order)) - first[np.cumsum(head) - 1]
    return order[rank <= NEAREST]


def search(
    tree: KdTree, vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, shadows: np.ndarray, reach: np.ndarray, squares: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest rows of one block to each query, as (query, score, id), best first.

    `reach` is the squared distance of the worst of the neighbours that are known already, `squares` the
    squared lengths of query and vectors together, so that a distance is squares - 2 * score. In each round
    all queries that the stopping test leaves open verify their next nearest leaf.
    """
    factor, reach = stop_factor(), reach.copy()
    distances = tree.distances(shadows)
    order = np.argsort(distances, axis=1, kind="stable")
    owner, scores, names = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
    for turn in range(order.shape[1]):
        leaf = order[:, turn]
        near = distances[np.arange(len(leaf)), leaf]
        open_ = np.flatnonzero(near <= factor * np.maximum(reach, 0.0) * (1 + 1e-9) + 1e-9)
        if not len(open_):
            break
        least = (squares - reach) / 2 - 1e-9 * (1 + squares)  # no lower score can be among the best
        parts = [(owner, scores, names)]
        for at in np.unique(leaf[open_]):
            asked, rows = open_[leaf[open_] == at], tree.rows[at]
            # Summed in one order for every pair, so that equal vectors have equal scores wherever they stand.
            found = np.einsum("qd,vd->qv", queries[asked], vectors[rows])
            q, v = np.nonzero(found >= least[asked, None])
            parts.append((asked[q], found[q, v], ids[rows[v]]))
        owner, scores, names = (np.concatenate(x) for x in zip(*parts, strict=True))
        best = _best(owner, scores, names)
        owner, scores, names = owner[best], scores[best], names[best]
        last = np.flatnonzero(np.bincount(owner, minlength=len(queries)) > NEAREST)
        end = np.searchsorted(owner, last, side="right") - 1
        reach[last] = np.minimum(reach[last], squares[last] - 2 * scores[end])
    return owner, scores, names


def _valid(vector: Column) -> Column:
    """Vectors that take part: neither null nor empty nor zero, all components finite numbers."""
    return (
        vector.isNotNull()
        & (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0)
    )


def places(vectors: np.ndarray, ceiling: float) -> np.ndarray:
    """Where vectors, lengthened to the square root of `ceiling` by one more component, fall in the projection."""
    spare = np.maximum(0.0, ceiling - (vectors**2).sum(axis=1))
    matrix = projection(vectors.shape[1] + 1)
    return vectors @ matrix[:-1] + np.sqrt(spare)[:, None] * matrix[-1]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64)


class Cells:
    """A kd-tree of cuts that deals all points of the projection to cells, and bounds their distance."""

    def __init__(self, sample: np.ndarray, wanted: int):
        # (axis, cut, left, right); a cell is (-1, its number, ...).
        self.nodes: list[tuple] = []
        self.count = 0
        self._build(sample, wanted)

    def _build(self, points: np.ndarray, wanted: int) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        spread = np.ptp(points, axis=0) if len(points) else np.zeros(DIMENSIONS)
        axis = int(np.argmax(spread))
        if wanted < 2 or len(points) < 2 or spread[axis] == 0:
            self.nodes[at] = (-1, self.count, -1, -1)
            self.count += 1
            return at
        cut = float(np.median(points[:, axis]))
        low = points[:, axis] < cut
        if not low.any():  # the median is the smallest value
            cut = float(points[points[:, axis] > cut, axis].min())
            low = points[:, axis] < cut
        left = self._build(points[low], wanted // 2)
        right = self._build(points[~low], wanted - wanted // 2)
        self.nodes[at] = (axis, cut, left, right)
        return at

    def of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int32)
        work = [(0, np.arange(len(points)))]
        while work:
            at, rows = work.pop()
            axis, cut, left, right = self.nodes[at]
            if axis < 0:
                out[rows] = cut
            elif len(rows):
                low = points[rows, axis] < cut
                work += [(left, rows[low]), (right, rows[~low])]
        return out

    def within(self, point: np.ndarray, radius: float) -> list[int]:
        """Cells that a ball of this squared radius may touch."""
        out, work = [], [(0, np.zeros(DIMENSIONS), 0.0)]
        while work:
            at, gaps, total = work.pop()
            axis, cut, left, right = self.nodes[at]
            if axis < 0:
                out.append(cut)
                continue
            gap = float(point[axis]) - cut
            near, far = (left, right) if gap < 0 else (right, left)
            work.append((near, gaps, total))
            beyond = total - gaps[axis] ** 2 + gap**2
            if beyond <= radius:
                moved = gaps.copy()
                moved[axis] = gap
                work.append((far, moved, beyond))
        return out


def _in_block(ceiling: float):
    """Search of a group of queries in one block, whose tree is built where the group is."""

    def run(key, queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(block):
            return pd.DataFrame({"query": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        tree, asked = KdTree(_matrix(block["place"])), _matrix(queries["vector"])
        owner, scores, ids = search(
            tree, _matrix(block["vector"]), block["vec_id"].to_numpy(np.int64), asked, _matrix(queries["place"]),
            queries["reach"].to_numpy(np.float64), (asked**2).sum(axis=1) + ceiling,
        )
        return pd.DataFrame({"query": queries["query"].to_numpy(np.int64)[owner], "vec_id": ids, "score": scores})

    return run


def _searched(queries: DataFrame, blocks: DataFrame, ceiling: float) -> DataFrame:
    """(query, vec_id, score): the best of each block that a query is sent to.

    `queries` has cell and part, the block; a block with many queries is copied for each group of them.
    """
    groups = queries.groupBy("cell", "part").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("groups"))
    copied = blocks.join(groups, ["cell", "part"]).withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    dealt = queries.join(groups, ["cell", "part"]).withColumn("group", F.pmod(F.xxhash64("query"), F.col("groups")).cast("int"))
    key = ["cell", "part", "group"]
    return (
        dealt.select(*key, "query", "vector", "place", "reach")
        .groupBy(*key)
        .cogroup(copied.select(*key, "vec_id", "vector", "place").groupBy(*key))
        .applyInPandas(_in_block(ceiling), "query long, vec_id long, score double")
    )


def nearest(embeddings: DataFrame, query_every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the NEAREST neighbours by inner product of each query row.

    `embeddings` has vec_id and embedding; queries are the rows whose vec_id is divisible by `query_every`, candidates
    all rows but the query's own. Vectors that are null, empty, zero or hold a null or non-finite component take no
    part, nor do rows without vec_id; vectors of a width other than the most frequent one (of several the largest) neither. Of rows
    repeated with one vec_id one takes part. Equal scores are ordered by vec_id. Other columns are not read. No rows: an empty result.

    Of equal vectors only the NEAREST + 1 with the smallest ids can be among a result, so only these are indexed.
    The cells are cut by a bounded sample; every vector is dealt to them. A cell of more than a
    block is cut into blocks by a hash. A query is first verified in a block of its own cell, which bounds
    how far its neighbours are; then in each block of each cell that the stopping test leaves open.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col("vec_id").cast("bigint"), F.col("embedding").alias("vector")).where("vec_id is not null")
    rows = rows.where(_valid(F.col("vector")))
    width = rows.groupBy(F.size("vector").alias("w")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("w")).first()
    empty = "query_id long, rank int, vec_id long, score double"
    if width is None:
        return spark.createDataFrame([], empty)
    rows = rows.where(F.size("vector") == width["w"])
    first = Window.partitionBy("vector").orderBy("vec_id")
    # Equal vectors share the first of their ids as a name.
    distinct = rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    copies = distinct.withColumn("n", F.row_number().over(first)).where(F.col("n") <= NEAREST + 1)
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    ceiling, total = rows.agg(F.max(squares), F.count(F.lit(1))).first()
    ceiling = float(ceiling)

    # The sample is a share of the rows by a hash of their id; its limit only guards against equal ids.
    kept = int(min(1.0, SAMPLE / max(1, total)) * (1 << 20)) + 1
    sample = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < kept).limit(2 * SAMPLE).toPandas()
    points = places(_matrix(sample["vector"]).reshape(len(sample), width["w"]), ceiling)
    cells = spark.sparkContext.broadcast(Cells(points, min(CELLS, blocks_for(total, BLOCK // 2))))

    def deal(batches):
        for batch in batches:
            if len(batch):
                found = places(_matrix(batch["vector"]), ceiling)
                yield batch.assign(place=list(found), cell=cells.value.of(found))

    schema = "vec_id long, vector array<float>, place array<double>, cell int"
    dealt = settled(copies.select("vec_id", "vector").mapInPandas(deal, schema), "dealt")
    parts = settled(dealt.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts")), "parts")
    of_cell = F.broadcast(parts)  # at most CELLS rows
    blocks = dealt.join(of_cell, "cell").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")).drop("parts")
    return _answers(distinct, blocks, parts, cells, ceiling, query_every)


def _answers(distinct: DataFrame, blocks: DataFrame, parts: DataFrame, cells, ceiling: float, query_every: int) -> DataFrame:
    """The two rounds of the search. Equal queries are searched once."""
    every = distinct.where(F.col("vec_id") % query_every == 0)
    names = settled(every.groupBy("vector").agg(F.min("vec_id").alias("query")), "queries")

    def place(batches):
        for batch in batches:
            if len(batch):
                vectors = _matrix(batch["vector"])
                points = vectors @ projection(vectors.shape[1] + 1)[:-1]
                yield batch.assign(place=list(points), cell=cells.value.of(points))

    schema = "vector array<float>, query long, place array<double>, cell int"
    queries = settled(names.mapInPandas(place, schema), "placed_queries")
    # Each query in one block of its own cell; if that has no vector, nothing bounds its reach.
    home = F.pmod(F.xxhash64("query"), F.col("parts")).cast("int")
    at_home = queries.join(F.broadcast(parts), "cell").withColumn("part", home).withColumn("reach", F.lit(float("inf")))
    near = settled(_searched(at_home, blocks, ceiling), "home")
    worst = near.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("worst"))
    own = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    distance = F.when(F.col("n") > NEAREST, F.greatest(F.lit(0.0), own + ceiling - 2 * F.col("worst"))).otherwise(float("inf"))
    bounded = queries.join(worst, "query", "left").withColumn("reach", F.coalesce(distance, F.lit(float("inf"))))

    def spread(batches):
        factor = stop_factor()
        for batch in batches:
            out = []
            for vector, name, point, reach in zip(batch["vector"], batch["query"], batch["place"], batch["reach"], strict=True):
                radius = factor * reach * (1 + 1e-9) + 1e-9
                out += [(vector, name, point, reach, c) for c in cells.value.within(np.asarray(point), radius)]
            yield pd.DataFrame(out, columns=["vector", "query", "place", "reach", "cell"])

    wide = bounded.select("vector", "query", "place", "reach").mapInPandas(
        spread, "vector array<float>, query long, place array<double>, reach double, cell int"
    )
    sent = wide.join(F.broadcast(parts), "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    found = _searched(sent, blocks, ceiling)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    top = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= NEAREST + 1).drop("n")
    # Every query row takes the result of its vector, without itself.
    named = every.join(names, "vector").select(F.col("vec_id").alias("query_id"), "query")
    others = named.join(top, "query").where("vec_id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return others.withColumn("rank", rank.cast("int")).where(F.col("rank") <= NEAREST).select("query_id", "rank", "vec_id", "score")
