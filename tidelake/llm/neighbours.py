"""Approximate nearest neighbours by largest inner product, with early stopping.

One more component, which makes all vectors as long as the longest, turns the largest
inner product into the least distance. Vectors are then projected to a few dimensions
by Gaussian (2-stable) directions: the square of a projected distance, divided by that
of the true one, follows a chi-square law. A kd-tree of the projected vectors gives
projected neighbours nearest first, and each is verified on the original vectors. The
search stops when a vector as near as the worst of the best found would have been
projected within the radius reached so far with probability ``CONFIDENCE``; there is no
other limit, so that with a confidence of 1 all is verified.

A top tree over the projections of a sample (some ``SAMPLE`` rows of each length of
vectors, taken at random) deals every row to a cell. A query is searched in the
``FIRST_CELLS`` nearest cells first; the worst of the best found there gives a radius, and
of the others only the cells whose box lies within it are searched next. Boxes hold all
rows of their cell, so that what is left out is what the stopping test would leave out. A cell of more than ``BLOCK`` rows is dealt by a
hash into parts, and its queries into blocks, so that every unit has a bounded size. Each
part has a kd-tree of its own.

Of equal vectors only those with the least ids can be among the best of any query, so the
others are no candidates, however many copies there are; all are queries if asked for.

Vectors that are null, empty or zero, that hold nulls or components that are not finite,
and rows without an id take no part. Only vectors of equal length are compared. Rows with
the id of a query are not its candidates; other repeated ids are candidates each. Ties
go to the smaller id. An empty table gives no rows. Other columns are left out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidelake.llm.tables import written

NEIGHBOURS = 20
DIRECTIONS = 12  # even, for the closed form of the chi-square law
CONFIDENCE = 0.95
BLOCK = 16_384
QUERY_BLOCK = 1024
LEAF = 64
# Rows whose projections shape the top tree, and how many of them a cell has at least.
SAMPLE = 65_536
PER_CELL = 16
FIRST_CELLS = 3
_SEED = 424242


def chi_square(x: float, degrees: int = DIRECTIONS) -> float:
    """Distribution function for an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    for i in range(1, degrees // 2):
        term *= half / i
        total += term
    return 1 - exp(-half) * total


def quantile(probability: float, degrees: int = DIRECTIONS) -> float:
    if probability >= 1:
        return float("inf")
    low, high = 0.0, 1000.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < probability else (low, middle)
    return high


def directions(length: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(_SEED)).standard_normal((length + 1, DIRECTIONS))


class Tree:
    """kd-tree over the rows of ``points``; leaves are runs of ``order`` with their boxes."""

    def __init__(self, points: np.ndarray):
        leaves, stack = [], [np.arange(len(points))]
        while stack:
            rows = stack.pop()
            if len(rows) <= LEAF:
                leaves.append(rows)
                continue
            part = points[rows]
            axis = np.argmax(part.max(axis=0) - part.min(axis=0))
            middle = len(rows) // 2
            split = rows[np.argpartition(part[:, axis], middle)]
            stack += [split[middle:], split[:middle]]
        self.order = np.concatenate(leaves)
        self.bounds = np.cumsum([0, *map(len, leaves)])
        self.low = np.array([points[rows].min(axis=0) for rows in leaves])
        self.high = np.array([points[rows].max(axis=0) for rows in leaves])

    def distances(self, queries: np.ndarray) -> np.ndarray:
        """Squared distance of each query to the box of each leaf."""
        return box_distances(queries, self.low, self.high)


def search(
    ids: np.ndarray,
    vectors: np.ndarray,
    projected: np.ndarray,
    query_ids: np.ndarray,
    queries: np.ndarray,
    targets: np.ndarray,
    known: np.ndarray,
    longest: float,
    confidence: float,
    k: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Index of each query with ids and scores of the best of one unit.

    ``known``: a score that k others reach elsewhere, or minus infinity.
    """
    tree = Tree(projected)
    ids, vectors, projected = ids[tree.order], vectors[tree.order], projected[tree.order]
    limit = quantile(confidence)
    nearness = tree.distances(targets)
    leaf_order = np.argsort(nearness, axis=1, kind="stable")
    total = (queries**2).sum(axis=1) + longest**2
    radii = within(total, known, limit)
    for i, (query, target) in enumerate(zip(queries, targets, strict=True)):
        best_ids, best = np.empty(0, np.int64), np.empty(0)
        radius, at, step = radii[i], 0, 2
        near, leaves = nearness[i], leaf_order[i]
        while at < len(leaves) and near[leaves[at]] <= radius:
            some = leaves[at : at + step]
            some = some[near[some] <= radius]
            at, step = at + step, min(2 * step, 32)
            rows = np.concatenate([np.arange(tree.bounds[x], tree.bounds[x + 1]) for x in some])
            rows = rows[(((projected[rows] - target) ** 2).sum(axis=1) <= radius) & (ids[rows] != query_ids[i])]
            # Row by row, so that equal vectors have equal scores.
            best = np.concatenate([best, np.einsum("ij,j->i", vectors[rows], query)])
            best_ids = np.concatenate([best_ids, ids[rows]])
            if len(best) > k:
                worst = -np.partition(-best, k - 1)[k - 1]
                kept = best >= worst
                best, best_ids = best[kept], best_ids[kept]
                first = np.lexsort((best_ids, -best))[:k]
                best, best_ids = best[first], best_ids[first]
            if len(best) == k:
                radius = min(radius, limit * max(total[i] - 2 * best.min(), 0.0))
        yield i, best_ids, best


def within(total: np.ndarray, known: np.ndarray, limit: float) -> np.ndarray:
    """Squared projected radius beyond which nothing better than ``known`` is expected."""
    found = np.isfinite(known)
    radii = np.full(len(total), np.inf)
    if np.isfinite(limit):
        radii[found] = limit * np.maximum(total[found] - 2 * known[found], 0.0)
    return radii


class Cells:
    """Top tree over a sample of projected vectors; every vector falls into one of its cells."""

    def __init__(self, points: np.ndarray, cells: int):
        """Halves the part with the most points until there are ``cells``, or nothing to halve."""
        self.axis, self.at, self.below = [-1], [0.0], [(0, 0)]
        parts, leaves = [(-len(points), 0, points)], []
        while parts and len(parts) + len(leaves) < cells:
            _, node, part = heapq.heappop(parts)
            spread = part.max(axis=0) - part.min(axis=0)
            axis = int(np.argmax(spread))
            if spread[axis] == 0:
                leaves.append(node)
                continue
            values = np.sort(part[:, axis])
            # Not the greatest value, so that both sides have points.
            at = min(values[len(values) // 2 - 1], values[values < values[-1]][-1])
            left = part[:, axis] <= at
            children = (len(self.axis), len(self.axis) + 1)
            self.axis[node], self.at[node], self.below[node] = axis, at, children
            for child, points_of in zip(children, (part[left], part[~left]), strict=True):
                self.axis.append(-1)
                self.at.append(0.0)
                self.below.append((0, 0))
                heapq.heappush(parts, (-len(points_of), child, points_of))

    def cell(self, points: np.ndarray) -> np.ndarray:
        """Number of the node without children that each point comes to."""
        axis, at, below = np.array(self.axis), np.array(self.at), np.array(self.below)
        node = np.zeros(len(points), np.int32)
        moving = np.flatnonzero(axis[node] >= 0)
        while len(moving):
            n = node[moving]
            right = points[moving, axis[n]] > at[n]
            node[moving] = below[n, right.astype(int)]
            moving = moving[axis[node[moving]] >= 0]
        return node


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each box."""
    result = np.zeros((len(points), len(low)))
    for axis in range(points.shape[1]):
        q = points[:, axis : axis + 1]
        result += np.maximum(np.maximum(low[:, axis] - q, q - high[:, axis]), 0) ** 2
    return result


_RESULT = "query_id long, twin long, vec_id long, score double"
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
_ROW = "id long, v array<double>, length int, twin long"


def _usable(vector: Column) -> Column:
    """Not null or empty, without nulls and values that are not finite, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def nearest(
    df: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = NEIGHBOURS,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found for each row that is a query."""
    rows = df.select(
        df[key].cast("long").alias("id"), df[vector].cast("array<double>").alias("v"), is_query.alias("asks")
    ).filter(F.col("id").isNotNull() & _usable(F.col("v")))
    rows = written(rows.withColumns({"length": F.size("v"), "twin": F.xxhash64("v")}), "vectors")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x))
    longest = rows.agg(F.max(norm)).first()[0] or 0.0
    tops = _tops(rows, longest)

    candidates = written(_placed(_least_twins(rows, k), longest, tops), "candidates")
    queries = rows.filter("asks").dropDuplicates(["id", "twin", "length"]).select(*_NAMES)
    edges = [f(F.get("p", F.lit(i))).alias(f"{name}{i}") for name, f in (("low", F.min), ("high", F.max)) for i in range(DIRECTIONS)]
    cells = written(candidates.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("rows"), *edges), "cells")
    boxes = _boxes(cells.filter(F.col("length").isin(list(tops))))

    def found(asked: DataFrame) -> DataFrame:
        return _searched(candidates, cells.select("length", "cell", "rows"), written(asked, "visits"), longest, confidence, k)

    none = F.lit(None).cast("double")
    best = written(found(_visits(queries.withColumn("known", none), boxes, longest, confidence, True)), "first")
    if tops:
        order = Window.partitionBy("query_id", "twin").orderBy(F.desc("score"), "vec_id")
        worst = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == k)
        worst = worst.select(F.col("query_id").alias("id"), "twin", F.col("score").alias("known"))
        again = queries.filter(F.col("length").isin(list(tops))).join(worst, ["id", "twin"], "left")
        best = best.union(found(_visits(again, boxes, longest, confidence, False)))
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(by_score))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _project(vectors: np.ndarray, longest: float, asks: bool) -> np.ndarray:
    """Projections; those of candidates have the component that makes all as long as the longest."""
    away = directions(vectors.shape[1])
    if asks:
        return vectors @ away[:-1]
    spare = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(axis=1), 0))
    return vectors @ away[:-1] + spare[:, None] * away[-1]


def _tops(rows: DataFrame, longest: float) -> dict[int, Cells]:
    """A top tree for each length of vectors that has more than a block of rows."""
    counts = rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK).collect()
    sizes = {row["length"]: row["n"] for row in counts}
    if not sizes:
        return {}
    sample = rows.sampleBy("length", {length: min(1.0, SAMPLE / n) for length, n in sizes.items()}, _SEED)
    points = _placed(sample, longest, {}).select("length", "p").toArrow()
    length, p = points.column("length").to_numpy(), _matrix(points.column("p").combine_chunks(), DIRECTIONS)
    return {
        each: Cells(p[length == each], min(-(-n // BLOCK), max((length == each).sum() // PER_CELL, 1)))
        for each, n in sizes.items()
    }


def _placed(rows: DataFrame, longest: float, tops: dict[int, Cells]) -> DataFrame:
    """The rows with their projection ``p`` as candidates and the ``cell`` it falls into."""
    shared = rows.sparkSession.sparkContext.broadcast(tops)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(2).to_numpy()
            for length in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == length))
                p = _project(_matrix(part.column(1), length), longest, False)
                top = shared.value.get(length)
                cell = np.zeros(len(p), np.int32) if top is None else top.cell(p)
                points = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * DIRECTIONS), pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, points, pa.array(cell)], [*_NAMES, "p", "cell"])

    return rows.select(*_NAMES).mapInArrow(work, f"{_ROW}, p array<double>, cell int")


_NAMES = ["id", "v", "length", "twin"]


def _least_twins(rows: DataFrame, k: int) -> DataFrame:
    """Without the rows that k equal vectors of other ids than any query's own come before."""
    twins = Window.partitionBy("length", "twin").orderBy("id")
    repeats = Window.partitionBy("length", "twin", "id").orderBy("id")
    least = rows.withColumn("place", F.dense_rank().over(twins)).filter(F.col("place") <= k + 1).drop("place")
    return least.withColumn("place", F.row_number().over(repeats)).filter(F.col("place") <= k).drop("place")


Boxes = dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def _boxes(cells: DataFrame) -> Boxes:
    """Number and box of each cell, by length; a length has SAMPLE / PER_CELL cells at most."""
    names = [[f"{side}{i}" for i in range(DIRECTIONS)] for side in ("low", "high")]
    by_length = cells.toPandas().sort_values(["length", "cell"]).groupby("length")
    return {length: (part["cell"].to_numpy(), *(part[n].to_numpy(float) for n in names)) for length, part in by_length}


def _visits(asked: DataFrame, boxes: Boxes, longest: float, confidence: float, first: bool) -> DataFrame:
    """Each query once for each of its nearest cells, or for each further one within its radius.

    A length without boxes has one cell.
    """
    shared = asked.sparkSession.sparkContext.broadcast(boxes)
    limit = quantile(confidence)

    def visited(vectors: np.ndarray, known: np.ndarray, boxes: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        distances = box_distances(_project(vectors, longest, True), *boxes[1:])
        nearest = np.zeros(distances.shape, bool)
        np.put_along_axis(nearest, np.argsort(distances, axis=1, kind="stable")[:, :FIRST_CELLS], True, axis=1)
        if first:
            return nearest
        return ~nearest & (distances <= within((vectors**2).sum(axis=1) + longest**2, known, limit)[:, None])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(2).to_numpy()
            for length in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == length))
                for at in range(0, part.num_rows, 256):
                    piece = part.slice(at, 256)
                    known = piece.column(4).to_numpy()
                    if length in shared.value:
                        which, cell = np.nonzero(visited(_matrix(piece.column(1), length), known, shared.value[length]))
                        numbers = shared.value[length][0][cell]
                    else:
                        which, numbers = np.arange(len(known)), np.zeros(len(known))
                    bounds = np.searchsorted(which, np.arange(len(known) + 1)).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(numbers.astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([*piece.columns, lists], [*_NAMES, "known", "cells"])

    known = F.coalesce("known", F.lit(float("-inf"))).alias("known")
    listed = asked.select(*_NAMES, known).mapInArrow(work, f"{_ROW}, known double, cells array<int>")
    return listed.select(*_NAMES, "known", F.explode("cells").alias("cell"))


def _searched(candidates: DataFrame, cells: DataFrame, asked: DataFrame, longest: float, confidence: float, k: int) -> DataFrame:
    """The best for each query in the cell it is asked in, in units of bounded size."""
    n_asked = asked.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("asked"))
    layout = written(
        n_asked.join(cells, ["length", "cell"]).select(
            "length", "cell", F.ceil(F.col("rows") / BLOCK).cast("int").alias("parts"),
            F.ceil(F.col("asked") / QUERY_BLOCK).cast("int").alias("blocks"),
        ),
        "units",
    )

    def dealt(parts: str) -> Column:
        return F.pmod(F.xxhash64("id", "twin"), F.col(parts)).cast("int")

    def every(parts: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))

    none = F.lit(None)
    rows = candidates.join(layout, ["length", "cell"]).select(
        *_NAMES, "cell", "p", none.cast("double").alias("known"), dealt("parts").alias("part"), every("blocks").alias("block")
    )
    queries = asked.join(layout, ["length", "cell"]).select(
        *_NAMES, "cell", none.cast("array<double>").alias("p"), "known", every("parts").alias("part"), dealt("blocks").alias("block")
    )

    def unit(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        asks = table.column("p").is_null().to_numpy()
        ids, twins = table.column("id").to_numpy(), table.column("twin").to_numpy()
        found = []
        if asks.any() and not asks.all():
            vectors = _matrix(table.column("v").combine_chunks(), table.column("length")[0].as_py())
            projected = _matrix(table.column("p").combine_chunks().drop_null(), DIRECTIONS)
            known = table.column("known").to_numpy()[asks]
            asked_ids, asked_twins, asked_vectors = ids[asks], twins[asks], vectors[asks]
            every = search(
                ids[~asks], vectors[~asks], projected, asked_ids, asked_vectors, _project(asked_vectors, longest, True),
                known, longest, confidence, k,
            )
            found = [(np.full(len(b), asked_ids[i]), np.full(len(b), asked_twins[i]), b, scores) for i, b, scores in every]
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [[], [], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], ["query_id", "twin", "vec_id", "score"])

    return rows.union(queries).groupBy("length", "cell", "part", "block").applyInArrow(unit, _RESULT)
