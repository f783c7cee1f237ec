"""Approximate nearest neighbours from low-dimensional stable projections and kd-trees.

Vectors are projected by a Gaussian (2-stable) matrix: the squared projected
distance of two vectors, over their squared true distance, follows a
chi-square law with as many degrees of freedom as projections.  A kd-tree over
the projections, its top fitted on a bounded sample, deals all vectors to
cells, and cells that come out large are dealt on into parts of bounded size;
each part holds a kd-tree of its own.  A query takes its first neighbours from
one part of its own cell and then visits the others.  Projected neighbours are
verified in the order of growing projected distance until the chi-square test
holds: a vector nearer than the k-th verified one would, with probability
``confidence``, have a smaller projected distance than the next.

Equal vectors are searched for once, and of equal candidates only as many are
held as anyone can need, so copies of one vector make no work.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import materialise

K = 10
EVERY = 100
PROJECTIONS = 32
CONFIDENCE = 0.88
SEED = 7
#: Vectors the top of the tree is fitted on, at most.
SAMPLE = 20_000
#: Vectors a cell holds on average, while the sample is large enough to split that far; a part holds at most about twice as many.
CELL = 2000
#: Vectors in a leaf of a cell's own tree.
LEAF = 32


def projection(dims: int, projections: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dims, projections))


def chi_square_cdf(x: np.ndarray, degrees: int) -> np.ndarray:
    """Chi-square distribution function for an even number of degrees: a Poisson tail."""
    half = np.asarray(x, dtype=np.float64) / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, degrees // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def stop_ratio(degrees: int, confidence: float) -> float:
    """Squared projected over squared true distance beyond which the test holds."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, degrees) < confidence else (low, middle)
    return high


@dataclass
class Split:
    """Points at most ``cut`` along ``axis`` go left; a cell has a number instead."""

    axis: int = 0
    cut: float = 0.0
    left: Split | None = None
    right: Split | None = None
    cell: int = -1


def _halve(points: np.ndarray) -> tuple[int, float] | None:
    axis = int(np.argmax(points.max(0) - points.min(0)))
    values = np.sort(points[:, axis])
    cut = values[(len(values) - 1) // 2]
    if cut == values[-1]:  # ties up to the top: cut below them
        below = values[values < cut]
        if not len(below):
            return None
        cut = below[-1]
    return axis, float(cut)


def fit_tree(points: np.ndarray, leaf: int) -> tuple[Split, int]:
    cells = 0

    def grow(part: np.ndarray) -> Split:
        nonlocal cells
        found = _halve(part) if len(part) > leaf else None
        if found is None:
            cells += 1
            return Split(cell=cells - 1)
        near = part[:, found[0]] <= found[1]
        return Split(*found, grow(part[near]), grow(part[~near]))

    return grow(points), cells


def cells_of(node: Split, points: np.ndarray) -> np.ndarray:
    out = np.empty(len(points), dtype=np.int32)

    def go(node: Split, index: np.ndarray) -> None:
        if node.left is None:
            out[index] = node.cell
            return
        near = points[index, node.axis] <= node.cut
        go(node.left, index[near])
        go(node.right, index[~near])

    go(node, np.arange(len(points)))
    return out


def cells_near(node: Split, point: np.ndarray, reach: float) -> list[int]:
    """Cells with a place at most ``reach`` (squared) from a point; the home cell is among them."""
    out: list[int] = []

    def go(node: Split, gaps: dict[int, float], far: float) -> None:
        if far > reach:
            return
        if node.left is None:
            out.append(node.cell)
            return
        gap = point[node.axis] - node.cut
        near, other = (node.left, node.right) if gap <= 0 else (node.right, node.left)
        go(near, gaps, far)
        own = gaps.get(node.axis, 0.0)
        if gap * gap > own:
            go(other, gaps | {node.axis: gap * gap}, far - own + gap * gap)
        else:
            go(other, gaps, far)

    go(node, {}, 0.0)
    return out


class Cell:
    """A cell's vectors with their projections under a kd-tree of boxes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, matrix: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        self.projected = vectors @ matrix
        leaves: list[np.ndarray] = []

        def grow(index: np.ndarray) -> None:
            found = _halve(self.projected[index]) if len(index) > LEAF else None
            if found is None:
                leaves.append(index)
                return
            near = self.projected[index, found[0]] <= found[1]
            grow(index[near])
            grow(index[~near])

        grow(np.arange(len(ids)))
        self.leaves = leaves
        #: Vectors whose true distance was taken, over all queries.
        self.verified = 0
        self.low = np.array([self.projected[i].min(0) for i in leaves])
        self.high = np.array([self.projected[i].max(0) for i in leaves])

    def nearest(self, vector: np.ndarray, point: np.ndarray, k: int, bound: float, ratio: float) -> list[tuple[float, int]]:
        """The best ``k`` of this cell as ``(squared distance, id)``; ``bound`` is a k-th squared distance known already."""
        gaps = np.maximum(np.maximum(self.low - point, point - self.high), 0.0)
        far = (gaps * gaps).sum(1)
        best: list[tuple[float, int]] = []
        for leaf in np.argsort(far, kind="stable").tolist():
            if far[leaf] > ratio * bound:
                break
            index = self.leaves[leaf]
            off = self.projected[index] - point
            index = index[(off * off).sum(1) <= ratio * bound]
            if not len(index):
                continue
            self.verified += len(index)
            off = self.vectors[index] - vector
            found = (off * off).sum(1)
            fine = found <= bound
            best = sorted([*best, *zip(found[fine].tolist(), self.ids[index][fine].tolist())])[:k]
            if len(best) == k:
                bound = min(bound, best[-1][0])
        return best


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, vector)`` in double precision, without null, zero and non-finite vectors."""
    v = F.col("embedding").cast(T.ArrayType(T.DoubleType()))
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.filter(F.col("embedding").isNotNull() & F.coalesce(sound, F.lit(False)) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector")
    )


def _matrix_of(column: pd.Series | pa.Array) -> np.ndarray:
    return np.stack([np.asarray(x, dtype=np.float64) for x in column]) if len(column) else np.empty((0, 0))


def search(
    vectors: DataFrame, k: int = K, every: int = EVERY, projections: int = PROJECTIONS, confidence: float = CONFIDENCE,
    sample: int = SAMPLE, cell: int = CELL,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows found for each row whose vec_id is divisible by ``every``.

    ``score`` is the Euclidean distance of the original vectors in double
    precision; ties go to the smaller vec_id.  ``vectors`` needs ``vec_id`` and
    ``embedding``; other columns are ignored.  Defined results: vectors that are
    null, empty, zero or hold null or non-finite components, and rows with a
    null vec_id, take no part, whatever their length; vectors of different
    lengths are never neighbours, so each length is searched by itself; rows
    that repeat both id and vector count once; with fewer candidates than ``k``
    a query gets all found; an empty table gives no rows.
    """
    rows = materialise(usable(vectors).distinct(), "ann-rows")
    lengths = [row[0] for row in rows.select(F.size("vector")).distinct().toLocalIterator()]
    found = [_search_length(rows.filter(F.size("vector") == dims), dims, k, every, projections, confidence, sample, cell) for dims in sorted(lengths)]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, found)


def _search_length(rows: DataFrame, dims: int, k: int, every: int, projections: int, confidence: float, sample: int, cell: int) -> DataFrame:
    """:func:`search` among usable vectors of one length."""
    # One more than asked for, as a query drops itself afterwards.
    wanted = k + 1
    equal = Window.partitionBy("vector").orderBy("vec_id")
    kept = materialise(rows.withColumn("_n", F.row_number().over(equal)).filter(F.col("_n") <= wanted).drop("_n"), "ann-vectors")
    members = rows.filter(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id")
    distinct = materialise(members.groupBy("vector").agg(F.min("query_id").alias("asked_id")), "ann-asked")
    matrix, ratio = projection(dims, projections), stop_ratio(projections, confidence)
    n = kept.count()
    picked = _matrix_of(kept.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toPandas()["vector"])
    tree, _ = fit_tree(picked @ matrix, max(8, int(cell * len(picked) / max(n, 1))))
    vector = "vector array<double>"

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix_of(batch["vector"].to_pylist())
            if len(points):
                yield pa.RecordBatch.from_arrays([pa.array(cells_of(tree, points @ matrix)), *batch.columns], ["cell", *batch.schema.names])

    placed = materialise(kept.mapInArrow(home, f"cell int, vec_id long, {vector}"), "ann-cells")
    # One row per cell, and no more cells than an eighth of the sample.
    parts = {r["cell"]: -(-r["n"] // (2 * cell)) for r in placed.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    sized = F.broadcast(rows.sparkSession.createDataFrame(list(parts.items()), "cell int, parts long"))
    dealt = placed.join(sized, "cell").select("cell", F.pmod(F.xxhash64("vec_id"), "parts").alias("part"), "vec_id", "vector")

    def first_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in home(batches):
            part = [i % parts.get(c, 1) for i, c in zip(batch["asked_id"].to_pylist(), batch["cell"].to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int64())], [*batch.schema.names, "part"])

    asked = materialise(distinct.select("asked_id", "vector").mapInArrow(first_part, f"cell int, asked_id long, {vector}, part long"), "ann-first")
    columns, kinds = ["asked_id", "vec_id", "score"], "asked_id long, vec_id long, score double"

    def answer(held: pd.DataFrame, asking: pd.DataFrame, bounds: np.ndarray) -> pd.DataFrame:
        if not len(asking) or not len(held):
            return pd.DataFrame([], columns=columns)
        index = Cell(held["vec_id"].to_numpy(), _matrix_of(held["vector"]), matrix)
        out = []
        for query, own, bound in zip(asking["asked_id"].tolist(), asking["vector"], bounds.tolist()):
            own = np.asarray(own, dtype=np.float64)
            out.extend((query, i, float(np.sqrt(d))) for d, i in index.nearest(own, own @ matrix, wanted, bound, ratio))
        return pd.DataFrame(out, columns=columns)

    def first(held: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        return answer(held, asking, np.full(len(asking), np.inf))

    by_part = dealt.groupBy("cell", "part")
    at_home = materialise(by_part.cogroup(asked.groupBy("cell", "part")).applyInPandas(first, kinds), "ann-home")
    bounds = at_home.groupBy("asked_id").agg(F.count("*").alias("n"), F.max("score").alias("far"))
    bound = F.when(F.col("n") >= wanted, F.col("far")).otherwise(float("inf"))
    bounded = asked.join(bounds, "asked_id", "left").select("cell", "part", "asked_id", "vector", bound.alias("bound"))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix_of(batch["vector"].to_pylist())
            if not len(points):
                continue
            number, part, index = [], [], []
            for i, (point, far, *own) in enumerate(zip(points @ matrix, *[batch[c].to_pylist() for c in ("bound", "cell", "part")])):
                for c in cells_near(tree, point, ratio * far * far):
                    others = [p for p in range(parts.get(c, 0)) if [c, p] != own]
                    number.extend([c] * len(others))
                    part.extend(others)
                    index.extend([i] * len(others))
            asking = batch.take(pa.array(index, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(number, pa.int32()), pa.array(part, pa.int64()), *[asking[c] for c in ("asked_id", "vector", "bound")]], ["cell", "part", "asked_id", "vector", "bound"]
            )

    visits = bounded.mapInArrow(visit, f"cell int, part long, asked_id long, {vector}, bound double")

    def rest(held: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        # A little above, so that squaring a rounded root loses no tie.
        return answer(held, asking, asking["bound"].to_numpy() ** 2 * (1 + 1e-12))

    elsewhere = by_part.cogroup(visits.groupBy("cell", "part")).applyInPandas(rest, kinds)
    best = Window.partitionBy("asked_id").orderBy("score", "vec_id")
    top = at_home.unionByName(elsewhere).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= wanted).drop("rank")
    ranked = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        members.join(distinct, "vector").select("query_id", "asked_id").join(top, "asked_id").filter("vec_id <> query_id")
        .select("query_id", F.row_number().over(ranked).alias("rank"), "vec_id", "score")
        .filter(F.col("rank") <= k)
    )
