"""SimHash near-duplicates, linked exactly through vantage-point trees.

A fingerprint has 64 bits.  Distinct fingerprints are dealt to the leaves of a
vantage-point tree whose vantage points come from a bounded sample: a node
sends a fingerprint left if its Hamming distance to the vantage point is at
most the node's radius.  Two fingerprints within ``reach`` bits have distances
to any vantage point that differ by ``reach`` at most (triangle inequality), so
a fingerprint right of a boundary and no more than ``reach`` beyond it also
visits the left side.  Every pair within reach thus meets in a leaf, which
splits further by the same rule and compares what is left.  The tree shapes
only the work; pairs are exact whatever the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gives_back, materialise
from .components import components

SHINGLE = 3
REACH = 2
SEED = 42
#: Fingerprints the tree is fitted on, at most.
SAMPLE = 16_384
#: Fingerprints a leaf holds on average, while the sample is large enough to split that far.
LEAF = 2000
#: Local splitting ends at this many fingerprints.
BLOCK = 1024
#: Shingles whose bits are counted at once.
_CHUNK = 65_536


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Bitwise majority of the XXH64 values (seed 42) of a text's word shingles."""
    import xxhash

    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    stops = ends[len(words) - n :].tolist()
    digest = xxhash.xxh64_digest
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _CHUNK):
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + _CHUNK], stops[at : at + _CHUNK])])
        bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)``: the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(gives_back(run), "doc_id long, fp long")


def _distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


@dataclass
class Node:
    """Points at most ``radius`` from ``vantage`` go left; a leaf has a number instead."""

    vantage: np.uint64 = np.uint64(0)
    radius: int = 0
    left: Node | None = None
    right: Node | None = None
    leaf: int = -1


def _split(points: np.ndarray, rng: np.random.Generator) -> tuple[np.uint64, int] | None:
    """Vantage point and radius that leave the fewest points near the boundary and neither side too small."""
    best, best_cost = None, None
    for vantage in points[rng.choice(len(points), size=min(4, len(points)), replace=False)]:
        reach_of = np.bincount(_distance(points, vantage), minlength=65)
        inside = np.cumsum(reach_of)
        for radius in range(64):
            small = min(inside[radius], len(points) - inside[radius])
            if small * 4 < len(points):
                continue
            cost = reach_of[radius + 1 : radius + 1 + REACH].sum() + max(inside[radius], len(points) - inside[radius])
            if best_cost is None or cost < best_cost:
                best, best_cost = (vantage, radius), cost
    return best


def fit_tree(sample: np.ndarray, leaf_points: int) -> tuple[Node, int]:
    """A tree over sampled fingerprints, and its number of leaves; equal samples give equal trees."""
    rng = np.random.default_rng(SEED)
    leaves = 0

    def grow(points: np.ndarray) -> Node:
        nonlocal leaves
        found = _split(points, rng) if len(points) > leaf_points else None
        if found is None:
            leaves += 1
            return Node(leaf=leaves - 1)
        near = _distance(points, found[0]) <= found[1]
        return Node(found[0], found[1], grow(points[near]), grow(points[~near]))

    return grow(np.sort(sample)), leaves


def route(node: Node, points: np.ndarray, index: np.ndarray, own: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(leaf, index, own)``: where each point lives (``own``) and which other leaves it has to visit."""
    if not len(index):
        return
    if node.left is None:
        yield node.leaf, index, own
        return
    d = _distance(points[index], node.vantage)
    near = d <= node.radius
    go_left = near | (d <= node.radius + reach)
    go_right = ~near | (~own & (d > node.radius - reach))
    yield from route(node.left, points, index[go_left], (own & near)[go_left], reach)
    yield from route(node.right, points, index[go_right], (own & ~near)[go_right], reach)


class Forest:
    """Union-find over positions; keeps only the links that join two trees."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            high, low = np.maximum(x, y), np.minimum(x, y)
            # One link for each tree that goes below another: no cycle can close.
            _, first = np.unique(high, return_index=True)
            self.links.extend(zip(a[first].tolist(), b[first].tolist()))
            self.label[high[first]] = low[first]
            while True:
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up


def _compare(points: np.ndarray, mine: np.ndarray, others: np.ndarray, reach: int, forest: Forest) -> None:
    for at in range(0, len(mine), BLOCK):
        rows = mine[at : at + BLOCK]
        for to in range(0, len(others), 4 * BLOCK):
            cols = others[to : to + 4 * BLOCK]
            i, j = np.nonzero(np.bitwise_count(points[rows][:, None] ^ points[cols][None, :]) <= reach)
            forest.add(rows[i], cols[j])


def link_leaf(points: np.ndarray, own: np.ndarray, reach: int) -> list[tuple[int, int]]:
    """Links of a spanning forest over all pairs within ``reach`` of which one side at least is own."""
    forest = Forest(len(points))
    rng = np.random.default_rng(SEED)

    def go(index: np.ndarray, mine: np.ndarray) -> None:
        if not mine.any():
            return
        found = _split(points[index[mine]], rng) if mine.sum() > BLOCK else None
        if found is None:
            _compare(points, index[mine], index, reach, forest)
            return
        d = _distance(points[index], found[0])
        near = d <= found[1]
        left = near | (d <= found[1] + reach)
        right = ~near | (~mine & (d > found[1] - reach))
        go(index[left], (mine & near)[left])
        go(index[right], (mine & ~near)[right])

    go(np.arange(len(points)), own)
    return forest.links


def links(distinct: DataFrame, reach: int = REACH, sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """``(u, v)``: links between distinct fingerprints ``distinct (fp long)`` that connect all within ``reach`` bits."""
    picked = distinct.orderBy(F.xxhash64("fp"), "fp").limit(sample).toPandas()["fp"].to_numpy(dtype=np.int64).view(np.uint64)
    n = distinct.count()
    tree, leaves = fit_tree(picked, max(8, int(leaf * len(picked) / max(n, 1))))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
            every = np.arange(len(points))
            for number, index, own in route(tree, points, every, np.ones(len(points), dtype=bool), reach):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(index), number, dtype=np.int32)), pa.array(points[index].view(np.int64)), pa.array(own)],
                    ["leaf", "fp", "own"],
                )

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["fp", "own"])
        points = rows["fp"].to_numpy(dtype=np.int64).view(np.uint64)
        found = link_leaf(points, rows["own"].to_numpy(dtype=bool), reach)
        pairs = points[np.array(found, dtype=np.int64).reshape(-1, 2)].view(np.int64)
        return pd.DataFrame({"u": pairs[:, 0], "v": pairs[:, 1]})

    dealt = distinct.select("fp").mapInArrow(gives_back(deal), "leaf int, fp long, own boolean")
    return dealt.groupBy("leaf").applyInPandas(meet, "u long, v long")


def component_of(marked: DataFrame, reach: int = REACH) -> DataFrame:
    """``(fp, component_id)`` for the distinct fingerprints of ``marked (doc_id, fp, ...)``."""
    distinct = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    labels = materialise(components(links(distinct, reach)), "simhash-labels")
    named = materialise(
        distinct.join(labels, distinct["fp"] == labels["node"], "left").select(
            "fp", "least", F.coalesce("label", "fp").alias("label")
        ),
        "simhash-named",
    )
    names = materialise(named.groupBy("label").agg(F.min("least").alias("component_id")), "simhash-names")
    return materialise(named.join(names, "label").select("fp", "label", "component_id"), "simhash-components")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, reach: int = REACH) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``: one row per row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored.  Null,
    empty and blank texts have fingerprint zero and link like any other.
    ``component_id`` is the smallest doc_id reachable over links; a null doc_id
    never names a component unless it has no other member.  An empty table
    gives no rows.
    """
    marked = materialise(fingerprints(docs, shingle), "simhash-fingerprints")
    by_fp = component_of(marked, reach)
    return marked.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, reach: int = REACH) -> DataFrame:
    """One row of each component of ``docs``, with all its columns: that of the smallest doc_id.

    Of rows that repeat a doc_id within a component, and of components without
    any doc_id, one row stays.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in batch["text"].cast(pa.binary()).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch["row"], batch["doc_id"], pa.array(found.view(np.int64))], ["row", "doc_id", "fp"])

    schema = rows.select("row", "doc_id").schema.add("fp", "long")
    marked = materialise(rows.mapInArrow(gives_back(run), schema).withColumn("uid", F.monotonically_increasing_id()), "simhash-documents")
    light = marked.select("uid", "doc_id", "fp")
    labelled = light.join(component_of(light, reach).select("fp", "label"), "fp")
    kept = labelled.groupBy("label").agg(F.min_by("uid", F.struct(F.col("doc_id").isNull(), "doc_id", "uid")).alias("uid"))
    return marked.join(materialise(kept.select("uid"), "simhash-kept"), "uid", "left_semi").select("row.*")
