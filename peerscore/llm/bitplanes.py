"""Exact k-means over integer vectors of 64 components, from bit planes and popcounts.

A component is ``floor(scale * x)`` in two's complement.  Bit ``i`` of all 64
components of a vector is one unsigned 64-bit word, its plane ``i``.  With plane
weights ``1, 2, 4, ...`` and a negative one for the sign plane, the dot product
of two vectors is the sum over pairs of planes of both weights times the
popcount of the planes' AND, exactly.  Distances follow from dot products.

Vectors are packed once and written; a round reads the planes only.  Every task
adds up its own clusters, so a round shuffles one row per task and cluster, and
the driver sees the ``k`` centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Components of a vector: the bits of one word.
DIMS = 64
K = 8
ROUNDS = 10
SCALE = 1024
SALT = "3"
#: Integers from -2**LIMIT up to 2**LIMIT - 1 are taken, so that no distance leaves 64 bits.
LIMIT = 27
#: Vectors worked on at once.
CHUNK = 2048
_LONG = (1 << 63) - 1

ASSIGNED = "vec_id long, cluster int, distance long"


def weights(planes: int) -> np.ndarray:
    """What a bit of each plane stands for."""
    out = np.left_shift(np.int64(1), np.arange(planes, dtype=np.int64))
    out[-1] = -out[-1]
    return out


def to_planes(values: np.ndarray) -> np.ndarray:
    """``(n, planes)`` words of ``(n, 64)`` integers, with as many planes as the widest needs."""
    widest = max(int(values.max()), ~int(values.min())) if len(values) else 0
    planes = [np.packbits((values >> i & 1).astype(np.uint8), axis=1, bitorder="little").view("<u8") for i in range(widest.bit_length() + 1)]
    return np.concatenate(planes, axis=1)


def widened(words: np.ndarray, planes: int) -> np.ndarray:
    """The same vectors in ``planes`` planes: the sign plane is repeated."""
    return np.concatenate([words, np.repeat(words[:, -1:], planes - words.shape[1], axis=1)], axis=1)


def dots(words: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Dot product of each row of ``words`` with the vector ``other`` or, where that has as many rows, row by row."""
    counts = np.bitwise_count(words[:, :, None] & (other[None, None, :] if other.ndim == 1 else other[:, None, :]))
    pairs = np.outer(weights(words.shape[1]), weights(other.shape[-1]))
    return counts.reshape(len(words), -1).astype(np.int64) @ pairs.ravel()


def sums(words: np.ndarray) -> np.ndarray:
    """Sum of the vectors by component: bits counted by plane and position."""
    bits = np.unpackbits(np.ascontiguousarray(words).view(np.uint8).reshape(*words.shape, 8), axis=2, bitorder="little")
    return weights(words.shape[1]) @ bits.sum(axis=0, dtype=np.int64)


def kept(vectors: DataFrame) -> DataFrame:
    """``(vec_id, vector)`` of the rows that take part, in double precision."""
    v = F.col("embedding").cast("array<double>")
    reach = float(1 << LIMIT) / SCALE
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (x >= -reach) & (x < reach))
    return vectors.filter(v.isNotNull() & (F.size(v) == DIMS) & F.coalesce(sound, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector")
    )


def packed(vectors: DataFrame) -> DataFrame:
    """``(vec_id, planes, norm)``: the words of each vector, lowest plane first, and its dot product with itself."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), CHUNK):
                part = batch.slice(at, CHUNK)
                values = part["vector"].flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMS)
                words = to_planes(np.floor(SCALE * values).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part["vec_id"], pa.array([w.tobytes() for w in words], pa.binary()), pa.array(dots(words, words))],
                    ["vec_id", "planes", "norm"],
                )

    return kept(vectors).mapInArrow(pack, "vec_id long, planes binary, norm long")


def unpacked(planes: pa.Array) -> np.ndarray:
    """``(n, planes)`` words of a column of :func:`packed`, widened to its widest row."""
    found = [np.frombuffer(p, "<u8") for p in planes.to_pylist()]
    lengths = np.array([len(f) for f in found])
    out = np.empty((len(found), lengths.max()), dtype=np.uint64)
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        out[at] = widened(np.stack([found[i] for i in at]), out.shape[1])
    return out


def nearest(words: np.ndarray, norms: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each vector, ties to the smaller, and the squared distance."""
    far = np.empty((len(words), len(centroids)), dtype=np.int64)
    for n, centroid in enumerate(centroids):
        planes = to_planes(np.array([centroid], dtype=np.int64))[0]
        far[:, n] = norms + sum(c * c for c in centroid) - 2 * dots(words, planes)
    best = far.argmin(axis=1)
    return best, far[np.arange(len(far)), best]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, len(batch), CHUNK):
            part = batch.slice(at, CHUNK)
            yield part, unpacked(part["planes"]), part["norm"].to_numpy()


def _moved(table: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Centroids after one round."""
    names = [f"s{i}" for i in range(DIMS)]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), DIMS), np.int64)
        for _, words, norms in _chunks(batches):
            best, _ = nearest(words, norms, centroids)
            for n in np.unique(best):
                count[n] += (best == n).sum()
                total[n] += sums(words[best == n])
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(count[at]), *map(pa.array, total[at].T.copy())], ["cluster", "n", *names])

    parts = table.select("planes", "norm").mapInArrow(add_up, f"cluster int, n long, {', '.join(f'{s} long' for s in names)}")
    out = list(centroids)
    for row in parts.groupBy("cluster").agg(*[F.sum(c).alias(c) for c in ("n", *names)]).collect():
        out[row["cluster"]] = [row[s] // row["n"] for s in names]
    return out


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, salt: str = SALT) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)``, one row per vector that takes part.

    The first centroids are the ``k`` vectors with the smallest sha256 of
    ``salt:vec_id``.  A round assigns every vector to its nearest centroid
    (squared distance, ties to the smaller number) and moves every centroid that
    has vectors to the floor of their mean.  ``vectors`` needs ``vec_id`` and
    ``embedding``; other columns are ignored.

    Defined results: vectors that are null, not of 64 components, or hold null
    or non-finite components take no part, nor do those with a component of
    131,072 or more in size, whose squared distances need more than 64 bits;
    rows with a null vec_id take part and come last among the starts; rows that
    repeat count each for itself; with fewer than ``k`` vectors there are as
    many centroids; sums that leave 64 bits are null; an empty table gives no
    rows.
    """
    table = materialise(packed(vectors), "bitplanes-packed")
    start = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    first = table.orderBy(start.asc_nulls_last(), "planes").limit(k).select("planes").toArrow()["planes"].combine_chunks()
    centroids = []
    if len(first):
        centroids = [sums(words[None, :]).tolist() for words in unpacked(first)]
    for _ in range(rounds if centroids else 0):
        centroids = _moved(table, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words, norms in _chunks(batches):
            best, far = nearest(words, norms, centroids)
            yield pa.RecordBatch.from_arrays([part["vec_id"], pa.array(best.astype(np.int32)), pa.array(far)], ["vec_id", "cluster", "distance"])

    assigned = materialise(table.mapInArrow(assign, ASSIGNED), "bitplanes-assigned")
    # One row per centroid.
    found = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()
    inertia = {row["cluster"]: int(row["n"]) for row in found}
    fits = lambda n: n if n <= _LONG else None
    about = [
        (n, fits(inertia.get(n, 0)), fits(sum(inertia.values())), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for n, c in enumerate(centroids)
    ]
    sized = vectors.sparkSession.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(sized), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def cluster_sql(embeddings: str = "embeddings", k: int = K, rounds: int = ROUNDS, salt: str = SALT) -> str:
    """:func:`cluster` for DuckDB, from plain squared differences."""
    reach = float(1 << LIMIT) / SCALE
    steps = f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM {embeddings} WHERE embedding IS NOT NULL AND len(embedding) = {DIMS}
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x) OR x < -{reach} OR x >= {reach})) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{salt}:' || vec_id), r) - 1 AS c, v FROM kept QUALIFY c < {k})"""
    for n in range(rounds + 1):
        steps += f""",
a{n} AS MATERIALIZED (SELECT r, min(d) AS d, arg_min(c, (d, c)) AS c FROM (
  SELECT r, c, CAST(list_sum(list_transform(list_zip(k.v, m.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM kept k, c{n} m) GROUP BY r)"""
        if n < rounds:
            steps += f""",
c{n + 1} AS MATERIALIZED (SELECT m.c, coalesce(g.v, m.v) AS v FROM c{n} m LEFT JOIN (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
    SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a{n} JOIN kept USING (r), range(1, {DIMS + 1}) t(i) GROUP BY c, i) GROUP BY c) g USING (c))"""
    return f"""WITH {steps}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept USING (r) JOIN c{rounds} m ON m.c = a.c"""
