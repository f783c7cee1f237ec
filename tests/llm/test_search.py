"""Searches against brute force, with ties, repeats and unusable vectors."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import bench
from peerscore.llm import ann, hamming

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, vector string, ids string"


def _vectors(spark, n=600, dims=16, seed=3):
    rng = np.random.default_rng(seed)
    points = rng.standard_normal((n, dims)).astype(np.float32)
    points[n // 2 : n // 2 + 120] = points[7]  # one vector many times
    rows = [(i, [float(v) for v in p], 0, "x", "y", "z") for i, p in enumerate(points)]
    bad = [[0.0] * dims, None, [float("nan")] * dims, [float("inf")] + [1.0] * (dims - 1), [None] + [1.0] * (dims - 1), [float("nan")] * (3 * dims), None]
    rows += [(10_000 + 100 * i, v, 0, "x", "y", "z") for i, v in enumerate(bad)]
    rows += [(None, [1.0] * dims, 0, "x", "y", "z"), rows[0]]
    return spark.createDataFrame(rows, SCHEMA), points.astype(np.float64)


def test_projected_neighbours(spark):
    df, points = _vectors(spark)
    got: dict[int, list] = {}
    for r in ann.search(df, every=20, cell=60).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(range(0, len(points), 20))
    hits = 0
    for q, found in got.items():
        far = np.sqrt(((points - points[q]) ** 2).sum(1))
        want = sorted((d, i) for i, d in enumerate(far) if i != q)[:10]
        assert [k for k, _, _ in found] == list(range(1, 11))
        assert [(s, i) for _, i, s in found] == sorted((s, i) for _, i, s in found)
        assert all(s == pytest.approx(far[i], abs=1e-12) for _, i, s in found)
        hits += len({i for _, i in want} & {i for _, i, _ in found})
    assert hits >= 0.95 * 10 * len(got)


def test_neighbours_of_few_or_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 2.0]), (100, [1.0, 2.0])], "vec_id long, embedding array<double>")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in ann.search(few).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 100, 0.0), (0, 2, 1, 1.0), (100, 1, 0, 0.0), (100, 2, 1, 1.0)]
    assert ann.search(few.limit(0)).collect() == []
    assert hamming.search(few.limit(0)).collect() == []


@pytest.mark.parametrize("search", [ann.search, hamming.search])
def test_each_length_is_searched_by_itself(spark, search):
    rng = np.random.default_rng(8)
    rows = [(i, rng.standard_normal(12 if i % 3 else 20).tolist()) for i in range(90)] + [(300, [float("nan")] * 40), (400, rng.standard_normal(33).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    every = lambda part, **more: sorted(map(tuple, search(part, every=10).collect()))
    sizes = [df.filter(F.size("embedding") == n) for n in (12, 20)]
    assert every(df) == sorted(every(sizes[0]) + every(sizes[1]))
    assert {r[0] for r in every(df)} == set(range(0, 90, 10))


def test_copies_of_a_query(spark):
    """Equal queries are searched once, and each drops itself."""
    rows = [(i, [1.0, 2.0]) for i in range(0, 3000, 100)] + [(5001, [1.0, 3.0])]
    got: dict[int, list] = {}
    for r in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: [i for i in range(0, 3000, 100) if i != q][:10] for q in range(0, 3000, 100)}


def test_the_stop_saves_most_verifications():
    rng = np.random.default_rng(5)
    centres = 4 * rng.standard_normal((40, 64))
    points = centres[rng.integers(0, 40, 4000)] + rng.standard_normal((4000, 64))
    matrix, ratio = ann.projection(64), ann.stop_ratio(ann.PROJECTIONS, ann.CONFIDENCE)
    index = ann.Cell(np.arange(4000), points, matrix)
    hits = 0
    for q in range(0, 4000, 100):
        found = {i for _, i in index.nearest(points[q], points[q] @ matrix, 11, np.inf, ratio)}
        hits += len(found & set(np.argsort(((points - points[q]) ** 2).sum(1), kind="stable")[:11].tolist()))
    assert hits >= 0.9 * 11 * 40
    assert index.verified < 0.2 * 4000 * 40


def test_chi_square():
    assert ann.chi_square_cdf(np.array(2.0), 2) == pytest.approx(1 - np.exp(-1))
    assert ann.chi_square_cdf(np.array(15.507), 8) == pytest.approx(0.95, abs=1e-4)
    assert ann.stop_ratio(8, 0.95) == pytest.approx(15.507, abs=1e-2)


def test_cells_near_are_those_within_reach():
    rng = np.random.default_rng(1)
    points = rng.standard_normal((500, 4))
    tree, cells = ann.fit_tree(points, 20)
    home = ann.cells_of(tree, points)
    for q in points[:20]:
        for reach in (0.1, 1.0, 4.0):
            near = set(home[((points - q) ** 2).sum(1) <= reach].tolist())
            assert near <= set(ann.cells_near(tree, q, reach))
    assert len(ann.cells_near(tree, points[0], 0.01)) < cells


@pytest.mark.parametrize("dims", [16, 70])
def test_hamming_search_is_exact(spark, dims):
    df, points = _vectors(spark, n=300, dims=dims)
    bits = points > 0
    got: dict[int, list] = {}
    for r in hamming.search(df, every=50).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.distance, r.vec_id))
    # A zero vector has a code (no bit set); the other unusable ones have none.
    ids = [*range(len(points)), 10_000]
    codes = np.vstack([bits, np.zeros((1, dims), dtype=bool)])
    assert set(got) == {i for i in ids if i % 50 == 0}
    for q, found in got.items():
        own = codes[ids.index(q)]
        want = sorted((int((own != c).sum()), i) for i, c in zip(ids, codes) if i != q)[:10]
        assert found == want


def test_hamming_search_exchanges_no_candidates(spark):
    """Look-ups and candidates stay in their task: what is exchanged follows the input, not the pairs compared."""
    n = 3000
    points = np.random.default_rng(4).standard_normal((n, 64)).astype(np.float32)
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<float>")
    before = bench.totals(spark)[1]
    assert len(hamming.search(df).collect()) == 10 * n // 50
    assert bench.totals(spark)[1] - before < points.nbytes


def test_hamming_search_splits_large_parts(spark, monkeypatch):
    """Codes that share all first bits are dealt on by a hash."""
    rng = np.random.default_rng(6)
    points = rng.standard_normal((400, 70))
    points[100:, :40] = np.abs(points[100:, :40])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    whole = sorted(map(tuple, hamming.search(df).collect()))
    monkeypatch.setattr(hamming, "PART_WORDS", 120)
    assert sorted(map(tuple, hamming.search(df).collect())) == whole
    bits = points > 0
    for q in range(0, 400, 50):
        want = sorted((int((bits[q] != c).sum()), i) for i, c in enumerate(bits) if i != q)[:10]
        assert [(d, i) for query, _, i, d in whole if query == q] == want


@pytest.mark.parametrize(("dims", "candidates", "flat"), [(20, 2**18, 0), (20, 40, 0), (70, 2**18, 350), (70, 40, 350), (130, 100, 0)])
def test_a_part_loses_no_near_code(monkeypatch, dims, candidates, flat):
    """With bounds or none, in slices of any size, and where many codes share a value."""
    monkeypatch.setattr(hamming, "CANDIDATES", candidates)
    rng = np.random.default_rng(dims + candidates)
    bits = rng.random((500, dims)) < 0.5
    cut = hamming.segments(dims, len(bits))
    width = cut[0][1]
    bits[:flat, : width - 2] = False
    bits[:, width - 2 : width] = True
    words = -(-dims // 64)
    packed = np.zeros((len(bits), 64 * words), dtype=bool)
    packed[:, :dims] = bits
    codes, order = np.unique(np.packbits(packed, axis=1, bitorder="little").view("<u8"), axis=0, return_index=True)
    bits, want = bits[order], 7
    ids, copies = rng.permutation(len(codes)), rng.integers(1, 4, len(codes))
    part = hamming.Part(codes, ids, copies, *cut[0], 2, 0, len(cut))
    far = (bits[:20, None] != bits[None]).sum(axis=2)
    own = (bits[:20, None, :width] != bits[None, :, :width]).sum(axis=2)
    for bound in (dims, dims // 4):
        query, code, distance = part.nearest(codes[:20], np.full(20, bound), want, dims)
        found = set(zip(query.tolist(), [tuple(c) for c in part.codes[code].tolist()], distance.tolist()))
        assert len(found) == len(query)
        for q in range(20):
            rows = sorted((far[q, c], ids[c], c) for c in range(len(codes)) if far[q, c] <= bound)
            for at, (d, _, c) in enumerate(rows):
                before = sum(copies[o] for e, _, o in rows if e < d) + sum(e == d for e, _, _ in rows[:at])
                if before < want and own[q, c] <= d // len(cut):
                    assert (q, tuple(codes[c].tolist()), d) in found
