"""k-means by bit planes, token counts and lexical search against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from peerscore.llm import bitplanes, lexical, token_counts

# Bit planes


def test_planes_give_exact_dot_products():
    rng = np.random.default_rng(2)
    for reach in (1, 1024, 2**27):
        a, b = rng.integers(-reach, reach, (50, 64)), rng.integers(-3 * reach // 2, reach // 2, (50, 64)) // 2
        a[0], b[0] = -reach, -reach // 2
        x, y = bitplanes.to_planes(a), bitplanes.to_planes(b)
        assert bitplanes.dots(x, y).tolist() == (a * b).sum(1).tolist()
        assert bitplanes.dots(x, y[3]).tolist() == (a * b[3]).sum(1).tolist()
        assert bitplanes.sums(x).tolist() == a.sum(0).tolist()
        assert bitplanes.dots(bitplanes.widened(x, x.shape[1] + 2), y).tolist() == (a * b).sum(1).tolist()


def _brute(vectors, k, rounds):
    """Plain integers: ``vec_id -> (cluster, distance)`` by row, and final centroids."""
    ints = [[math.floor(1024 * x) for x in v] for _, v in vectors]
    order = sorted(range(len(vectors)), key=lambda r: hashlib.sha256(f"3:{vectors[r][0]}".encode()).hexdigest())
    centroids = [ints[r] for r in order[:k]]

    def assign():
        out = []
        for v in ints:
            far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            own = [v for v, (n, _) in zip(ints, found) if n == c]
            if own:
                centroids[c] = [sum(col) // len(own) for col in zip(*own)]
    return assign(), centroids


VECTORS = "vec_id long, embedding array<double>, cluster string, planes string, distance string"


def test_clusters_equal_plain_integers(spark):
    rng = np.random.default_rng(4)
    points = rng.standard_normal((300, 64)) * rng.choice([0.01, 1, 5000], 300)[:, None]
    points[100:160] = points[5]
    vectors = [(i, p.tolist()) for i, p in enumerate(points)]
    rows = [(i, v, "x", "y", "z") for i, v in vectors]
    bad = [None, [], [1.0] * 63, [1.0] * 65, [float("nan")] * 64, [float("inf")] * 64, [None] * 64, [1e300] * 64]
    rows += [(1000 + i, v, "x", "y", "z") for i, v in enumerate(bad)]
    got = bitplanes.cluster(spark.createDataFrame(rows, VECTORS)).orderBy("vec_id").collect()
    want, centroids = _brute(vectors, 8, 10)
    assert [(r.vec_id, r.cluster, r.distance) for r in got] == [(i, *w) for (i, _), w in zip(vectors, want)]
    for r in got:
        assert r.inertia == sum(d for _, d in want)
        assert r.cluster_inertia == sum(d for c, d in want if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()


def test_few_equal_and_no_vectors(spark):
    one = [0.5] * 64
    few = spark.createDataFrame([(1, one, "", "", ""), (1, one, "", "", ""), (None, [2.0] * 64, "", "", "")], VECTORS)
    got = bitplanes.cluster(few).orderBy(F.col("vec_id").asc_nulls_last()).collect()
    assert [(r.vec_id, r.cluster, r.distance) for r in got] == [(1, 0, 0), (1, 0, 0), (None, 2, 0)]
    assert bitplanes.cluster(few.limit(0)).collect() == []
    far = spark.createDataFrame([(i, [v] * 64, "", "", "") for i, v in enumerate((-131072.0, 131071.0, 0.0) * 6)], VECTORS)
    assert bitplanes.cluster(far, k=1, rounds=0).first().inertia is None


# Token counts

DOCS = "doc_id long, text string, n_bytes string, pre_token string"


def _texts():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghé中😀①019.,;'<>\t\r\x00▁ ") for _ in range(rng.randint(1, 9)))
    texts = ["".join(word() + rng.choice([" ", " ", " ", "  ", "\n", " \n", "\n\n  ", "     "]) for _ in range(rng.randint(0, 80))) for _ in range(300)]
    return [*texts, None, "", " ", "\n", "  ", " \n ", "▁", "<s> </s> <unk> <0x0A>", "x" * 50_000, "word " * 20_000, " a", "a ", "\na", "a\n", *texts[:3]]


@pytest.mark.parametrize("frequent", [0, 5, 65_536])
def test_counts_equal_whole_texts(spark, frequent):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.tokenizer_path())
    rows = [(i, t, "x", "y") for i, t in enumerate(_texts())]
    got = token_counts.count_tokens(spark.createDataFrame(rows, DOCS).repartition(3), frequent=frequent).orderBy("doc_id").collect()
    want = [(i, len((t or "").encode()), len(model.encode(t or ""))) for i, t, *_ in rows]
    assert [tuple(r) for r in got] == [(*w, w[2] > 4096) for w in want]
    assert any(r.over_limit for r in got)


def test_pre_tokens_join_to_the_text(spark):
    lengths = token_counts.Lengths(token_counts.tokenizer_path())
    for text in filter(None, _texts()):
        cut = lengths.pre_tokens(text)
        assert sum(lengths.of(cut)) == lengths.whole(text)
        assert "".join(t if t[:1] == "\n" else " " + t for t in cut) == " " + text.replace("▁", " ")
    empty = spark.createDataFrame([], DOCS)
    assert token_counts.count_tokens(empty).collect() == []


# Lexical search


def _ranked(docs, items, k):
    """Every score, from the definition."""
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = [(d, cut(t)) for d, t in docs]
    held = [(d, t) for d, t in held if t]
    n_docs, n_terms = len(held), sum(len(t) for _, t in held)
    asked: dict = {}
    for i, t in items:
        asked.setdefault(i, set()).update(cut(t))
    out = []
    for i, terms in asked.items():
        scores = [0] * len(held)
        for term in terms:
            df = sum(term in t for _, t in held)
            if not df:
                continue
            w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
            for at, (_, t) in enumerate(held):
                m = 10 + 90 * len(t) * n_docs // n_terms
                scores[at] += w * (10**9 * t.count(term) // (1000 * t.count(term) + 8 * m))
        best = sorted((-s, d is None, d or 0, d) for s, (d, _) in zip(scores, held) if s > 0)[:k]
        out += [(i, n + 1, d, -s) for n, (s, _, _, d) in enumerate(best)]
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


ITEMS = "item_id long, text string, term string, score string"


@pytest.mark.parametrize("block_bytes", [100, 1 << 24])
def test_search_is_exact(spark, block_bytes):
    rng = random.Random(6)
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("", "É", "中", "9", "xy")]
    weights = [1 / (n + 1) for n in range(len(words))]
    text = lambda n: "".join(w + rng.choice([" ", "-", "_", "\n", "\x7f"]) for w in rng.choices(words, weights, k=n))
    docs = [(i, text(rng.choice([1, 5, 30, 200]))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(60)] + [(None, docs[8][1]), docs[9], docs[9], (2000, None), (2001, ""), (2002, " .,\x00")]
    items = [(i, text(rng.choice([1, 3, 12]))) for i in range(12)] + [(20, None), (21, ""), (22, "nowhere"), (23, "A B"), (23, "C"), (24, docs[7][1]), (24, docs[7][1]), (None, "a b c")]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, n string, terms int").repartition(4)
    asked = spark.createDataFrame([(i, t, "x", "y") for i, t in items], ITEMS)
    got = [tuple(r) for r in lexical.search(df, asked, k=5, block_bytes=block_bytes).collect()]
    assert sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[1])) == _ranked(docs, items, 5)
    assert lexical.search(df.limit(0), asked).collect() == []
    assert lexical.search(df, asked.limit(0)).collect() == []


def test_accumulators_stop():
    """One long rare term outweighs all common ones: documents without it get no accumulator."""
    docs = list(range(100))
    ends = np.array([2 * min(n, 10) + max(n - 10, 0) for n in range(101)])
    terms = np.array([0, 1] * 10 + [1] * 90)
    block = lexical.Block(docs, [2] * 10 + [1] * 90, ends, terms, np.ones(len(terms), dtype=np.int64), 100, 110)
    best = block.best([(0, 3000), (1, 1)], 5, 0)
    assert int(block.held.sum()) == 10
    assert sorted(at for _, at in best) == list(range(10))
