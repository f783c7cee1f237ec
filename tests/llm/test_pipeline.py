"""The pipeline stage by stage against brute force, and its registration."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from peerscore.llm import mixing, packing
from test_texts import DOCS, _fingerprint, _removed, _roots, prose

TOXIC = ["idiot", "moron", "trash", "scum", "pathetic", "worthless"]


def _corpus():
    rng = random.Random(11)
    shared = prose(rng, 25)
    rows, toxic = [], set()
    for i in range(260):
        words = prose(rng, rng.randint(5, 120)).split()
        if i % 6 == 0:
            toxic.add(i)
            words[2:2] = rng.sample(TOXIC, 4)
        elif i % 9 == 1:
            words += shared.split()
        rows.append((i, " ".join(words), "en", f"s{i % 5}" if i % 50 else None, 0))
    copies = [(1000 + k, rows[7][1], "en", "s1", 0) for k in range(40)] + [(2000, rows[8][1] + " end", "de", "s2", 0)]
    odd = [(3000, None, None, None, None), (3001, "", "en", "s0", 0), (3002, "ünï " * 3, "en", "s0", 0)]
    return rows + copies + odd, toxic


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    rows, toxic = _corpus()
    spark.createDataFrame(rows, DOCS).write.parquet(f"{root}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i, *_ in rows if i < 260 and i % 3 != 2]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    held = [spark.read.parquet(f"{root}/documents.parquet")]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, held[-1], str(root)).write.parquet(f"{root}/out{n}")
        held.append(spark.read.parquet(f"{root}/out{n}"))
    return str(root), toxic, held


def _rows(df):
    return [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect()]


def test_all_but_the_last_return_documents(stages):
    _, _, held = stages
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for df in held[1:-1]:
        assert df.columns == held[0].columns and df.dtypes == held[0].dtypes


def test_toxic_documents_go_and_clean_ones_stay(stages):
    _, toxic, held = stages
    left = {r[0] for r in _rows(held[1])}
    assert {r[0] for r in _rows(held[0])} - left == toxic


def test_one_of_each_group_stays(stages):
    _, _, held = stages
    before = _rows(held[1])
    fps = {r[0]: _fingerprint(r[1]) for r in before}
    nodes = set(fps.values())
    roots = _roots([(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 2], nodes)
    least: dict[int, int] = {}
    for i, fp in fps.items():
        least[roots[fp]] = min(i, least.get(roots[fp], i))
    assert Counter(r[0] for r in _rows(held[2])) == Counter(least.values())
    assert len(least) < len(before) - 30


def test_repeats_are_cut(stages):
    _, _, held = stages
    before, after = _rows(held[2]), {r[0]: r for r in _rows(held[3])}
    assert set(after) == {r[0] for r in before}
    cut = 0
    for i, n, removed, *_ in _removed(before):
        text = after[i][1]
        assert len((text or "").encode()) == n - removed or removed
        assert text is None or after[i][4] == len(text)
        cut += removed
    assert cut > 500 and after[3000][1] is None


def test_sources_come_near_their_targets(stages):
    _, _, held = stages
    size = lambda t: len((t or "").split())
    before, after = _rows(held[3]), _rows(held[4])
    taken = Counter(r[0] for r in after)
    assert set(taken) <= {r[0] for r in before} and max(taken.values()) <= 2
    of: dict = {}
    for _, t, _, s, _ in before:
        of[s] = of.get(s, 0) + size(t)
    got = Counter()
    for _, t, _, s, _ in after:
        got[s] += size(t)
    total, names = 1.5 * sum(of.values()), sorted(of, key=lambda s: (s is None, s))
    weight = {s: mixing.WEIGHTS[n % 3] for n, s in enumerate(names)}
    capped: set = set()
    while True:
        level = (total - sum(2 * of[s] for s in capped)) / sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and weight[s] * level > 2 * of[s]}
        if not over:
            break
        capped |= over
    for s in names:
        assert abs(got[s] - (2 * of[s] if s in capped else weight[s] * level)) <= 10


def test_pieces_hold_the_taken_documents(stages):
    from tokenizers import Tokenizer

    _, _, held = stages
    model = Tokenizer.from_file(packing.tokenizer_path())
    want = Counter()
    for i, t, *_ in _rows(held[4]):
        ids = np.array([*model.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    out = held[5].collect()
    assert Counter((r.doc_id, r.length, r.ids_crc32) for r in out) == want  # all are short
    assert len({r.sequence_id for r in out}) <= 1 + 1.03 * sum(n * k for (_, n, _), k in want.items()) / packing.SEQUENCE


def test_run_is_the_stages_in_order(spark, stages):
    root, _, held = stages
    got = corpus_pipeline.run(spark, root)
    key = ["doc_id", "piece", "length", "ids_crc32"]
    assert Counter(got.select(*key).collect()) == Counter(held[-1].select(*key).collect())


def test_stages_on_an_empty_table(spark, stages):
    root, _, held = stages
    empty = held[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, root).collect() == []


def test_mixing_is_the_same_each_time(spark, stages):
    _, _, held = stages
    first, again = (sorted(map(tuple, mixing.mix(df).collect()), key=str) for df in (held[0], held[0].repartition(7)))
    assert first == again
    assert all(r[4] <= 2 * r[1] for r in first)
