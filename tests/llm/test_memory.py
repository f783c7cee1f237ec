"""What tasks leave with their Python worker."""

from __future__ import annotations

import os
import pickle
import subprocess
import sys

import pyarrow as pa
from pyspark import cloudpickle

import corpus_pipeline
from peerscore.llm import common, simhash, suffix, toxicity
from test_texts import DOCS

LEFT = """
from peerscore.llm.common import gives_back

def resident():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096 >> 20

pins = []

def run(batches):
    blocks = [bytearray(60_000) for _ in range(3_000)]
    pins.append(bytearray(60_000))  # above the others, so that they do not end the heap
    yield len(blocks)

before = resident()
list(gives_back(run)(iter(())))
print(resident() - before)
"""


def test_a_task_leaves_no_freed_memory():
    root = os.path.dirname(corpus_pipeline.__file__)
    done = subprocess.run([sys.executable, "-c", LEFT], capture_output=True, text=True, env=os.environ | {"PYTHONPATH": root}, check=True, timeout=120)
    assert int(done.stdout) < 60  # of about 180


def _sent(spark, frame, monkeypatch):
    """The functions that ``frame`` hands to ``mapInArrow``, as a worker gets them."""
    found = []

    def noted(self, run, *rest):
        found.append(pickle.loads(cloudpickle.dumps(run)))
        return plain(self, run, *rest)

    kind = type(spark.range(1))
    plain = kind.mapInArrow
    with monkeypatch.context() as m:
        m.setattr(kind, "mapInArrow", noted)
        frame()
    return found


def test_tasks_of_other_operators_drop_the_caches_as_they_begin(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c", "en", "s", 5)], DOCS)
    chain = toxicity.Chain(toxicity.Features([]))
    frames = [lambda: simhash.fingerprints(docs), lambda: suffix.repeated_anchors(spark.createDataFrame([], suffix.CHUNKS), 1, 2), lambda: toxicity.without_toxic(docs, chain)]
    for frame in frames:
        (run,) = _sent(spark, frame, monkeypatch)
        cache = common.worker_cache()
        cache["word"] = b"ids"
        try:
            assert list(run(iter(()))) == [] and not cache
        finally:
            common._WORKER_CACHES.remove(cache)


def test_a_kept_cache_stays():
    cache = common.worker_cache()
    cache["word"] = b"ids"
    try:
        assert list(pickle.loads(cloudpickle.dumps(common.gives_back(iter, keeps=True)))(iter(()))) == [] and cache
    finally:
        cache.clear()
        common._WORKER_CACHES.remove(cache)


def test_stages_pass_small_batches_unless_the_session_says_otherwise(spark, tmp_path):
    def sizes(df):
        def run(batches):
            for b in batches:
                yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int32())})

        return [r.n for r in df.mapInArrow(run, "n int").collect()]

    (_, stage), name = corpus_pipeline.STAGES[3], corpus_pipeline._BATCH
    docs = spark.range(0, 5000, numPartitions=1).selectExpr("id AS doc_id", "'a b' AS text", "'en' AS lang", "'s' AS source", "3L AS n_chars")
    before = spark.conf.getAll.get(name)
    try:
        spark.conf.unset(name)
        stage(spark, docs, str(tmp_path))
        assert max(sizes(docs)) == corpus_pipeline.BATCH_ROWS
        spark.conf.set(name, 2000)
        stage(spark, docs, str(tmp_path))
        assert max(sizes(docs)) == 2000
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)
