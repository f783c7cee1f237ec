"""Ranked lexical search, term at a time with a limited number of accumulators.

Documents are tokenised where they lie; only occurrences of the items' terms
are kept, document by document, beside each document's length.  Counts over all
documents then give the weights.  A task takes its own documents block by block
and each item's terms rarest first.  A document that holds a term gets an
accumulator, until all that the remaining terms can still add (the greatest
score of each in the block) is less than the k-th best partial score: from then
on only documents with an accumulator are updated, exactly, to the last term.
The k-th best of earlier blocks of the task counts from the start.  Tasks hand
on their best k for each item, and the best k of these remain.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import discard, materialise, running_total

K = 10
#: Bytes of items' terms (16 more for each) that are searched at once; a broadcast holds them and one item more.
BLOCK_BYTES = 16 << 20
#: What a document's length counts for, of 100, and the scales of the score.
LENGTH_SHARE = 90
UNIT, SATURATION = 1_000_000_000, 8

# A term is a run of ASCII letters, digits and characters beyond ASCII; A-Z are lowered.
_TERM_BYTES = [chr(b).lower().encode() if chr(b).isalnum() else b" " for b in range(128)]
_TO_TERMS = b"".join([*_TERM_BYTES, *[bytes([b]) for b in range(128, 256)]])


def terms_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TO_TERMS).split() if text else []


def item_terms(items: DataFrame) -> DataFrame:
    """``(item_id, term)`` without repeats."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(i, t) for i, text in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist()) for t in sorted(set(terms_of(text)))]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in pairs], pa.int64()), pa.array([t for _, t in pairs], pa.binary())], ["item_id", "term"])

    return items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, "item_id long, term binary").distinct()


def occurrences(docs: DataFrame, vocabulary) -> DataFrame:
    """``(doc_id, n, terms, counts)`` of every document with a term.

    ``vocabulary`` is a broadcast list of terms; ``terms`` are places in it, and
    ``n`` counts all terms of the document, those of the list or not.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = {t: i for i, t in enumerate(vocabulary.value)}
        for batch in batches:
            docs, sizes, ends, terms, counts = [], [], [0], [], []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                words = terms_of(text)
                if not words:
                    continue
                found = Counter(map(places.get, words))
                found.pop(None, None)
                docs.append(doc)
                sizes.append(len(words))
                terms.extend(found.keys())
                counts.extend(found.values())
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, kind)) for v, kind in ((terms, pa.int32()), (counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "counts"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(scan, "doc_id long, n long, terms array<int>, counts array<long>")


def document_counts(held: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term of the vocabulary; a task adds up its own."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(size, np.int64)
        for batch in batches:
            found += np.bincount(batch["terms"].flatten().to_numpy(zero_copy_only=False), minlength=size)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(found[at])], ["term", "n"])

    out = np.zeros(size, np.int64)
    for row in held.select("terms").mapInArrow(add_up, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row["term"]] = row["n"]
    return out


class Block:
    """Documents of one batch, by term."""

    def __init__(self, docs: np.ndarray, sizes: list[int], ends: np.ndarray, terms: np.ndarray, counts: np.ndarray, n_docs: int, n_terms: int) -> None:
        self.docs = docs
        length = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * n * n_docs // n_terms for n in sizes], dtype=np.int64)
        holder = np.repeat(np.arange(len(docs)), np.diff(ends))
        order = np.argsort(terms, kind="stable")
        self.holder = holder[order]
        counts = counts[order]
        self.parts = UNIT * counts // (1000 * counts + SATURATION * length[self.holder])
        found, starts = np.unique(terms[order], return_index=True)
        self.slices = dict(zip(found.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(order)])))
        self.most = dict(zip(found.tolist(), np.maximum.reduceat(self.parts, starts).tolist())) if len(found) else {}
        self.scores = np.zeros(len(docs), dtype=np.int64)
        self.held = np.zeros(len(docs), dtype=bool)

    def best(self, terms: list[tuple[int, int]], k: int, known: int) -> list[tuple[int, int]]:
        """``(score, place)`` of the documents that can be among the best ``k``; ``known`` is a k-th score reached already.

        ``terms`` are ``(term, weight)``, rarest first.
        """
        here = [(t, w) for t, w in terms if t in self.slices]
        bounds = [w * self.most[t] for t, w in here]
        left, used, creating = sum(bounds), 0, True
        self.scores[:] = 0
        self.held[:] = False
        for (term, weight), bound in zip(here, bounds):
            if creating:
                kth = known
                if used > max(left, known):  # otherwise no partial score can be above
                    partial = self.scores[self.held]
                    if len(partial) >= k:
                        kth = max(kth, int(np.partition(partial, len(partial) - k)[len(partial) - k]))
                creating = left >= kth
            start, end = self.slices[term]
            holder, gain = self.holder[start:end], weight * self.parts[start:end]
            if creating:
                self.held[holder] = True
            else:
                has = self.held[holder]
                holder, gain = holder[has], gain[has]
            self.scores[holder] += gain
            left, used = left - bound, used + bound
        at = np.flatnonzero(self.scores >= max(known, 1))
        if len(at) > k:
            found = self.scores[at]
            at = at[found >= np.partition(found, len(at) - k)[len(at) - k]]
        return list(zip(self.scores[at].tolist(), at.tolist()))


def _order(row: tuple[int, int | None]) -> tuple[int, bool, int]:
    """Higher scores first, then smaller ids, null last."""
    return -row[0], row[1] is None, row[1] or 0


def _block_search(docs: DataFrame, pairs: list, k: int) -> DataFrame:
    """The best ``k`` documents of each item of one block: ``(item_id, doc_id, score)``, ``k`` rows a task at most."""
    context = docs.sparkSession.sparkContext
    vocabulary = sorted({bytes(t) for _, t in pairs})
    held = materialise(occurrences(docs, context.broadcast(vocabulary)), "lexical-occurrences")
    total = held.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
    n_docs, n_terms = total["n"], total["l"] or 0
    seen = document_counts(held, len(vocabulary)).tolist()
    place = {t: i for i, t in enumerate(vocabulary)}
    by_item: dict[int | None, list[tuple[int, int]]] = {}
    for item, term in pairs:
        at = place[bytes(term)]
        if seen[at]:
            by_item.setdefault(item, []).append((at, math.floor(1000 * math.log((2 * n_docs + 2) / (2 * seen[at] + 1)))))
    for terms in by_item.values():
        terms.sort(key=lambda t: (seen[t[0]], t[0]))
    asked = context.broadcast(list(by_item.items()))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int | None]]] = [[] for _ in asked.value]
        for batch in batches:
            terms, counts = batch["terms"], batch["counts"]
            ends = terms.offsets.to_numpy()
            block = Block(batch["doc_id"], batch["n"].to_pylist(), ends, terms.flatten().to_numpy(zero_copy_only=False), counts.flatten().to_numpy(zero_copy_only=False), n_docs, n_terms)
            for n, (_, of_item) in enumerate(asked.value):
                known = best[n][-1][0] if len(best[n]) == k else 0
                found = block.best(of_item, k, known)
                if found:
                    best[n] = sorted([*best[n], *((s, batch["doc_id"][at].as_py()) for s, at in found)], key=_order)[:k]
        rows = [(item, doc, score) for (item, _), found in zip(asked.value, best) for score, doc in found]
        columns = list(zip(*rows)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item_id", "doc_id", "score"])

    found = materialise(held.mapInArrow(search, "item_id long, doc_id long, score long").withColumn("task", F.spark_partition_id()), "lexical-best")
    discard(held)
    return found


def search(docs: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents with a score above 0 for each item.

    ``docs`` needs ``doc_id`` and ``text``, ``items`` needs ``item_id`` and
    ``text``; other columns are ignored.  Scores are exact; equal ones go to the
    smaller doc_id, a null doc_id comes last.  Defined results: null texts have
    no term; items without terms, or whose terms no document holds, give no
    row; rows that repeat an item_id are one item with the terms of all; rows
    that repeat a document are ranked each for itself; an empty table on either
    side gives no rows.
    """
    pairs = materialise(item_terms(items), "lexical-items")
    sizes = pairs.groupBy("item_id").agg(F.sum(F.octet_length("term") + 16).alias("bytes"))
    placed = running_total(sizes, [F.col("item_id").asc_nulls_last()], "bytes", "before", "lexical-blocks")
    placed = materialise(placed.select(F.col("item_id").alias("_item"), F.floor(F.col("before") / block_bytes).alias("block")), "lexical-placed")
    dealt = materialise(pairs.join(placed, F.col("item_id").eqNullSafe(F.col("_item"))).drop("_item"), "lexical-dealt")
    found = []
    for (block,) in placed.select("block").distinct().orderBy("block").toLocalIterator():
        rows = dealt.filter(F.col("block") == block).select("item_id", "term").collect()
        found.append(_block_search(docs, [(r["item_id"], r["term"]) for r in rows], k))
    schema = "item_id long, doc_id long, score long, task int"
    every = reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], schema)
    # Two steps, so that no group grows with the number of tasks alone.
    tasks = every.agg(F.max("task")).first()[0] or 0
    best_first = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    some = Window.partitionBy("item_id", F.pmod("task", F.lit(math.isqrt(tasks) + 1))).orderBy(*best_first)
    some_best = every.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= k).drop("rank")
    whole = Window.partitionBy("item_id").orderBy(*best_first)
    return some_best.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def search_sql(documents: str = "documents", items: str = "benchmark", k: int = K) -> str:
    """:func:`search` for DuckDB: every score of every item."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    cut = f"regexp_extract_all(translate(text, '{upper}', '{lower}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {cut} AS t FROM {documents} WHERE text IS NOT NULL),
sized AS (SELECT r, doc_id, t, CAST(len(t) AS BIGINT) AS n FROM docs WHERE len(t) > 0),
whole AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sized),
asked AS (SELECT DISTINCT item_id, unnest({cut}) AS term FROM {items}),
postings AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM sized) WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM postings, whole GROUP BY term, n_docs),
scored AS (SELECT item_id, r, doc_id, CAST(sum(w * (({UNIT} * tf) // (1000 * tf + {SATURATION} * ({100 - LENGTH_SHARE} + ({LENGTH_SHARE} * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN sized USING (r), whole GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= {k}"""
