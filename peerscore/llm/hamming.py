"""Exact top-k search of binary codes by multi-index hashing in two passes.

A code is cut into segments of about log2(number of codes) bits, so that a
segment value holds few codes however many there are, and every distinct code
is indexed under each of its segments.  Postings are dealt by the segment and
the first bits of its value into parts of bounded size; a task sorts a part by
the rest of the value and looks queries up there with a number of flipped bits
that grows by one, so neither look-ups nor candidates leave the task, only the
best of them.

The first pass asks each query's own parts, which gives a distance that its
k-th neighbour cannot exceed.  By the pigeonhole principle a code within ``b``
bits of the query (m segments, numbered from 0) agrees with it within
``(b - s) // m`` bits (rounded down) in some segment ``s``, so the second pass
asks all parts within that reach and misses none; the bound falls further as a
task finds nearer codes.  No cap is set on candidates; where more values are in
reach than a part has codes, the part is compared as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import gives_back, materialise

K = 10
EVERY = 50
#: Bits of a segment, at most, and those of the number of codes that count at least.
SEGMENT_BITS = (8, 30)
#: Words of the codes in a part, at most; larger ones are split by a hash of the code.
PART_WORDS = 2**19
#: Codes of a part that are worth a further bit, as long as few parts are there to share the work.
SMALL_PART, SHARING_BITS = 2000, 3
#: Bits below the part's that the first pass flips.
FIRST_FLIPS = 2
#: Queries that a task looks up together, and candidates it compares at once.
BLOCK, CANDIDATES = 4096, 2**18
_WORD = 64


def codes(vectors: DataFrame, dims: int) -> DataFrame:
    """``(vec_id, w0, w1, ...)``: one bit per component, set where it is above zero, in words of 64.

    Vectors of another length than ``dims`` are left out.
    """
    v = F.col("embedding")
    words = []
    for start in range(0, dims, _WORD):
        bits = [
            F.when(F.get(v, F.lit(i)) > 0, F.lit(1 << (i - start) if i - start < 63 else -(1 << 63))).otherwise(F.lit(0)).cast("long")
            for i in range(start, min(start + _WORD, dims))
        ]
        words.append(reduce(lambda a, b: a.bitwiseOR(b), bits).alias(f"w{start // _WORD}"))
    return vectors.filter(F.size(v) == dims).select("vec_id", *words)


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, embedding)`` without null and empty vectors, and those with null or non-finite components."""
    v = F.col("embedding")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & fine).select(F.col("vec_id").cast("long").alias("vec_id"), v)


def _segment(words: list[str], start: int, bits: int) -> Column:
    """``bits`` bits of a code from ``start`` on; they can lie in two words."""
    word, at = divmod(start, _WORD)
    out = F.shiftrightunsigned(words[word], at)
    if at + bits > _WORD and word + 1 < len(words):
        out = out.bitwiseOR(F.shiftleft(words[word + 1], _WORD - at))
    return out.bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def segments(dims: int, codes: int) -> list[tuple[int, int]]:
    """``(start, bits)`` of each segment, of almost equal widths, for so many distinct codes."""
    known = max(codes.bit_length(), SEGMENT_BITS[0])
    m = ceil(dims / min(known + 2, SEGMENT_BITS[1]))
    edges = [dims * n // m for n in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


class Part:
    """Distinct codes (rows of words) that share a segment's first bits, found by the rest of it.

    ``copies`` rows share a code, the smallest of their ids is its ``ids``.
    """

    def __init__(self, codes: np.ndarray, ids: np.ndarray, copies: np.ndarray, start: int, bits: int, prefix: int, number: int, of: int):
        self.start, self.bits, self.low, self.number, self.of = start, bits, bits - prefix, number, of
        value = self.value(codes)
        self.prefix = int(value[0]) >> self.low
        rest = value & ((1 << self.low) - 1)
        order = np.argsort(rest, kind="stable")
        self.codes, self.ids, self.copies = codes[order], ids[order], copies[order]
        self.first = np.zeros((1 << self.low) + 1, dtype=np.int64)
        np.cumsum(np.bincount(rest, minlength=1 << self.low), out=self.first[1:])

    def value(self, codes: np.ndarray) -> np.ndarray:
        word, at = divmod(self.start, _WORD)
        out = codes[:, word] >> np.uint64(at)
        if at + self.bits > _WORD and word + 1 < codes.shape[1]:
            out = out | codes[:, word + 1] << np.uint64(_WORD - at)
        return (out & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def nearest(self, queries: np.ndarray, bounds: np.ndarray, want: int, dims: int, flips: int | None = None) -> tuple[np.ndarray, ...]:
        """``(query, code, distance)``, as row numbers: for each query all codes here that can be among its ``want`` nearest.

        Those within its bound and this segment's reach are seen; with ``flips`` only those with so many flipped bits
        below the prefix.  Codes that ``want`` rows come before are left out.
        """
        value = self.value(queries)
        rest = value & ((1 << self.low) - 1)
        apart = np.bitwise_count((value >> self.low) ^ self.prefix).astype(np.int64)
        search = _Found(self, queries, bounds, want, dims)
        for n in range(self.low + 1 if flips is None else min(flips, self.low) + 1):
            open_ = np.flatnonzero((search.bounds - self.number) // self.of - apart >= n)
            if not len(open_):
                break
            if comb(self.low, n) * (1 + len(self.codes) / (1 << self.low)) > len(self.codes):
                search.compare_all(open_)
                break
            masks = np.array([sum(1 << b for b in c) for c in combinations(range(self.low), n)], dtype=np.int64)
            step = max(1, CANDIDATES // len(masks))
            for at in range(0, len(open_), step):
                asked = open_[at : at + step]
                search.look_up(np.repeat(asked, len(masks)), (rest[asked][:, None] ^ masks).ravel())
        return search.result()


class _Found:
    """What a block of queries has found in a part."""

    def __init__(self, part: Part, queries: np.ndarray, bounds: np.ndarray, want: int, dims: int):
        self.part, self.queries, self.want, self.dims = part, queries, want, dims
        self.bounds = bounds.astype(np.int64)
        # Rows found at each distance.
        self.seen = np.zeros((len(queries), dims + 1), dtype=np.int64)
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def look_up(self, query: np.ndarray, rest: np.ndarray) -> None:
        """Compares each query with the codes under the value beside it."""
        first = self.part.first[rest]
        count = self.part.first[rest + 1] - first
        some = np.flatnonzero(count)
        query, first, count = query[some], first[some], count[some]
        ends = np.cumsum(count)
        at = 0
        while at < len(count):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at] - count[at]) + CANDIDATES, "right")))
            n = count[at:stop]
            skip = np.repeat(first[at:stop] - (ends[at:stop] - n) + (ends[at] - n[0]), n)
            self.compare(np.repeat(query[at:stop], n), skip + np.arange(len(skip)))
            at = stop

    def compare_all(self, query: np.ndarray) -> None:
        """Compares each query with all codes of the part, which replaces what it has found."""
        again = np.zeros(len(self.queries), dtype=bool)
        again[query] = True
        self.held = [tuple(c[~again[h[0]]] for c in h) for h in self.held]
        self.size = sum(len(h[0]) for h in self.held)
        self.seen[query] = 0
        rows = np.arange(len(self.part.codes))
        step = max(1, CANDIDATES // len(rows))
        for at in range(0, len(query), step):
            asked = query[at : at + step]
            self.compare(np.repeat(asked, len(rows)), np.tile(rows, len(asked)))

    def compare(self, query: np.ndarray, code: np.ndarray) -> None:
        if not len(query):
            return
        far = np.bitwise_count(self.part.codes[code] ^ self.queries[query]).sum(axis=1, dtype=np.int64)
        near = np.flatnonzero(far <= self.bounds[query])
        query, code, far = query[near], code[near], far[near]
        asked, at = np.unique(query, return_inverse=True)
        if not len(asked):
            return
        rows = np.bincount(at * (self.dims + 1) + far, self.part.copies[code], len(asked) * (self.dims + 1))
        self.seen[asked] += rows.reshape(len(asked), -1).astype(np.int64)
        enough = self.seen[asked].cumsum(axis=1) >= self.want
        self.bounds[asked] = np.minimum(self.bounds[asked], np.where(enough.any(axis=1), enough.argmax(axis=1), self.dims))
        near = np.flatnonzero(far <= self.bounds[query])
        self.held.append((query[near], code[near], far[near]))
        self.size += len(near)
        if self.size > 4 * CANDIDATES + self.want * len(self.queries):
            self.held = [self.result()]
            self.size = len(self.held[0][0])

    def result(self) -> tuple[np.ndarray, ...]:
        query, code, far = (np.concatenate(c) if c else np.empty(0, dtype=np.int64) for c in (list(zip(*self.held)) or [(), (), ()]))
        near = np.flatnonzero(far <= self.bounds[query])
        order = near[np.lexsort((self.part.ids[code[near]], far[near], query[near]))]
        query, code, far = query[order], code[order], far[order]
        # Rows at smaller distances come before, and one row at least of each code at this one with a smaller id.
        at = np.arange(len(query))
        begins = np.r_[True, (query[1:] != query[:-1]) | (far[1:] != far[:-1])][: len(query)]
        place = at - np.maximum.accumulate(np.where(begins, at, 0))
        before = self.seen.cumsum(axis=1)[query, far] - self.seen[query, far]
        keep = before + place < self.want
        return query[keep], code[keep], far[keep]


def search(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """``(query_id, rank, vec_id, distance)``: for each row whose vec_id is divisible by ``every`` its ``k`` nearest others.

    Nearness is the Hamming distance of sign codes, ties go to the smaller
    vec_id.  ``vectors`` needs ``vec_id`` and ``embedding``; other columns are
    ignored.  Defined results: vectors that are null, empty or hold null or
    non-finite components, and rows with a null vec_id, take no part, whatever
    their length; vectors of different lengths are never neighbours, so each
    length is searched by itself; rows that repeat a vec_id count as one for
    each distinct code; with fewer candidates than ``k`` a query gets all of
    them; an empty table gives no rows.
    """
    rows = usable(vectors)
    lengths = [row[0] for row in rows.select(F.size("embedding")).distinct().toLocalIterator()]
    found = [_search_length(rows, dims, k, every) for dims in sorted(lengths)]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, distance int")
    return reduce(DataFrame.unionByName, found)


def _search_length(vectors: DataFrame, dims: int, k: int, every: int) -> DataFrame:
    """:func:`search` among usable vectors of one length."""
    words = [f"w{i}" for i in range(-(-dims // _WORD))]
    rows = materialise(codes(vectors, dims).distinct(), "hamming-codes")
    # Of equal codes only the k + 1 smallest ids can be among anyone's k nearest.
    per_code = Window.partitionBy(*words).orderBy("vec_id")
    shared = (
        rows.withColumn("_n", F.row_number().over(per_code)).filter(F.col("_n") <= k + 1)
        .groupBy(*words).agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    index = materialise(shared, "hamming-index")
    asked = [F.col(w).alias(f"q{i}") for i, w in enumerate(words)]
    names = [f"q{i}" for i in range(len(words))]
    queries = rows.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), *asked)
    queries = materialise(queries, "hamming-queries")
    total, distinct = rows.count(), index.count()
    # A query is asked for k + 1 rows, as it drops itself afterwards.
    want = min(k + 1, total)
    cut = segments(dims, distinct)
    prefix = max((distinct * len(words) // PART_WORDS).bit_length(), min(SHARING_BITS, (distinct // SMALL_PART).bit_length()))
    prefix = min(prefix, *[bits for _, bits in cut], SEGMENT_BITS[1])

    def parts_of(columns: list[str]) -> list[Column]:
        return [F.struct(F.lit(n).alias("segment"), F.shiftright(_segment(columns, *at), at[1] - prefix).alias("prefix")) for n, at in enumerate(cut)]

    posting = index.select(*words, F.get("ids", F.lit(0)).alias("id"), F.size("ids").alias("copies"), F.inline(F.array(*parts_of(words))))
    shards = F.ceil(F.count("*") * len(words) / PART_WORDS).cast("int").alias("shards")
    # One row per part, which are few.
    parts = F.broadcast(materialise(posting.groupBy("segment", "prefix").agg(shards), "hamming-parts"))
    home = F.pmod(F.xxhash64(*words), F.col("shards")).cast("int")
    # Postings have a negative mark and come before a part's queries, which have their bound.
    posting = posting.join(parts, ["segment", "prefix"]).select(
        "segment", "prefix", home.alias("shard"), (-F.col("copies")).alias("mark"), "id", *words
    )

    def ask(bounds: DataFrame, flips: int | None) -> DataFrame:
        """``(q..., w..., id, copies, distance)``: what is found for queries with a ``bound`` in all parts, or in their own with few flips."""
        out = bounds.select("bound", *names, F.inline(F.array(*parts_of(names))))
        reach = F.lit(0) if flips is not None else F.floor((F.col("bound") - F.col("segment")) / len(cut))
        out = out.withColumnRenamed("prefix", "_own").join(parts, "segment").filter(F.bit_count(F.col("_own").bitwiseXOR(F.col("prefix"))) <= reach)
        out = out.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).select(
            "segment", "prefix", "shard", F.col("bound").alias("mark"), F.lit(0).cast("long").alias("id"), *[F.col(q).alias(w) for q, w in zip(names, words)]
        )
        dealt = ["segment", "prefix", "shard"]
        # A task is long where rows are few, so adaptive execution, which goes by bytes, is not to merge them.
        out = out.unionByName(posting).repartition(len(cut) << prefix, *dealt).sortWithinPartitions(*dealt, "mark")
        schema = ", ".join([f"{c} long" for c in names + words] + ["id long", "copies int", "distance int"])
        return out.mapInArrow(gives_back(_searcher(cut, prefix, len(words), want, dims, flips)), schema)

    # One search for each distinct query code.
    distinct_queries = queries.select(*names).distinct()
    first = ask(distinct_queries.withColumn("bound", F.lit(dims)), FIRST_FLIPS).repartition(*names).distinct()
    nearer = Window.partitionBy(*names).orderBy("distance")
    bound = (
        first.withColumn("_n", F.sum("copies").over(nearer)).filter(F.col("_n") >= want).groupBy(*names).agg(F.min("distance").alias("bound"))
    )
    bound = distinct_queries.join(bound, names, "left").withColumn("bound", F.coalesce("bound", F.lit(dims)))
    found = ask(materialise(bound, "hamming-bounds"), None).repartition(*names).distinct()
    # Every row comes after the one with its code's smallest id, so k + 1 codes hold the k + 1 nearest rows.
    nearest = Window.partitionBy(*names).orderBy("distance", "id")
    best = materialise(found.withColumn("_n", F.row_number().over(nearest)).filter(F.col("_n") <= want).select(*names, *words, "distance"), "hamming-best")
    ranked = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    per_query = Window.partitionBy(*names).orderBy("distance", "vec_id")
    results = (
        best.join(index, words).select(*names, "distance", F.explode("ids").alias("vec_id"))
        .withColumn("_n", F.row_number().over(per_query)).filter(F.col("_n") <= want).drop("_n")
    )
    return (
        queries.join(results, names)
        .filter("vec_id <> query_id")
        .select("query_id", F.row_number().over(ranked).alias("rank"), "vec_id", "distance")
        .filter(F.col("rank") <= k)
    )


def _searcher(cut: list[tuple[int, int]], prefix: int, words: int, want: int, dims: int, flips: int | None):
    """A task of sorted parts: ``(segment, prefix, shard, mark, id, w...)``, the postings of a part before its queries."""
    names = [*[f"q{i}" for i in range(words)], *[f"w{i}" for i in range(words)], "id", "copies", "distance"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, part, postings = None, None, []
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            mark = columns[3]
            kind = np.stack([*columns[:3], mark < 0])
            edges = [0, *(np.flatnonzero((kind[:, 1:] != kind[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                here = tuple(int(c[a]) for c in columns[:3])
                if here != now:
                    now, part, postings = here, None, []
                codes = np.stack([c[a:b] for c in columns[5:]], axis=1).view(np.uint64)
                if mark[a] < 0:
                    postings.append((codes, columns[4][a:b], -mark[a:b]))
                    continue
                if part is None and postings:
                    part = Part(*(np.concatenate(c) for c in zip(*postings)), *cut[here[0]], prefix, here[0], len(cut))
                    postings = []
                if part is None:
                    continue  # a shard without codes
                for at in range(a, b, BLOCK):
                    asked = codes[at - a : at - a + BLOCK]
                    query, code, far = part.nearest(asked, mark[at : min(at + BLOCK, b)], want, dims, flips)
                    rows = [*asked[query].view(np.int64).T, *part.codes[code].view(np.int64).T, part.ids[code], part.copies[code].astype(np.int32), far.astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows], names)

    return run
