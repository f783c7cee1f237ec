"""Removal of byte strings that repeat across documents, by merged Burrows-Wheeler transforms.

A string of ``WINDOW`` bytes is removed wherever it also starts in a document
with a smaller doc_id.  Steps:

1. Documents are written once as chunks of about a MB, bucketed by chunk, with
   the *anchors* of their text: every window picks its least 24-byte gram by
   hash, so equal windows pick equal anchors wherever they stand.
2. Every window holds 13 bytes left of its anchor or, if not, 13 bytes right of
   it.  If no other document has that side, with the anchor, the window does not
   repeat.  Sorted hashes of sides go to hash ranges, which answer with one bit
   each.
3. The windows of an anchor with the left side, and those without it, are a
   segment each.  Segments of shared sides are dealt by side, each distinct
   segment once for a chunk with its least doc_id.  All equal windows meet there.
4. Segments that share a side but differ are split over shards; each shard
   gets its Burrows-Wheeler transform, and the transforms are merged by
   refining their interleaving two symbols a round.  After ``WINDOW`` symbols
   the blocks of the interleaving are the windows that repeat; the least
   doc_id of each block goes back to the chunks.

Segments of a side found in ``HOT`` chunks or more are not dealt by side but
window by window, so no task holds all texts around a frequent passage.  Equal
windows have equal sides, so they are always dealt alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, gives_back, materialise, scratch_path

WINDOW = 50
GRAM = 24
#: Grams a window holds, and so the reach of an anchor.
SPAN = WINDOW - GRAM + 1
#: Bytes of text a chunk holds, unless one document is longer.
CHUNK = 1 << 20
#: Text behind a bucket of chunks, on average.
PER_BUCKET = 12 << 20
#: Text behind a range of anchor hashes, on average.
PER_RANGE = 6 << 20
MOST_BUCKETS = 20_000
#: Chunks that share a side of an anchor before the windows with it are dealt one by one.
HOT = 512
#: Symbols of a shard that gets a transform of its own.
SHARD = 1 << 16
#: Symbols whose transforms are merged at once; a range's segments of an anchor stay together.
MERGED = 1 << 19
#: Bytes that no UTF-8 text holds; four of them stand for an anchor's gram, which every window of a segment holds whole.
_CODES = [bytes([c]) for c in (0xC0, 0xC1, *range(0xF5, 0xFF))]
_CODE = 4
#: Anchor positions looked at together.
_SLICE = 1 << 17
#: Texts hashed together.
_ROWS = 1 << 13
_LAST = np.iinfo(np.int64).max

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * _M1
    return h ^ (h >> np.uint64(29))


def _rolling(text: np.ndarray) -> np.ndarray:
    """A hash of every gram of ``GRAM`` = 16 + 8 bytes, by doubling."""
    h = (text.astype(np.uint64) + np.uint64(1)) * _M1
    for size in (1, 2, 4):
        n = len(h) - size
        h = (h[:n] ^ (h[:n] >> np.uint64(31))) * _M2 + h[size:]
    n = len(h) - 16
    wide = (h[:n] ^ (h[:n] >> np.uint64(31))) * _M2 + h[8 : 8 + n]
    return _mixed((wide ^ (wide >> np.uint64(31))) * _M3 + h[16:])


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    out, size = values, 1
    while size * 2 <= width:
        out = pick(out[:-size], out[size:])
        size *= 2
    return pick(out[: len(out) - (width - size)], out[width - size :]) if size < width else out


def anchors(blob: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(position, first, last)`` of every anchor: the windows ``first..last`` (by start) picked it.

    ``starts`` and ``ends`` bound the documents in ``blob``; no window crosses
    them.  Grams that tie for the least hash of a window are all anchors.
    """
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, max(0, len(blob) - GRAM + 1), _SLICE):
        # A slice of anchor positions, with all windows and grams that bear on them.
        lo = max(0, at - 2 * SPAN)
        part = blob[lo : at + _SLICE + 2 * SPAN + GRAM]
        h = _rolling(part) if len(part) > GRAM else np.empty(0, dtype=np.uint64)
        if len(h) < SPAN:
            continue
        least = _sliding(h, SPAN, np.minimum)
        padded = np.concatenate([np.zeros(SPAN - 1, dtype=np.uint64), least, np.zeros(SPAN - 1, dtype=np.uint64)])
        position = np.nonzero(_sliding(padded, SPAN, np.maximum) == h)[0]
        position = position[(position + lo >= at) & (position + lo < at + _SLICE)]
        step = np.arange(1, SPAN)
        own = h[position][:, None]
        before, after = position[:, None] - step, position[:, None] + step
        lower = (h[np.maximum(before, 0)] < own) & (before >= 0)
        higher = (h[np.minimum(after, len(h) - 1)] < own) & (after < len(h))
        left = np.where(lower.any(1), lower.argmax(1), SPAN - 1)
        right = np.where(higher.any(1), higher.argmax(1), SPAN - 1)
        position = position + lo
        found.append((position, position - left, position - (SPAN - 1) + right))
    if not found:
        none = np.empty(0, dtype=np.int64)
        return none, none, none
    position, first, last = (np.concatenate(x) for x in zip(*found))
    doc = np.searchsorted(starts, position, side="right") - 1
    first = np.maximum(first, starts[doc])
    last = np.minimum(np.minimum(last, position), ends[doc] - WINDOW)
    kept = first <= last
    return position[kept], first[kept], last[kept]


CHUNKS = "chunk long, ids binary, lengths binary, blob binary, anchors binary, carried binary"


def _pressed(*arrays: np.ndarray | bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(b"".join(a if isinstance(a, bytes) else a.tobytes() for a in arrays))


def _opened(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def _steps(position: np.ndarray) -> np.ndarray:
    """Positions as bytes: each the distance from the one before, with 255 for every 255 that it goes beyond."""
    gaps = np.diff(position, prepend=0)
    if not len(gaps) or gaps.max() < 255:
        return gaps.astype(np.uint8)
    out = np.full(int((gaps // 255 + 1).sum()), 255, dtype=np.uint8)
    out[np.cumsum(gaps // 255 + 1) - 1] = gaps % 255
    return out


def _positions(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps.astype(np.int64))[steps < 255]


def _written(parts: list[pa.Array]) -> bytes:
    """A column with whatever type it has, as bytes."""
    batch = pa.RecordBatch.from_arrays([pa.concat_arrays(parts)], ["carried"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    return _pressed(sink.getvalue().to_pybytes())


def _read(data: bytes) -> pa.Array:
    return pa.ipc.open_stream(_opened(data)).read_all()["carried"].combine_chunks()


def chunked(docs: DataFrame, size: int = CHUNK, carried: Column | None = None) -> DataFrame:
    """Documents as rows of several, with their anchors and, in the format of Arrow, the column ``carried``; a null doc_id sorts last."""
    carries = carried is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list[int | None] = []
        texts: list[bytes] = []
        more: list[pa.Array] = []
        held = 0

        def row() -> pa.RecordBatch:
            nonlocal number, ids, texts, more, held
            lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
            blob = b"".join(texts)
            ends = np.cumsum(lengths)
            full = lengths > 0
            position, first, last = anchors(np.frombuffer(blob, dtype=np.uint8), (ends - lengths)[full], ends[full])
            values = [
                number,
                pa.array(ids, pa.int64()).fill_null(_LAST).to_numpy(zero_copy_only=False).tobytes(),
                lengths.tobytes(),
                _pressed(blob),
                _pressed((position - first).astype(np.uint8), (position - last).astype(np.uint8), _steps(position)),
            ]
            # Both counts of an anchor come before the steps, whose number may differ.
            values[-1] = len(position).to_bytes(8, "little") + values[-1]
            values.append(_written(more) if carries else b"")
            number, ids, texts, more, held = number + 1, [], [], [], 0
            kinds = [pa.int64()] + [pa.binary()] * 5
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], CHUNK_NAMES)

        for batch in batches:
            start = 0
            for at, (doc, text) in enumerate(zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist())):
                text = text or b""
                if texts and held + len(text) > size:
                    more.append(batch["carried"].slice(start, at - start))
                    start = at
                    yield row()
                ids.append(doc)
                texts.append(text)
                held += len(text)
            more.append(batch["carried"].slice(start))
        if texts:
            yield row()

    with_doc = F.lit(None).cast("boolean") if carried is None else carried
    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), with_doc.alias("carried"))
    return chosen.mapInArrow(gives_back(run), CHUNKS)


CHUNK_NAMES = [c.split()[0] for c in CHUNKS.split(", ")]


def bucketed(df: DataFrame, buckets: int) -> DataFrame:
    """``df`` written once, bucketed by chunk below the shared scratch folder, so that joins by chunk do not move text."""
    path = scratch_path(df.sparkSession, "suffix-chunks")
    df.repartition(buckets, "chunk").write.bucketBy(buckets, "chunk").option("path", path).saveAsTable(_table_of(path))
    return df.sparkSession.table(_table_of(path))


def _table_of(path: str) -> str:
    return path.rsplit("/", 1)[1].replace("-", "_")


def forget(spark: SparkSession, paths: list[str]) -> None:
    """Take the tables of :func:`bucketed` at scratch paths out of the session's catalog; their files are left to the caller."""
    for path in paths:
        if "/suffix-chunks-" in path:
            spark.sql(f"DROP TABLE IF EXISTS {_table_of(path)}")


#: Bytes beside an anchor that every window of it holds on one side at least.
SIDE = (WINDOW - GRAM) // 2


def hashes_of(text: np.ndarray, first: np.ndarray, length: np.ndarray | int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of every ``text[first : first + length]``."""
    length = np.broadcast_to(np.asarray(length, dtype=np.int64), first.shape)
    out = np.empty(len(first), dtype=np.uint64)
    width = -(-int(length.max(initial=1)) // 8) * 8
    for at in range(0, len(first), _ROWS):
        start, size = first[at : at + _ROWS], length[at : at + _ROWS]
        place = start[:, None] + np.arange(width)
        held = text[np.minimum(place, len(text) - 1)]
        held[np.arange(width) >= size[:, None]] = 0
        h = (size.astype(np.uint64) + np.uint64(seed)) * _M1
        for word in held.view(np.uint64).T:
            h = (h ^ (h >> np.uint64(31))) * _M2 + word * _M3
            h ^= h >> np.uint64(29)
        out[at : at + _ROWS] = _mixed(h)
    return out


class Chunk:
    """A row of :func:`chunked`, unpacked."""

    def __init__(self, row: dict) -> None:
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        self.ends = np.cumsum(np.frombuffer(row["lengths"], dtype=np.int64))
        self.lengths = np.frombuffer(row["lengths"], dtype=np.int64)
        self.blob = _opened(row["blob"])
        self.bytes = np.frombuffer(self.blob, dtype=np.uint8)
        n = int.from_bytes(row["anchors"][:8], "little")
        packed = np.frombuffer(_opened(row["anchors"][8:]), dtype=np.uint8)
        self.position = _positions(packed[2 * n :])
        self.first = self.position - packed[:n]
        self.last = self.position - packed[n : 2 * n]
        self.doc = np.searchsorted(self.ends, self.position, side="right")

    def sides_by_range(self, ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, dict[int, tuple[int, int]]]:
        """Distinct hashes of what stands beside anchors.

        Gives the hashes in order (48 bits; meeting by chance only means more
        work), the anchor of each side, its first and last window, the place of
        each side among the hashes, whether two documents share a hash, and each
        range's part.  A window with both sides belongs to the left one.
        """
        left = np.nonzero(self.first <= self.position - SIDE)[0]
        right = np.nonzero(self.last > self.position - SIDE)[0]
        anchor = np.concatenate([left, right])
        first = np.concatenate([self.first[left], np.maximum(self.first[right], self.position[right] - SIDE + 1)])
        last = np.concatenate([np.minimum(self.last[left], self.position[left] - SIDE), self.last[right]])
        h = np.concatenate([
            hashes_of(self.bytes, self.position[left] - SIDE, GRAM + SIDE, 1),
            hashes_of(self.bytes, self.position[right], GRAM + SIDE, 2),
        ]) >> np.uint64(16)
        distinct, at = np.unique(h, return_inverse=True)
        least = np.full(len(distinct), _LAST)
        most = np.full(len(distinct), -1)
        np.minimum.at(least, at, self.doc[anchor])
        np.maximum.at(most, at, self.doc[anchor])
        present, starts = np.unique(range_of(distinct, ranges), return_index=True)
        stops = [*starts[1:].tolist(), len(distinct)]
        return distinct, anchor, first, last, at, least != most, dict(zip(present.tolist(), zip(starts.tolist(), stops)))


def range_of(h: np.ndarray, ranges: int) -> np.ndarray:
    """The range of a hash; it never falls as the hash grows."""
    return ((h >> np.uint64(16)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _six_bytes(h: np.ndarray) -> bytes:
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six_bytes(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def repeated_anchors(chunks: DataFrame, ranges: int, hot: int) -> DataFrame:
    """``(chunk, marks)``: for every range of hashes the bits of those that other chunks have too, and of hot ones."""
    out = pa.schema([("range", pa.int32()), ("chunk", pa.int64()), ("hashes", pa.binary())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            distinct, *_, parts = Chunk(row).sides_by_range(ranges)
            yield _batch([(r, row["chunk"], _six_bytes(distinct[a:b])) for r, (a, b) in parts.items()], out)

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [_from_six_bytes(x) for x in rows["hashes"]]
        _, at, n = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        n = n[at]
        cuts = np.cumsum([0] + [len(p) for p in parts])
        marks = [
            (chunk, rows["range"].iloc[0], np.packbits(n[a:b] > 1).tobytes(), np.packbits(n[a:b] >= hot).tobytes())
            for chunk, a, b in zip(rows["chunk"], cuts[:-1], cuts[1:])
        ]
        del parts, at, n
        give_back()
        return pd.DataFrame(marks, columns=["chunk", "range", "shared", "hot"])

    return (
        chunks.mapInArrow(gives_back(emit), "range int, chunk long, hashes binary")
        .groupBy("range")
        .applyInPandas(count, "chunk long, range int, shared binary, hot binary")
        .groupBy("chunk")
        .agg(F.collect_list(F.struct("range", "shared", "hot")).alias("marks"))
    )


class Segments:
    """What surrounds the anchors of a chunk with a side that two documents share.

    Distinct segments are in the order of their range; ``number`` counts them
    within it.  ``segment``, ``first`` and ``doc`` belong to occurrences.  A
    segment of a hot side is cut into single windows.
    """

    def __init__(self, row: dict, ranges: int) -> None:
        self.chunk = chunk = Chunk(row)
        distinct, anchor, first, last, at, shared, parts = chunk.sides_by_range(ranges)
        hot = np.zeros(len(distinct), dtype=bool)
        for mark in row["marks"] or []:
            a, b = parts[mark["range"]]
            shared[a:b] |= np.unpackbits(np.frombuffer(mark["shared"], dtype=np.uint8), count=b - a).astype(bool)
            hot[a:b] |= np.unpackbits(np.frombuffer(mark["hot"], dtype=np.uint8), count=b - a).astype(bool)
        plain, cut = np.nonzero((shared & ~hot)[at])[0], np.nonzero((shared & hot)[at])[0]
        sizes = last[cut] - first[cut] + 1
        each = np.repeat(cut, sizes)
        window = first[each] + np.arange(len(each)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        own = hashes_of(chunk.bytes, window, WINDOW) >> np.uint64(16)
        self.first = np.concatenate([first[plain], window])
        length = np.concatenate([last[plain] - first[plain] + WINDOW, np.full(len(window), WINDOW)])
        of = np.concatenate([anchor[plain], anchor[each]])
        place = chunk.position[of] - self.first
        self.doc = chunk.doc[of]
        part = range_of(np.concatenate([distinct[at[plain]], own]), ranges)
        # Equal texts can have anchors, and so sides, at several places; single windows are dealt by their text alone.
        _, head, same = distinct_texts(chunk.bytes, self.first, length, np.append(place[: len(plain)] + 1, np.zeros(len(window), dtype=np.int64)))
        least = np.full(len(head), _LAST)
        np.minimum.at(least, same, chunk.ids[self.doc])
        order = np.argsort(part[head], kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        self.segment, head = rank[same], head[order]
        self.least, self.range, self.length, self.place, self.start = least[order], part[head], length[head], place[head], self.first[head]
        self.ranges, starts = np.unique(self.range, return_index=True)
        self.cuts = [*starts.tolist(), len(head)]

    def text(self, a: int, b: int) -> bytes:
        """The segments ``a`` to ``b``, one after the other."""
        size = self.length[a:b]
        place = np.repeat(self.start[a:b] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        return self.chunk.bytes[place].tobytes()


def distinct_texts(text: np.ndarray, first: np.ndarray, length: np.ndarray, kind: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first occurrence and number of the distinct ``text[first : first + length]`` (of a ``kind``), told apart by 128 bits."""
    one, two = hashes_of(text, first, length, 3), hashes_of(text, first, length, 4)
    if kind is not None:
        one, two = _mixed(one + kind.astype(np.uint64) * _M2), _mixed(two + kind.astype(np.uint64) * _M3)
    distinct, head, same = np.unique(one, return_index=True, return_inverse=True)
    if (two[head][same] != two).any():
        both = np.stack([one, two], axis=1)
        found, head, same = np.unique(both, axis=0, return_index=True, return_inverse=True)
        return found[:, 0], head, same.ravel()
    return distinct, head, same


def shard_transform(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform of several strings, and the text position of each row.

    Bytes count one up, so that 0 ends a string; ends sort by string.
    """
    text = np.frombuffer(b"\xff".join(strings) + b"\xff", dtype=np.uint8) + np.uint8(1)
    n = len(text)
    ends = np.nonzero(text == 0)[0]
    rest = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)
    padded = np.concatenate([text, np.zeros(8, dtype=np.uint8)]).astype(np.uint64)
    key = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | np.where(rest >= k, padded[k : k + n], np.uint64(0))
    _, rank = np.unique(key, return_inverse=True)
    longest = int(rest.max(initial=0)) + 1
    step = 8
    while step < longest:
        after = np.where(rest >= step, rank[np.minimum(np.arange(n) + step, n - 1)] + 1, 0)
        _, rank = np.unique(rank.astype(np.uint64) << np.uint64(32) | after.astype(np.uint64), return_inverse=True)
        step *= 2
    rows = np.argsort(rank, kind="stable")
    return np.where(rows > 0, text[rows - 1], 0).astype(np.uint8), rows


def merged_blocks(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of all transforms interleaved by their first ``depth`` (even) symbols, and the block of each place.

    Two places are in one block if they agree in those symbols, which is where
    the common prefix of neighbours reaches ``depth``.  Each round puts the rows
    in the order of two more symbols: rows keep their order and are moved by the
    symbols before them (LF mapping); nothing else of the texts is needed.
    """
    symbols = np.concatenate(transforms)
    n = len(symbols)
    step = np.empty(n, dtype=np.int64)
    heads = []
    base = 0
    for t in transforms:
        step[base + np.argsort(t, kind="stable")] = np.arange(base, base + len(t))
        heads.append(np.arange(base, base + int((t == 0).sum())))
        base += len(t)
    ends = np.concatenate(heads)  # rows of string ends: a string's row 0 symbol is 0, and each string has one end
    two = step[step]
    code = (symbols[step].astype(np.uint16) << 8) | symbols
    movable = (symbols != 0) & (symbols[step] != 0)
    one = ends[symbols[ends] != 0]
    seeds = np.concatenate([ends, step[one]])
    seed_codes = np.concatenate([np.zeros(len(ends), dtype=np.uint16), symbols[one].astype(np.uint16) << 8])
    order, block = np.arange(n), np.zeros(n, dtype=np.int64)
    for _ in range(depth // 2):
        moving = movable[order]
        from_row, from_block = order[moving], block[moving] + 1
        codes = np.concatenate([seed_codes, code[from_row]])
        rows = np.concatenate([seeds, two[from_row]])
        sources = np.concatenate([np.zeros(len(seeds), dtype=np.int64), from_block])
        sort = np.argsort(codes, kind="stable")
        order, codes, sources = rows[sort], codes[sort], sources[sort]
        block = np.zeros(n, dtype=np.int64)
        np.cumsum((codes[1:] != codes[:-1]) | (sources[1:] != sources[:-1]), out=block[1:])
    return order, block


def least_by_window(strings: list[bytes], least: np.ndarray, shard: int = SHARD, window: int = WINDOW) -> list[np.ndarray]:
    """For every string the least of ``least`` over all strings that hold each of its windows (of an even size)."""
    transforms, places, base = [], [], 0
    group: list[bytes] = []
    held = 0
    for i, s in enumerate(strings):
        group.append(s)
        held += len(s) + 1
        if held >= shard or i == len(strings) - 1:
            t, rows = shard_transform(group)
            transforms.append(t)
            places.append(rows + base)
            base += len(t)
            group, held = [], 0
    order, block = merged_blocks(transforms, window)
    lengths = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings)) + 1
    starts = np.cumsum(lengths) - lengths
    at = np.concatenate(places)[order]
    string = np.searchsorted(starts, at, side="right") - 1
    offset = at - starts[string]
    whole = offset + window < lengths[string]
    at, string, block = at[whole], string[whole], block[whole]
    heads = np.nonzero(np.diff(block, prepend=-1))[0]
    found = np.minimum.reduceat(least[string], heads)[np.searchsorted(block[heads], block)]
    out = np.full(int(lengths.sum()), _LAST)
    out[at] = found
    return [out[a : a + n - window] for a, n in zip(starts.tolist(), lengths.tolist())]


def answer(rows: list[dict], shard: int = SHARD) -> list[tuple[int, int, bytes]]:
    """For every chunk's segments in a range: runs of windows with a least doc_id below the chunk's own."""
    blobs, mins, lengths, places, counts = [], [], [], [], []
    for row in rows:
        n, data = row["n"], _opened(row["segments"])
        counts.append(n)
        mins.append(np.frombuffer(data, dtype=np.int64, count=n))
        lengths.append(np.frombuffer(data, dtype=np.uint8, count=n, offset=8 * n))
        places.append(np.frombuffer(data, dtype=np.uint8, count=n, offset=9 * n))
        blobs.append(np.frombuffer(data, dtype=np.uint8, offset=10 * n))
    text, own = np.concatenate(blobs), np.concatenate(mins)
    length, place = np.concatenate(lengths).astype(np.int64), np.concatenate(places).astype(np.int64)
    start = np.cumsum(length) - length
    _, head, same = distinct_texts(text, start, length)
    least = np.full(len(head), _LAST)
    np.minimum.at(least, same, own)
    start, size, place = start[head], length[head], place[head]
    # A segment that shares no side of its anchor with a different one holds no window of another.
    left, right = np.nonzero(place >= SIDE)[0], np.nonzero(size >= place + GRAM + SIDE)[0]
    sides = np.concatenate([hashes_of(text, start[left] + place[left] - SIDE, GRAM + SIDE, 1), hashes_of(text, start[right] + place[right], GRAM + SIDE, 2)])
    _, at, met = np.unique(sides, return_inverse=True, return_counts=True)
    mixed = np.unique(np.concatenate([left, right])[met[at] > 1])
    gram = hashes_of(text, start[mixed] + place[mixed], GRAM)
    order = np.argsort(gram, kind="stable")
    mixed, gram = mixed[order], gram[order]
    # All segments of an anchor in a range stay together; a part ends at the first change of anchor beyond its size.  A gram is
    # written as its number in the part, so texts and windows get shorter by what they have in common.
    symbols, begun, number = np.cumsum(size[mixed] - GRAM + _CODE + 1), 0, 0
    values: list[np.ndarray] = []
    strings: list[bytes] = []
    changes = np.append(np.nonzero(gram[1:] != gram[:-1])[0] + 1, len(mixed)) if len(mixed) else np.empty(0, dtype=np.int64)
    for first, stop in zip(np.append(0, changes[:-1]).tolist(), changes.tolist()):
        code = b"".join(_CODES[number // len(_CODES) ** k % len(_CODES)] for k in range(_CODE))
        one = mixed[first:stop]
        for a, n, p in zip(start[one].tolist(), size[one].tolist(), place[one].tolist()):
            strings.append(text[a : a + p].tobytes() + code + text[a + p + GRAM : a + n].tobytes())
        number += 1
        full = symbols[stop - 1] - (symbols[begun - 1] if begun else 0) >= MERGED or number == len(_CODES) ** _CODE
        if full or stop == len(mixed):
            values.extend(least_by_window(strings, least[mixed[begun:stop]], shard, WINDOW - GRAM + _CODE))
            begun, number, strings = stop, 0, []
    # Runs of windows of equal least doc_id: of a segment that mixes with no other, all its windows.
    alone = np.ones(len(head), dtype=bool)
    alone[mixed] = False
    alone = np.nonzero(alone)[0]
    windows = np.concatenate([size[alone] * 0 + 1, size[mixed] - WINDOW + 1])
    of = np.repeat(np.concatenate([alone, mixed]), windows)
    value = np.concatenate([least[alone], *values])
    begins = np.nonzero(np.append(True, (of[1:] != of[:-1]) | (value[1:] != value[:-1])))[0] if len(of) else np.empty(0, dtype=np.int64)
    base = np.repeat(np.cumsum(windows) - windows, windows)
    froms, tos = begins - base[begins], np.append(begins[1:], len(of)) - base[begins]
    of, value = of[begins], value[begins]
    tos = np.where(np.isin(of, alone, assume_unique=False), size[of] - WINDOW + 1, tos)
    order = np.argsort(of, kind="stable")
    froms, tos, value = froms[order], tos[order], value[order]
    runs = np.bincount(of, minlength=len(head))
    ahead = np.cumsum(runs) - runs
    out, stop = [], 0
    for row, n in zip(rows, counts):
        mine, low = same[stop : stop + n], own[stop : stop + n]
        stop += n
        many = runs[mine]
        each = np.repeat(np.arange(n), many)
        run = np.repeat(ahead[mine] - np.cumsum(many) + many, many) + np.arange(len(each))
        lower = value[run] < low[each]
        each, run = each[lower], run[lower]
        packed = _pressed(value[run].astype(np.int64), each.astype(np.uint32), froms[run].astype(np.uint8), tos[run].astype(np.uint8))
        out.append((row["chunk"], len(each), packed))
    return out


def kept_documents(own: Segments, answers: list[dict]) -> Iterator[tuple[int, int, int, int, bytes]]:
    """``(document, n_bytes, n_removed, n_spans, kept bytes)`` for all documents of a chunk."""
    chunk = own.chunk
    begin = dict(zip(own.ranges.tolist(), own.cuts))
    number, froms, tos, found = [np.arange(len(own.least))], [np.zeros(len(own.least), dtype=np.int64)], [own.length - WINDOW + 1], [own.least]
    for a in answers:
        n, data = a["n"], _opened(a["runs"])
        found.append(np.frombuffer(data, dtype=np.int64, count=n))
        number.append(np.frombuffer(data, dtype=np.uint32, count=n, offset=8 * n).astype(np.int64) + begin[a["range"]])
        froms.append(np.frombuffer(data, dtype=np.uint8, count=n, offset=12 * n).astype(np.int64))
        tos.append(np.frombuffer(data, dtype=np.uint8, count=n, offset=13 * n).astype(np.int64))
    number, froms, tos, found = (np.concatenate(x) for x in (number, froms, tos, found))
    order = np.argsort(number, kind="stable")
    froms, tos, found = froms[order], tos[order], found[order]
    runs = np.bincount(number, minlength=len(own.least))
    # Every occurrence with every run of its segment.
    many = runs[own.segment]
    each = np.repeat(np.arange(len(own.segment)), many)
    run = np.repeat((np.cumsum(runs) - runs)[own.segment] - np.cumsum(many) + many, many) + np.arange(len(each))
    goes = found[run] < chunk.ids[own.doc[each]]
    each, run = each[goes], run[goes]
    size = len(chunk.bytes) + 1
    change = np.bincount(own.first[each] + froms[run], minlength=size) - np.bincount(own.first[each] + tos[run] - 1 + WINDOW, minlength=size)
    gone = np.cumsum(change[:-1]) > 0
    for doc, (end, n) in enumerate(zip(chunk.ends.tolist(), chunk.lengths.tolist())):
        cut = gone[end - n : end]
        removed = int(np.count_nonzero(cut))
        if not removed:
            yield doc, n, 0, 0, chunk.blob[end - n : end]
            continue
        spans = int(cut[0]) + int(np.count_nonzero(cut[1:] & ~cut[:-1]))
        yield doc, n, removed, spans, chunk.bytes[end - n : end][~cut].tobytes()


def _answered(docs: DataFrame, hot: int, per_range: int, chunk_size: int, carried: Column | None) -> tuple[DataFrame, int]:
    """Chunks with all that is known about their segments, and the number of ranges."""
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    ranges = max(1, -(-total // per_range))
    chunks = bucketed(chunked(docs, chunk_size, carried), min(MOST_BUCKETS, max(1, -(-total // PER_BUCKET))))
    marks = materialise(repeated_anchors(chunks, ranges, hot), "suffix-marks")
    marked = chunks.join(marks.hint("shuffle_hash"), "chunk", "left")
    out = pa.schema([("range", pa.int32()), ("chunk", pa.int64()), ("n", pa.int32()), ("segments", pa.binary())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            own = Segments(row, ranges)
            rows = []
            for r, a, b in zip(own.ranges.tolist(), own.cuts[:-1], own.cuts[1:]):
                packed = _pressed(own.least[a:b], own.length[a:b].astype(np.uint8), own.place[a:b].astype(np.uint8), own.text(a, b))
                rows.append((r, row["chunk"], b - a, packed))
            yield _batch(rows, out)

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        r = rows["range"].iloc[0]
        found = answer(rows.sort_values("chunk").to_dict("records"))
        give_back()
        return pd.DataFrame([(c, r, *x) for c, *x in found], columns=["chunk", "range", "n", "runs"])

    answers = materialise(
        marked.mapInArrow(gives_back(emit), "range int, chunk long, n int, segments binary")
        .groupBy("range")
        .applyInPandas(meet, "chunk long, range int, n int, runs binary")
        .groupBy("chunk")
        .agg(F.collect_list(F.struct("range", "n", "runs")).alias("answers")),
        "suffix-answers",
    )
    return marked.join(answers.hint("shuffle_hash"), "chunk", "left"), ranges


def _finished(docs: DataFrame, carried: Column | None, hot: int, per_range: int, chunk_size: int) -> DataFrame:
    """Counts and digest of every document and, with a column to carry, the bytes left and that column."""
    known, ranges = _answered(docs, hot, per_range, chunk_size, carried)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    schema = T.StructType.fromDDL("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    carries = carried is not None
    if carries:
        kinds.append(pa.binary())
        schema = schema.add("kept", "binary").add("carried", docs.select(carried.alias("carried")).schema[0].dataType)
    names = schema.names

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            own = Segments(row, ranges)
            rows = []
            for doc, n, removed, spans, kept in kept_documents(own, row["answers"] or []):
                name = int(own.chunk.ids[doc])
                rows.append((None if name == _LAST else name, n, removed, spans, hashlib.sha256(kept).hexdigest(), kept))
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
            if carries:
                columns.append(_read(row["carried"]))
            yield pa.RecordBatch.from_arrays(columns, names)

    return known.mapInArrow(gives_back(finish), schema)


def remove_repeats(docs: DataFrame, hot: int = HOT, per_range: int = PER_RANGE, chunk_size: int = CHUNK) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)``, one row per row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored.  Defined
    results: a null or empty text has no bytes and loses none; texts below 50
    bytes lose nothing; rows that repeat a doc_id do not shorten each other; a
    null doc_id counts as larger than any other; an empty table gives no rows.
    """
    return _finished(docs, None, hot, per_range, chunk_size)


def shortened(docs: DataFrame, hot: int = HOT, per_range: int = PER_RANGE, chunk_size: int = CHUNK) -> DataFrame:
    """``docs`` with the remaining text of each row in ``text``; all other columns stay.

    Bytes of a character of which only a part remains are dropped.  A text that
    repeats as a whole becomes empty, and a null text stays null.
    """
    others = [c for c in docs.columns if c != "text"]
    carried = F.struct(F.col("text").isNull().alias("absent"), F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"))
    rows = _finished(docs, carried, hot, per_range, chunk_size)
    back = rows.select("carried", F.try_validate_utf8(F.col("kept").cast("string")).alias("_valid"), "kept")
    text = F.when(F.col("carried.absent"), F.lit(None)).otherwise(F.coalesce("_valid", _whole_characters(F.col("kept"))))
    return back.select(*[text.alias("text") if c == "text" else F.col("carried.row").getField(c).alias(c) for c in docs.columns])


def _whole_characters(kept: Column) -> Column:
    """Bytes as text, without the bytes that are part of no whole character."""
    return F.replace(F.make_valid_utf8(kept.cast("string")), F.lit("\ufffd"), F.lit(""))


def remove_repeats_sql(documents: str = "documents") -> str:
    """:func:`remove_repeats` for DuckDB, window by window; for small tables."""
    return f"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM {documents}),
windows AS (SELECT r, doc_id, i, substr(h, 2 * i + 1, {2 * WINDOW}) AS s
  FROM (SELECT r, doc_id, h, unnest(range(0, greatest(len(h) // 2 - {WINDOW - 1}, 0))) AS i FROM docs)),
repeated AS (SELECT s, min(coalesce(doc_id, {_LAST})) AS least FROM windows GROUP BY s HAVING count(*) > 1),
hits AS (SELECT r, i FROM windows JOIN repeated USING (s) WHERE least < coalesce(doc_id, {_LAST})),
islands AS (SELECT r, i, sum(CASE WHEN i <= before + {WINDOW} THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS g
  FROM (SELECT *, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM hits)),
spans AS (SELECT r, g, min(i) AS a, max(i) + {WINDOW} AS b FROM islands GROUP BY r, g),
pieces AS (
  SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS b FROM spans
  UNION ALL SELECT r, coalesce(max(spans.b), 0), any_value(len(h) // 2) FROM docs LEFT JOIN spans USING (r) GROUP BY r),
kept AS (SELECT r, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS k FROM pieces JOIN docs USING (r) GROUP BY r),
counts AS (SELECT r, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(k)) AS kept_sha256
FROM docs JOIN kept USING (r) LEFT JOIN counts USING (r)"""
