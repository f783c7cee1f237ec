"""Best-fit packing of tokenised documents into sequences of one length.

Method: hierarchical residual packing.  Blocks of pieces are packed best-fit
(largest first, each into the fullest bin that still holds it).  Bins that are
nearly full are final; the others go on as items of their fill, are dealt to
fewer blocks and packed again, until one block holds them all or a round no
longer helps.  A block never holds more than about ``block`` items.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gives_back, materialise, worker_cache

SEQUENCE = 2048
#: Id that ends a document.
END = 0
#: Items a packing block holds on average.
BLOCK = 2000
#: A bin with no more free room than this is final.
SLACK = 8
#: Bytes of words and ids (with about 170 more for an entry) in a generation of a worker's cache, which has two.
CACHE_BYTES = 80 << 20
_ENTRY_BYTES = 170
#: Bytes of text whose distinct words are looked up together.
TEXT_BYTES = 8 << 20
#: Pieces encoded as one text.
_TOGETHER = 256
#: What the last token of every piece of a word ends with.
_WORD_END = "</w>"
#: Letters that neither normal form nor lower case changes, whatever letters and marks stand beside them: Latin, Greek,
#: Cyrillic, Hebrew, Arabic, kana, Han and Hangul.
_LETTERS = "a-zß-öø-ÿα-ωа-џא-תء-غف-يぁ-ゖァ-ヺ一-龥가-힣"
#: What the tokenizer makes a piece of words that hold only these letters, digits and marks: no apostrophe, which can begin
#: a piece of its own, and no bar, which special tokens have.
_PIECES_OF_WORD = re.compile(f"[{_LETTERS}]+|[0-9]|[!-&(-/:-@\\[-`{{}}~]+").findall

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Token ids of words and of their pieces, as bytes: two generations of bounded size, so that those in use outlive the others."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.encode = tokenizer.encode_batch_fast
        self.ends = np.zeros(tokenizer.get_vocab_size(), dtype=bool)
        self.ends[[i for token, i in tokenizer.get_vocab().items() if token.endswith(_WORD_END)]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def _one_by_one(self, words: list[str]) -> dict[str, bytes]:
        found = self.encode(words, add_special_tokens=False)
        return {w: np.array(f.ids, dtype="<u4").tobytes() for w, f in zip(words, found)}

    def _together(self, pieces: list[str]) -> dict[str, bytes]:
        """Words of one piece each, encoded as one text and cut where pieces end."""
        ids = np.array(self.encode([" ".join(pieces)], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(pieces):
            return self._one_by_one(pieces)
        packed, stops = ids.tobytes(), (4 * ends).tolist()
        return {p: packed[a:b] for p, a, b in zip(pieces, [0, *stops], stops)}

    def each(self, words: list[str]) -> list[bytes]:
        """Ids of every word.  Of words with known pieces only the pieces are held and encoded."""
        if self.held > CACHE_BYTES:
            self.old, self.young, self.held = self.young, {}, 0
        out = list(map(self.young.get, words))
        # Flat lists: many small ones would keep the garbage collector busy.
        missing = [n for n, ids in enumerate(out) if ids is None]
        parts: list[str] = []
        counts: list[int] = []
        others: set[str] = set()
        for n in missing:
            word = words[n]
            part = _PIECES_OF_WORD(word)
            if "".join(part) != word:
                part = [word]
                others.add(word)
            parts += part
            counts.append(len(part))
        new = [p for p in set(parts) if p not in self.young]
        found = {p: self.old[p] for p in new if p in self.old}
        pieces = [p for p in new if p not in found and p not in others]
        for at in range(0, len(pieces), _TOGETHER):
            found |= self._together(pieces[at : at + _TOGETHER])
        if rest := [w for w in others if w not in found]:
            found |= self._one_by_one(rest)
        self.young.update(found)
        self.held += sum(map(len, found)) + sum(map(len, found.values())) + _ENTRY_BYTES * len(found)
        ids_of = list(map(self.young.get, parts))
        at = 0
        for n, count in zip(missing, counts):
            out[n] = ids_of[at] if count == 1 else b"".join(ids_of[at : at + count])
            at += count
        return out

    def of(self, words: list[bytes]) -> bytes:
        """Ids of the words one after the other."""
        return b"".join(self.each([w.decode() for w in words]))


#: One for each tokenizer file, kept from task to task of one worker until another operator's task begins there.
_WORD_IDS: dict[str, WordIds] = worker_cache()


def word_ids(path: str) -> WordIds:
    if path not in _WORD_IDS:
        _WORD_IDS[path] = WordIds(path)
    return _WORD_IDS[path]


def _in_blocks(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Runs of ``texts``, of about ``TEXT_BYTES`` or a single text, with the place where each begins."""
    block = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64) // TEXT_BYTES
    starts = [*np.flatnonzero(np.diff(block, prepend=-1)).tolist(), len(texts)]
    for at, stop in zip(starts, starts[1:]):
        yield at, texts.slice(at, stop - at)


def _ids_of_texts(texts: pa.Array, ids: WordIds) -> Iterator[bytes]:
    """Ids of each text: its words' ids, where each distinct word is looked up once for all texts."""
    # The tokenizer lowers words, but not the names of its special tokens.
    words = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts)))
    coded = words.flatten().dictionary_encode()
    distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    packed = pa.array(ids.each(distinct), pa.large_binary()).take(coded.indices)
    _, offsets, data = packed.buffers()
    ends = np.frombuffer(offsets, np.int64)[np.cumsum(pc.list_value_length(words).to_numpy(), dtype=np.int64)].tolist()
    data = memoryview(data or b"")
    return (bytes(data[a:b]) for a, b in zip([0, *ends], ends))


def pieces(docs: DataFrame, path: str | None = None, capacity: int = SEQUENCE, end: int = END) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: every document cut into pieces of at most ``capacity`` ids.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored.  A null
    text counts as empty and gives one piece of the end id.  Repeated rows give
    repeated pieces.  The tokenizer drops white space, so ids of a text are the
    ids of its words one after the other, and each distinct word is encoded once
    while it stays in the cache.
    """
    path = path or tokenizer_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_ids(path)
        tail = np.array([end], dtype="<u4").tobytes()
        step = 4 * capacity
        for batch in batches:
            out: list[tuple] = []
            doc_ids = batch["doc_id"].to_pylist()
            for first, texts in _in_blocks(batch["text"].fill_null("")):
                for doc, packed in zip(doc_ids[first : first + len(texts)], _ids_of_texts(texts, ids)):
                    packed += tail
                    for n, at in enumerate(range(0, len(packed), step)):
                        part = packed[at : at + step]
                        out.append((doc, n, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(gives_back(cut, keeps=True), PIECES)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the fill of each bin; items are placed in the order given.

    The free rooms in use are bits of one integer, so the smallest room that is
    large enough is the lowest set bit at or above the size.
    """
    bins = np.empty(len(sizes), dtype=np.int64)
    offsets = np.empty(len(sizes), dtype=np.int64)
    fills: list[int] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0
    for i, size in enumerate(sizes.tolist()):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            stack = by_room[room]
            b = stack.pop()
            if not stack:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += size
        left = room - size
        if left:
            by_room.setdefault(left, []).append(b)
            rooms |= 1 << left
    return bins, offsets, np.array(fills, dtype=np.int64)


def _packed_block(capacity: int):
    def pack_block(items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["size", "item"], ascending=[False, True], kind="stable")
        bins, offsets, fills = best_fit(items["size"].to_numpy(), capacity)
        ids = items["item"].to_numpy()
        names = np.full(len(fills), np.iinfo(np.int64).max)
        np.minimum.at(names, bins, ids)
        return pd.DataFrame({"item": ids, "bin": names[bins], "offset": offsets, "fill": fills[bins]})

    return pack_block


def pack(items: DataFrame, capacity: int = SEQUENCE, block: int = BLOCK, slack: int = SLACK) -> DataFrame:
    """``(item, bin, offset)`` for ``items (item long, size long)`` with unique items and sizes of 1 to ``capacity``.

    A bin is named after its smallest item.  An item of exactly ``capacity`` is
    a bin by itself.  An empty table gives an empty table.
    """
    items = items.select(F.col("item").cast("long"), F.col("size").cast("long"))
    whole = items.filter(F.col("size") == capacity).select("item", F.col("item").alias("bin"), F.lit(0).cast("long").alias("offset"))
    todo = items.filter(F.col("size") < capacity)
    n = todo.count()
    placed: DataFrame | None = None
    while True:
        blocks = max(1, -(-n // block))
        level = materialise(
            todo.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
            .groupBy("block")
            .applyInPandas(_packed_block(capacity), "item long, bin long, offset long, fill long"),
            "packing-level",
        )
        if placed is None:
            placed = level.select("item", "bin", "offset")
        else:
            up = level.select(F.col("item").alias("bin"), F.col("bin").alias("_up"), F.col("offset").alias("_at"))
            placed = placed.join(up, "bin", "left").select(
                "item", F.coalesce("_up", "bin").alias("bin"), (F.col("offset") + F.coalesce("_at", F.lit(0))).alias("offset")
            )
        if blocks == 1:
            break
        # One row per bin: the item it is named after.
        todo = level.filter((F.col("item") == F.col("bin")) & (F.col("fill") < capacity - slack)).select(
            "item", F.col("fill").alias("size")
        )
        before, n = n, todo.count()
        if n == 0 or n > 0.9 * before:
            break
    return whole.unionByName(placed)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = SEQUENCE, block: int = BLOCK) -> DataFrame:
    """Pieces of all documents with their place: ``sequence_id`` and ``offset``, gapless from 0.

    Defined results: null and empty texts are one piece of length 1; repeated
    rows are packed once for each row; an empty table gives no rows.
    """
    cut = materialise(
        pieces(docs, path, capacity).select("*", F.monotonically_increasing_id().alias("item")), "packing-pieces"
    )
    places = pack(cut.select("item", F.col("length").alias("size")), capacity, block)
    return cut.join(places, "item").select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset"
    )


__all__ = ["best_fit", "pack", "pack_documents", "pieces", "tokenizer_path"]
