"""Token counts of whole texts by a two-tier lookup of pre-tokens on the map side.

No merge of the tokenizer crosses certain places of a text, so its number of
tokens is the sum over the pre-tokens between them.  Lengths of frequent
pre-tokens are broadcast in a compact table; other pre-tokens are encoded once
and kept in a cache of the task.  Pre-tokens are never shuffled: what the
frequent ones are follows from a bounded summary of each task, and only decides
where a length is looked up, not what it is.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


LIMIT = 4096
#: Entries of the broadcast table, and characters of an entry, at most.
FREQUENT, ENTRY = 65_536, 64
#: Candidates for the table that one task names.
NAMED = 32_768
#: Different pre-tokens a task's summary holds before the rarest go.
SUMMARY = 400_000
#: Bytes of pre-tokens (with about 100 for an entry) a task's cache holds before it starts anew.
CACHE_BYTES = 64 << 20
_ENTRY_BYTES = 100

#: Space runs belong to what follows, a line end to what stands right behind it.
PRE_TOKEN = r" *[^ \n]+| +|\n[^ \n]*"
_META = "▁"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Lengths:
    """Numbers of tokens of pre-tokens and of whole texts, for one tokenizer file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        crossing = re.compile(f"[^{_META}]{_META}")
        #: Cutting is sound if no piece goes on after a word with a space, none has a line end beside other
        #: characters, and texts are taken as they are.
        self.cuts = not any(crossing.search(p) or ("\n" in p and len(p) > 1) for p in pieces) and [
            "".join(self.model.encode(t, out_type=str)).replace(_META, " ") for t in ("x  y ", "ﬁ", "é")
        ] == [" x  y ", " ﬁ", " é"]
        self.split = re.compile(PRE_TOKEN).findall

    def pre_tokens(self, text: str) -> list[str]:
        """A text, cut; all but those that begin with a line end stand without the space they begin with.

        The model puts a space before the text and takes its own sign for one as a space.
        """
        if not text:
            return []
        seen = " " + text.replace(_META, " ")
        if "  " in seen or " \n" in seen or seen[-1] == " ":
            return [t[1:] if t[0] == " " else t for t in self.split(seen)]
        return seen.replace("\n", " \n").split(" ")[1:]

    def of(self, pre_tokens: list[str]) -> list[int]:
        """The model puts a space before each; before a line end it is a token by itself."""
        found = self.model.encode(pre_tokens, num_threads=1)
        # Nothing to encode gets no space either: a pre-token of one space.
        return [len(ids) - 1 if t[:1] == "\n" else len(ids) or 1 for t, ids in zip(pre_tokens, found)]

    def whole(self, text: str) -> int:
        return len(self.model.encode(text))


def frequent_lengths(docs: DataFrame, path: str, frequent: int = FREQUENT) -> pa.Table:
    """``(pre_token, length)`` of frequent pre-tokens of all texts, at most ``frequent``.

    A task sums up all its texts in a summary of bounded size and names its most
    frequent pre-tokens; the counts of the names are added up.
    """

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(path)
        seen: Counter[str] = Counter()
        for batch in batches if lengths.cuts else ():
            for text in batch["text"].to_pylist():
                seen.update(lengths.pre_tokens(text or ""))
                rare = 1
                while len(seen) > SUMMARY:
                    seen = Counter({t: n for t, n in seen.items() if n > rare})
                    rare *= 2
        named = [(t, n) for t, n in seen.most_common(NAMED) if n > 1 and len(t) <= ENTRY]
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in named], pa.string()), pa.array([n for _, n in named], pa.int64())], ["pre_token", "n"])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(path)
        for batch in batches:
            found = lengths.of(batch["pre_token"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["pre_token"], pa.array(found, pa.int32())], ["pre_token", "length"])

    named = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(name, "pre_token string, n long")
    most = named.groupBy("pre_token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pre_token").limit(frequent)
    return most.select("pre_token").mapInArrow(measure, "pre_token string, length int").toArrow()


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT, frequent: int = FREQUENT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row per row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored.  Counts
    are those of the library for the whole text without begin and end tokens.
    Defined results: null and empty texts have no bytes and no tokens; repeated
    rows give repeated rows; an empty table gives no rows.  A tokenizer whose
    pieces cross pre-tokens encodes every text whole.
    """
    path = path or tokenizer_path()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    table = frequent_lengths(docs, path, frequent)
    shared = docs.sparkSession.sparkContext.broadcast((table["pre_token"].combine_chunks(), table["length"].combine_chunks()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(path)
        pre_tokens, found = shared.value
        frequent = dict(zip(pre_tokens.to_pylist(), found.to_pylist()))
        # The table, then what this task has encoded.
        known, held = dict(frequent), 0
        for batch in batches:
            n_tokens = []
            for text in batch["text"].to_pylist():
                if not lengths.cuts:
                    n_tokens.append(lengths.whole(text or ""))
                    continue
                cut = lengths.pre_tokens(text or "")
                each = list(map(known.get, cut))
                if None in each:
                    missed = list({t for t, n in zip(cut, each) if n is None})
                    size = sum(map(len, missed)) * 4 + _ENTRY_BYTES * len(missed)
                    if held and held + size > CACHE_BYTES:
                        known, held = dict(frequent), 0
                        missed = list(set(cut).difference(known))
                    known.update(zip(missed, lengths.of(missed)))
                    held += size
                    each = map(known.__getitem__, cut)
                n_tokens.append(sum(each))
            size = [len(t or b"") for t in batch["text"].cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(size, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return texts.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
