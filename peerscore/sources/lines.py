"""Blocks of delimited text to Arrow batches of lines, for whole fields at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ..functions.casts import NULL_TOKENS

BLOCK_BYTES = 4 << 20


def lines_schema(names: Sequence[str]) -> str:
    return "path string, member string, member_no int, line_no long, fields long" + "".join(f", `{n}` string" for n in names)


def field_mask(present: Sequence[str], names: Sequence[str]) -> int:
    """Which of ``names`` a header has: bit i for name i."""
    return sum(1 << i for i, n in enumerate(names) if n in present)


def _pick(lines: pa.Array, positions: list[int | None], sep: str) -> list[pa.Array]:
    """Fields of all lines by position; null where a line is too short or holds a null token."""
    parts = pc.split_pattern(lines, sep)
    offsets = parts.offsets.to_numpy()
    lengths = np.diff(offsets)
    picked = []
    for at in positions:
        if at is None:
            picked.append(pa.nulls(len(lines), pa.string()))
            continue
        found = parts.values.take(pa.array(offsets[:-1] + at, mask=lengths <= at))
        missing = pc.is_in(found, value_set=pa.array(NULL_TOKENS))
        picked.append(pc.if_else(missing, pa.scalar(None, pa.string()), found))
    return picked


def _lines(block: bytes) -> pa.Array:
    text = pa.array([block.decode("latin-1")], pa.large_string())
    return pc.utf8_rtrim(pc.split_pattern(text, "\n").flatten(), characters="\r").cast(pa.string())


def _whole_lines(blocks: Iterable[bytes]) -> Iterator[pa.Array]:
    """Whole lines without their ends, about a block at a time."""
    rest: list[bytes] = []
    for block in blocks:
        whole, found, tail = block.rpartition(b"\n")
        if found:
            yield _lines(b"".join(rest) + whole)
            rest = []
        if tail:
            rest.append(tail)
    if rest:
        yield _lines(b"".join(rest))


def line_batches(
    blocks: Iterable[bytes], path: str, member: str, member_no: int, names: Sequence[str], sep: str
) -> Iterator[pa.RecordBatch]:
    """Data lines of one member in the columns of :func:`lines_schema`; the first line is the header."""
    at: list[int | None] | None = None
    seen = fields = 0
    for lines in _whole_lines(blocks):
        if at is None:
            header = lines[0].as_py().split(sep)
            at = [header.index(n) if n in header else None for n in names]
            fields = field_mask(header, names)
        numbers = np.arange(seen, seen + len(lines))
        seen += len(lines)
        kept = pc.and_(pc.not_equal(lines, ""), pa.array(numbers > 0))
        lines = lines.filter(kept)
        n = len(lines)
        about = [(path, pa.string()), (member, pa.string()), (member_no, pa.int32())]
        yield pa.RecordBatch.from_arrays(
            [
                *[pa.repeat(pa.scalar(v, kind), n) for v, kind in about],
                pa.array(numbers).filter(kept),
                pa.repeat(pa.scalar(fields, pa.int64()), n),
                *_pick(lines, at, sep),
            ],
            names=["path", "member", "member_no", "line_no", "fields", *names],
        )
