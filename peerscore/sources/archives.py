"""Zip archives of delimited members, expanded to one row per line.

Archives are read member by member (:mod:`.zip_members`), each member by a task
of its own.  Only where a path is out of reach of ranged reads does an archive
come as one binary file, which Spark limits to 2 GB.  The Python here decodes
and splits whole blocks with Arrow; eras and types are resolved by Spark
expressions.
"""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Callable, Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .delimited import SEPARATOR
from .lines import BLOCK_BYTES, field_mask, line_batches, lines_schema
from .zip_members import ZipMembers, file_system, wanted

__all__ = ["LINE_ORDER", "expand_archives", "field_mask", "has_field", "read_archives"]

LINE_ORDER = ("source_priority", "path", "member_no", "line_no")


def _expander(names: list[str], member: str | None, sep: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as archive:
                    for number, name in enumerate(archive.namelist()):
                        if wanted(name, member):
                            with archive.open(name) as raw:
                                yield from line_batches(iter(partial(raw.read, BLOCK_BYTES), b""), path.as_py(), name, number, names, sep)

    return expand


def expand_archives(
    archives: DataFrame, names: Sequence[str], member: str | None = None, sep: str = SEPARATOR
) -> DataFrame:
    """``(path, content)`` rows to one row per data line of every ``.csv`` member, or of one.

    The named fields become text columns, null where a member's header lacks
    them; other fields, and fields beyond the header, are cut.  ``fields``
    says which of up to 63 names the header has (:func:`has_field`).
    """
    return archives.select("path", "content").mapInArrow(_expander(list(names), member, sep), lines_schema(names))


def read_archives(
    spark: SparkSession, path: str | Sequence[str], names: Sequence[str], member: str | None = None, priority: int = 0
) -> DataFrame:
    """Lines of the archives at ``path``, as of :func:`expand_archives`; a lower ``priority`` wins a later keep-first.

    ``path`` is a folder, a pattern or one archive, which is listed at once, or
    a list of archives, which is taken as it is.
    """
    if isinstance(path, str):
        listed = spark.read.format("binaryFile").load(path).select("path").orderBy("path")
        found = [r["path"] for r in listed.toLocalIterator()]
    else:
        found = sorted(path)
    if not found:
        lines = spark.createDataFrame([], lines_schema(names))
    elif all(file_system(p) for p in found):
        spark.dataSource.register(ZipMembers)
        asked = {"paths": json.dumps(found), "names": json.dumps(list(names)), "member": member or "", "sep": SEPARATOR}
        lines = spark.read.format("zip_members").options(**asked).load()
    else:
        lines = expand_archives(spark.read.format("binaryFile").load(found), names, member)
    return lines.withColumn("source_priority", F.lit(priority))


def has_field(name: str, names: Sequence[str]) -> Column:
    """Whether the header of the line's member has the field; ``names`` as given when the line was read."""
    return F.getbit("fields", F.lit(list(names).index(name))) == 1
