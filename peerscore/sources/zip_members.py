"""Members of zip archives as a data source of Spark: one partition per member.

The planner reads the archives' directories, a task the bytes of its member
only, both by ranged reads.  So an archive of any size is read by as many tasks
as it has members, and a task holds one block of text at a time.
"""

from __future__ import annotations

import json
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from .lines import BLOCK_BYTES, line_batches, lines_schema

#: Archives whose directories are read at the same time.
_PLANNERS = 16
#: Bytes of a member's own header before its name.
_HEADER = struct.Struct("<4s2xHH16xHH")
_ENCRYPTED = 1
_SCHEME = re.compile(r"([A-Za-z][A-Za-z0-9+.-]*):(//([^/]*))?(/.*)")
#: Schemes of Hadoop -> of Arrow.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "hdfs": "hdfs", "s3": "s3", "gs": "gs", "abfss": "abfss"}


def file_system(path: str) -> tuple[fs.FileSystem, str] | None:
    """Who can read byte ranges of a path, and its name there; none where only Spark's own readers reach it."""
    found = _SCHEME.fullmatch(path)
    if found is None or found[1] == "file":
        return fs.LocalFileSystem(), path if found is None else found[4]
    if found[1] not in _SCHEMES:
        return None
    root, base = fs.FileSystem.from_uri(f"{_SCHEMES[found[1]]}://{found[3] or ''}/")
    return root, base.rstrip("/") + found[4]


def open_ranges(path: str) -> pa.NativeFile:
    found = file_system(path)
    if found is None:
        raise ValueError(f"no ranged reads from {path}")
    return found[0].open_input_file(found[1])


@dataclass(frozen=True)
class Member(InputPartition):
    """Where a member lies: ``offset`` of its header, ``size`` of its packed bytes."""

    path: str
    name: str
    number: int
    offset: int
    size: int
    method: int
    crc: int


def wanted(name: str, member: str | None) -> bool:
    """The one member asked for, or every ``.csv``."""
    return name == member if member else name.lower().endswith(".csv")


def members_of(path: str, member: str | None = None) -> list[Member]:
    """Members of an archive to be read, from its directory."""
    with open_ranges(path) as raw, zipfile.ZipFile(raw) as archive:
        out = []
        for number, info in enumerate(archive.infolist()):
            if not wanted(info.filename, member):
                continue
            if info.flag_bits & _ENCRYPTED or info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
                raise ValueError(f"{path}: member {info.filename} is encrypted or packed in a way that is not supported")
            out.append(Member(path, info.filename, number, info.header_offset, info.compress_size, info.compress_type, info.CRC))
        return out


def blocks_of(member: Member) -> Iterator[bytes]:
    """Text of a member, at most ``BLOCK_BYTES`` at a time; a wrong checksum is an error."""
    crc = 0
    with open_ranges(member.path) as raw:
        raw.seek(member.offset)
        mark, _, _, name, extra = _HEADER.unpack(raw.read(_HEADER.size))
        if mark != b"PK\x03\x04":
            raise ValueError(f"{member.path}: no member at {member.offset}")
        raw.seek(member.offset + _HEADER.size + name + extra)
        left = member.size
        unpack = zlib.decompressobj(-zlib.MAX_WBITS)
        while left:
            packed = raw.read(min(BLOCK_BYTES, left))
            if not packed:
                raise ValueError(f"{member.path}: {member.name} ends early")
            left -= len(packed)
            if member.method == zipfile.ZIP_STORED:
                crc = zlib.crc32(packed, crc)
                yield packed
                continue
            while packed:
                block = unpack.decompress(packed, BLOCK_BYTES)
                packed = unpack.unconsumed_tail
                crc = zlib.crc32(block, crc)
                yield block
        if member.method == zipfile.ZIP_DEFLATED:
            block = unpack.flush()
            crc = zlib.crc32(block, crc)
            yield block
    if crc != member.crc:
        raise ValueError(f"{member.path}: {member.name} does not have its checksum")


class ZipReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.paths: list[str] = json.loads(options["paths"])
        self.names: list[str] = json.loads(options["names"])
        self.member = options.get("member") or None
        self.sep = options["sep"]

    def partitions(self) -> list[Member]:
        with ThreadPoolExecutor(_PLANNERS) as pool:
            found = [m for of_one in pool.map(lambda p: members_of(p, self.member), self.paths) for m in of_one]
        # Large ones first, so that none begins when the others have ended; one without a path stands for no member at all.
        return sorted(found, key=lambda m: -m.size) or [Member("", "", 0, 0, 0, 0, 0)]

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        if partition.path:
            yield from line_batches(blocks_of(partition), partition.path, partition.name, partition.number, self.names, self.sep)


class ZipMembers(DataSource):
    """``spark.read.format("zip_members")`` with the options ``paths`` and ``names`` (JSON lists), ``sep`` and, for one member, ``member``."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return lines_schema(json.loads(self.options["names"]))

    def reader(self, schema: StructType) -> ZipReader:
        return ZipReader(self.options)
