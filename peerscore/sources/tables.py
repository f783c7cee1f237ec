"""Published tables: Parquet, one folder per reference date, switched as a whole.

A date's rows are written to a version folder of their own.  Once they are all
there, an empty marker that names the version is created; readers follow the
marker with the highest number.  So a job that is lost in mid-write, and one
that runs while another reads, leave the old rows in place.  Creating a file is
one step in every file system, renaming is not.  The version before stays for
those who read it already.

:func:`write_by_key` also deals the rows into buckets of a key, so that readers
which join, group or window by that key start without an exchange.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_MARKER = re.compile(r"_current-(\d{9})-(v-[0-9a-f]{32})")
_BUCKETS = re.compile(r"_buckets-(\d{6})")
#: Versions of a date that are kept: the current one and the one before.
KEPT = 2


def table_path(root: str, layer: str, table: str) -> str:
    """The folder of a table; :func:`read_dates` reads it as a whole."""
    return f"{root.rstrip('/')}/{layer}/{table}"


def date_path(root: str, layer: str, table: str, as_of: date) -> str:
    return f"{table_path(root, layer, table)}/as_of={as_of.isoformat()}"


def _folder(spark: SparkSession, path: str):
    """A Hadoop path with its file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    at, system = _folder(spark, path)
    return [f.getPath().getName() for f in system.listStatus(at)] if system.exists(at) else []


def versions(spark: SparkSession, root: str, layer: str, table: str, as_of: date) -> list[tuple[int, str]]:
    """``(number, version folder)`` of the complete versions of a date, the current one last."""
    found = (_MARKER.fullmatch(n) for n in _names(spark, date_path(root, layer, table, as_of)))
    return sorted((int(m[1]), m[2]) for m in found if m)


def _discard_old(spark: SparkSession, path: str, complete: list[tuple[int, str]]) -> None:
    for number, version in complete[:-KEPT]:
        spark.sql(f"DROP TABLE IF EXISTS {_table_of(version)}")
        for name in (f"_current-{number:09d}-{version}", version):
            at, system = _folder(spark, f"{path}/{name}")
            system.delete(at, True)


def write_table(
    df: DataFrame, root: str, layer: str, table: str, as_of: date, order: Sequence[str] = (), by_range: bool = False
) -> str:
    """Replace one reference date of a table, leaving the others; returns the path of the new version.

    ``order`` sorts the rows of each file, so that filters on its first columns
    skip row groups; with ``by_range`` rows are also dealt by range, so that
    whole files are skipped and files in the order of their names are sorted.
    """
    path = date_path(root, layer, table, as_of)
    version = f"v-{uuid.uuid4().hex}"
    if order:
        df = (df.repartitionByRange(*order) if by_range else df).sortWithinPartitions(*order)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(f"{path}/{version}")
    _switch(df.sparkSession, root, layer, table, as_of, version)
    return f"{path}/{version}"


def _switch(spark: SparkSession, root: str, layer: str, table: str, as_of: date, version: str) -> None:
    """Make a version that is there as a whole the current one."""
    path = date_path(root, layer, table, as_of)
    before = versions(spark, root, layer, table, as_of)
    number = before[-1][0] + 1 if before else 1
    _touch(spark, f"{path}/_current-{number:09d}-{version}")
    _discard_old(spark, path, [*before, (number, version)])


def _touch(spark: SparkSession, path: str) -> None:
    at, system = _folder(spark, path)
    system.create(at, False).close()


def _table_of(version: str) -> str:
    """The catalog's name of a version in buckets."""
    return f"by_key_{version.removeprefix('v-')}"


def bucket_count(spark: SparkSession) -> int:
    """As many buckets as an exchange has partitions: with fewer, Spark would exchange both sides of a join."""
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or spark.conf.get("spark.sql.shuffle.partitions"))


def write_by_key(
    df: DataFrame, root: str, layer: str, table: str, as_of: date, key: str, order: Sequence[str], buckets: int | None = None
) -> str:
    """:func:`write_table` with one file per bucket of ``key``, sorted by it and ``order``.

    Rows are exchanged once, here.  ``buckets`` (default :func:`bucket_count`)
    should grow with the table; it stands beside the files, as Parquet has no
    place for it.  All rows of a key share a file, so the key's groups must be
    bounded, as the days of an entity are.
    """
    spark, version = df.sparkSession, f"v-{uuid.uuid4().hex}"
    path, n = f"{date_path(root, layer, table, as_of)}/{version}", buckets or bucket_count(df.sparkSession)
    (
        df.repartition(n, key)
        .write.mode("errorifexists")
        .bucketBy(n, key)
        .sortBy(key, *order)
        .option("compression", "zstd")
        .option("path", path)
        .saveAsTable(_table_of(version))
    )
    _touch(spark, f"{path}/_buckets-{n:06d}")
    _switch(spark, root, layer, table, as_of, version)
    return path


def read_by_key(spark: SparkSession, root: str, layer: str, table: str, as_of: date, key: str, order: Sequence[str]) -> DataFrame:
    """A table of :func:`write_by_key` with its buckets, also in a session that did not write it."""
    path = current_path(spark, root, layer, table, as_of)
    name = _table_of(path.rsplit("/", 1)[1])
    if not spark.catalog.tableExists(name):
        counts = [int(m[1]) for m in map(_BUCKETS.fullmatch, _names(spark, path)) if m]
        if not counts:
            raise ValueError(f"{path} was not written by key")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        sort = ", ".join(f"`{c}`" for c in [key, *order])
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}'"
            f" CLUSTERED BY (`{key}`) SORTED BY ({sort}) INTO {counts[0]} BUCKETS"
        )
    return spark.table(name)


def current_path(spark: SparkSession, root: str, layer: str, table: str, as_of: date) -> str:
    """The current version of one reference date; fails when it was never written as a whole."""
    complete = versions(spark, root, layer, table, as_of)
    if not complete:
        raise FileNotFoundError(f"no complete version of {date_path(root, layer, table, as_of)}")
    return f"{date_path(root, layer, table, as_of)}/{complete[-1][1]}"


def read_table(spark: SparkSession, root: str, layer: str, table: str, as_of: date) -> DataFrame:
    """One reference date of a table; fails when it was never written."""
    return spark.read.parquet(current_path(spark, root, layer, table, as_of))


def read_dates(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    """All reference dates of a table with an ``as_of`` column."""
    path = table_path(root, layer, table)
    days = sorted(date.fromisoformat(n.removeprefix("as_of=")) for n in _names(spark, path) if n.startswith("as_of="))
    current = [current_path(spark, root, layer, table, day) for day in days if versions(spark, root, layer, table, day)]
    return spark.read.option("basePath", path).parquet(*current)


def file_positions(df: DataFrame, alias: str = "position") -> DataFrame:
    """Rows of a Parquet read with their 1-based place, files in the order of their names.

    Only counts per file are summed up in one place.
    """
    placed = df.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = placed.groupBy("_file").agg(F.count("*").alias("_n"))
    lower = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("_file", F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_start"))
    return placed.join(starts, "_file").withColumn(alias, F.col("_start") + F.col("_row") + 1).drop("_file", "_row", "_start")
