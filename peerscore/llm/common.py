"""Helpers the operators of this package share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import discard, materialise, scratch_path

__all__ = ["WORD", "discard", "drop_worker_caches", "give_back", "gives_back", "materialise", "running_total", "scratch_path", "table", "worker_cache"]

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


#: Dictionaries that this worker process keeps from task to task.
_WORKER_CACHES: list[dict] = []


def worker_cache() -> dict:
    """A dictionary that outlives a task, until :func:`drop_worker_caches`."""
    _WORKER_CACHES.append({})
    return _WORKER_CACHES[-1]


def drop_worker_caches() -> None:
    """Called where a task of an operator without such a cache begins: Spark uses its workers again, whatever they hold."""
    if any(_WORKER_CACHES):
        for cache in _WORKER_CACHES:
            cache.clear()
        give_back()


def give_back() -> None:
    """Returns to the system what this worker has freed: workers stay, and their allocators keep what they once held."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


_T = TypeVar("_T")


def gives_back(run: Callable[[Iterator[_T]], Iterator[_T]], keeps: bool = False) -> Callable[[Iterator[_T]], Iterator[_T]]:
    """A function for ``mapInArrow`` whose tasks leave no freed memory with their worker and, unless it ``keeps`` them, find no caches there."""

    @wraps(run)
    def task(batches: Iterator[_T]) -> Iterator[_T]:
        if not keeps:
            drop_worker_caches()
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def running_total(df: DataFrame, order: list[Column], size: str, alias: str, label: str) -> DataFrame:
    """``df`` with ``alias``: the sum of ``size`` over all rows that come before in ``order``.

    Rows are dealt by range of ``order`` and written with the number of their
    range, so a hot key is spread over many ranges.  Totals per range (one row
    each) are summed up, and each range adds its own running sum.  Rows equal in
    ``order`` share a range; their own sequence follows ``order`` as given, which
    should therefore tell rows apart.
    """
    ranged = materialise(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), label
    )
    totals = ranged.groupBy("_range").agg(F.sum(size).alias("_n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.withColumn("_inside", F.coalesce(F.sum(size).over(inside), F.lit(0)))
        .join(F.broadcast(starts), "_range")
        .withColumn(alias, F.col("_start") + F.col("_inside"))
        .drop("_range", "_start", "_inside")
    )
