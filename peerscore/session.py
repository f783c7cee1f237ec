"""Session defaults and the shared scratch area."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession

# Runtime SQL settings every job here wants.  They are only defaults: values
# the cluster sets in its own configuration come first.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    # Split a hot join partition even when that costs one more exchange later.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}


# Rows a task of `spread` holds on average: some 100 bytes each in a hash map or a sort.
ROWS_PER_TASK = 500_000

# Scratch paths given out in the current context, where someone records them.
_RECORD: ContextVar[list[str] | None] = ContextVar("scratch", default=None)

# Application -> its scratch folder, in local mode without the setting.
_LOCAL_ROOTS: dict[str, str] = {}


def build_session(app_name: str = "peerscore", master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`SESSION_DEFAULTS`; ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in SESSION_DEFAULTS.items():
        builder = builder.config(name, value)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the setting is absent in local mode, where executors and driver are one process, it is set once to a
    folder of its own; on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    made = _LOCAL_ROOTS.get(spark.sparkContext.applicationId)
    if made is None:
        made = _LOCAL_ROOTS[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="spark-peerscore-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
    return made


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the scratch area."""
    path = f"{scratch_root(spark)}/peerscore/{label}-{uuid.uuid4().hex}"
    made = _RECORD.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def recorded_scratch(made: list[str]) -> Iterator[None]:
    """Adds to ``made`` the scratch paths that are given out inside, for :func:`remove` once nothing reads them."""
    before = _RECORD.set(made)
    try:
        yield
    finally:
        _RECORD.reset(before)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch paths."""
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a Parquet table and read it back.

    Used where a table is read by several later branches: it is computed once,
    its lineage ends at files that outlive any executor, and the readers prune
    columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, keys: Sequence[Column | str], rows: int) -> DataFrame:
    """``df``, of about ``rows`` rows, exchanged by ``keys`` into as many partitions as keep a task's rows bounded.

    Exchanges that Spark plans have the session's number of partitions at most, and adaptive execution merges them by
    compressed bytes and cores; with nearly unique keys a task's hash map or sort would then grow with the table.
    Groupings and joins on ``keys`` that follow need no other exchange.
    """
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, math.ceil(rows / ROWS_PER_TASK)), *keys)


def discard(df: DataFrame) -> None:
    """Delete the scratch files behind a table of :func:`materialise` that nothing reads any more."""
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    remove(df.sparkSession, [f for f in folders if "/peerscore/" in f])
