"""Tolerant delimited text."""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import NULL_TOKENS, null_tokens

ENCODING = "ISO-8859-1"
SEPARATOR = ";"
ORDER_COLUMN = "_source_order"

# A character no line holds, so that a line is read as one field.
_NO_SEPARATOR = "\x01"


def _csv(spark: SparkSession, sep: str, encoding: str, header: bool):
    return (
        spark.read.option("header", header)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("quote", "")
        .option("inferSchema", False)
        .option("mode", "PERMISSIVE")
    )


def files_by_header(spark: SparkSession, path: str | list[str], encoding: str = ENCODING) -> dict[str, list[str]]:
    """Header line -> files that have it: one row per file reaches the driver, as with any file listing."""
    lines = _csv(spark, _NO_SEPARATOR, encoding, header=False).schema("line string").csv(path)
    first = (
        lines.select("line", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
        .filter(F.col("start") == 0)
        .withColumn("at", F.monotonically_increasing_id())
        .groupBy("file")
        .agg(F.min_by("line", "at").alias("header"))
    )
    found = defaultdict(list)
    for row in first.orderBy("file").collect():
        found[row["header"]].append(row["file"])
    return dict(found)


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str = SEPARATOR,
    encoding: str = ENCODING,
    tokens: tuple[str, ...] = NULL_TOKENS,
    keep_order: bool = False,
    one_header: bool = False,
) -> DataFrame:
    """All columns as text, no quoting; extra fields are cut, short rows padded with nulls.

    Fields are matched by the header of their own file, so files may differ in
    the order and the set of columns; a column a file lacks is null.
    ``one_header`` says that all files share one, which saves the look at them.
    ``keep_order`` adds a struct that sorts rows as they lie in the files, for
    a later keep-first.
    """
    groups = [path] if one_header else list(files_by_header(spark, path, encoding).values())
    if len(groups) == 1:
        groups = [path]

    def read(files: str | list[str]) -> DataFrame:
        raw = _csv(spark, sep, encoding, header=True).csv(files)
        cols = [null_tokens(F.col(f"`{c}`"), tokens).alias(c) for c in raw.columns]
        if keep_order:
            # Within one file block the id grows in reading order.
            cols.append(
                F.struct(
                    F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"),
                ).alias(ORDER_COLUMN)
            )
        return raw.select(*cols)

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(read, groups or [path]))
