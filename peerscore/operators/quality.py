"""Data-quality profiles as long tables, and row counters along a chain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Protocol

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import materialise
from .ranking import average_ranks

REPORT_COLUMNS = ("table", "check", "item", "n", "value", "first_date", "last_date")

# Half-open score buckets (fixed values); the last one takes in 100.
SCORE_BUCKETS = ((0.0, 20.0), (20.0, 40.0), (40.0, 60.0), (60.0, 80.0), (80.0, 100.01))


def _percent(n: Column, rows: Column) -> Column:
    return F.when(rows > 0, n / rows * 100.0).otherwise(F.lit(0.0))


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys (a null key counts as a value) and duplicates."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("distinct_keys"))
        .withColumn("duplicates", F.col("rows") - F.col("distinct_keys"))
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: nulls and their percentage, from one pass; absent columns have null counts."""
    have = [c for c in columns if c in df.columns]
    counted = df.agg(
        F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in have]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                (F.col(f"nulls_{c}") if c in have else F.lit(None)).cast("bigint").alias("nulls"),
            )
            for c in columns
        ]
    )
    return counted.select("rows", F.inline(rows)).select(
        "column", "nulls", F.when(F.col("nulls").isNotNull(), _percent(F.col("nulls"), F.col("rows"))).alias("pct")
    )


def top_duplicates(df: DataFrame, key: str, top: int = 10) -> DataFrame:
    """The most repeated keys with their row counts; ties by key."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > 1)
        .orderBy(F.col("n").desc(), F.col(key).asc_nulls_first())
        .limit(top)
    )


def bucket_label(lo: float, hi: float) -> str:
    return f"{lo:g}-{min(hi, 100.0):g}"


def score_buckets(df: DataFrame, score: str = "score") -> DataFrame:
    """Rows and percentage per fixed bucket, empty buckets included; no scores, no rows."""
    s = F.col(score)
    flags = [F.count_if((s >= lo) & (s < hi)).alias(bucket_label(lo, hi)) for lo, hi in SCORE_BUCKETS]
    counted = df.filter(s.isNotNull()).agg(F.count("*").alias("rows"), *flags).filter(F.col("rows") > 0)
    rows = F.array(
        *[
            F.struct(F.lit(bucket_label(*b)).alias("bucket"), F.col(bucket_label(*b)).alias("n"))
            for b in SCORE_BUCKETS
        ]
    )
    return counted.select("rows", F.inline(rows)).select(
        "bucket", "n", _percent(F.col("n"), F.col("rows")).alias("pct")
    )


def median_of(df: DataFrame, value: str) -> Column:
    """Scalar: the exact median of a column of any size, from the values' ranks."""
    ranks = average_ranks(df, value)
    half = (F.col("n") - 1) / 2

    def at(position: Column) -> Column:
        covers = (F.col("avg_rank") - half <= position) & (position <= F.col("avg_rank") + half)
        return F.max(F.when(covers, F.col("value")))

    lower, upper = F.floor((F.col("total") + 1) / 2), F.floor(F.col("total") / 2) + 1
    return ranks.agg(((at(lower) + at(upper)) / 2).alias("median")).scalar()


def score_summary(df: DataFrame, score: str = "score") -> DataFrame:
    """One row: count, min, median, mean and max; no scores, no rows."""
    return (
        df.agg(F.count(score).alias("n"), F.min(score).alias("min"), F.avg(score).alias("mean"), F.max(score).alias("max"))
        .filter(F.col("n") > 0)
        .withColumn("median", median_of(df, score))
        .select("n", "min", "median", "mean", "max")
    )


def series_coverage(wide: DataFrame, columns: Sequence[str], date: str = "data") -> DataFrame:
    """Per series column: non-null rows, first and last date; empty series included."""
    seen = {c: F.when(F.col(c).isNotNull(), F.col(date)) for c in columns}
    counted = wide.agg(
        *[
            F.struct(
                F.lit(c).alias("series"),
                F.count(d).alias("n"),
                F.min(d).alias("first_date"),
                F.max(d).alias("last_date"),
            ).alias(c)
            for c, d in seen.items()
        ]
    )
    return counted.select(F.inline(F.array(*columns)))


def _report(df: DataFrame, table: str, check: str, **cols: Column) -> DataFrame:
    types = {"item": "string", "n": "bigint", "value": "double", "first_date": "date", "last_date": "date"}
    return df.select(
        F.lit(table).alias("table"),
        F.lit(check).alias("check"),
        *[cols.get(c, F.lit(None)).cast(t).alias(c) for c, t in types.items()],
    )


def profile_table(
    df: DataFrame, table: str, keys: Sequence[str], null_columns: Sequence[str], top: int = 10
) -> DataFrame:
    """Key counts, nulls per column and, for a single key, its top duplicates, from one scan and one exchange.

    Rows and nulls are counted by key, and all figures follow from these counts.
    A key's counts are one struct, so the totals and the top duplicates, which
    need different ones, read the same exchange.
    """
    have = [c for c in null_columns if c in df.columns]
    counts = F.struct(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(have)])
    by_key = df.groupBy(*keys).agg(counts.alias("counts")).filter(F.col("counts.n") > 0)
    total = lambda name: F.coalesce(F.sum(f"counts.{name}"), F.lit(0))
    totals = by_key.agg(total("n").alias("rows"), F.count("*").alias("distinct_keys"), *[total(f"nulls_{i}").alias(f"nulls_{i}") for i in range(len(have))])

    def line(check: str, item: str, n: Column, value: Column) -> Column:
        return F.struct(F.lit(check).alias("check"), F.lit(item).alias("item"), n.cast("bigint").alias("n"), value.cast("double").alias("value"))

    rows, distinct, none = F.col("rows"), F.col("distinct_keys"), F.lit(None)
    lines = [line("keys", "rows", rows, none), line("keys", "distinct_keys", distinct, none), line("keys", "duplicates", rows - distinct, none)]
    for c in null_columns:
        nulls = F.col(f"nulls_{have.index(c)}") if c in have else none
        lines.append(line("nulls", c, nulls, _percent(nulls, rows) if c in have else none))
    found = totals.select(F.inline(F.array(*lines)))
    if len(keys) == 1:
        most = by_key.filter(F.col("counts.n") > 1).orderBy(F.col("counts.n").desc(), F.col(keys[0]).asc_nulls_first()).limit(top)
        found = found.unionByName(
            most.select(F.lit("top_duplicates").alias("check"), F.col(keys[0]).cast("string").alias("item"), F.col("counts.n").alias("n"), none.cast("double").alias("value"))
        )
    dates = [F.lit(None).cast("date").alias(c) for c in ("first_date", "last_date")]
    return found.select(F.lit(table).alias("table"), "check", "item", "n", "value", *dates)


def profile_scores(df: DataFrame, table: str, score: str = "score") -> DataFrame:
    stats = score_summary(df, score).unpivot(["n"], ["min", "median", "mean", "max"], "item", "value")
    return _report(stats, table, "score", item=F.col("item"), n=F.col("n"), value=F.col("value")).unionByName(
        _report(
            score_buckets(df, score), table, "score_bucket",
            item=F.col("bucket"), n=F.col("n"), value=F.col("pct"),
        )
    )


def profile_series(wide: DataFrame, table: str, columns: Sequence[str], date: str = "data") -> DataFrame:
    total = wide.agg(F.count("*").alias("n"), F.min(date).alias("lo"), F.max(date).alias("hi"))
    return _report(
        total, table, "date_range", n=F.col("n"), first_date=F.col("lo"), last_date=F.col("hi")
    ).unionByName(
        _report(
            series_coverage(wide, columns, date), table, "coverage",
            item=F.col("series"), n=F.col("n"), first_date=F.col("first_date"), last_date=F.col("last_date"),
        )
    )


def lineage(
    df: DataFrame, table: str, cut: Column, keys: Sequence[str], date: str, distinct: Mapping[str, str]
) -> DataFrame:
    """One row: rows read, left by the cut, and left by keep-first on ``keys``, with the dates and distinct counts left.

    Rows and dates are observed on the job that takes the distinct counts, so
    all come from one scan, run at once.
    """
    read, seen_read = observe_step(df, f"{table}: read")
    left, seen_cut = observe_step(read.filter(cut), f"{table}: cut", F.min(date).alias("first_day"), F.max(date).alias("last_day"))
    counted = left.agg(F.count_distinct(F.struct(*keys)).alias("rows_kept"), *[F.count_distinct(c).alias(name) for name, c in distinct.items()])
    counts = materialise(counted, "lineage")
    rows_read, cut_counts = observed(seen_read), observed(seen_cut)
    rows_cut = F.lit(cut_counts.get("rows", 0)).cast("bigint")
    return counts.select(
        F.lit(table).alias("table"), F.lit(rows_read.get("rows", 0)).cast("bigint").alias("rows_read"), rows_cut.alias("rows_cut"), "rows_kept",
        (rows_cut - F.col("rows_kept")).alias("duplicates"),
        *[F.lit(cut_counts.get(day)).cast("date").alias(day) for day in ("first_day", "last_day")], *distinct,
    )


def observe_step(df: DataFrame, step: str, *metrics: Column) -> tuple[DataFrame, Observation]:
    """Row counter (and further aggregates) that ride on whatever job runs ``df``."""
    seen = Observation(step)
    return df.observe(seen, F.count("*").alias("rows"), *metrics), seen


def observed(seen: Observation) -> dict[str, object]:
    """What was observed once the job has run; nothing where Spark left the step out, as one beside an empty table."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


class Watch(Protocol):
    """Counts the rows of a builder's step, and gives the frame to go on with."""

    def __call__(self, df: DataFrame, step: str, date: str | None = None, **metrics: Column) -> DataFrame: ...


def unwatched(df: DataFrame, step: str, date: str | None = None, **metrics: Column) -> DataFrame:
    return df


class StepCounts:
    """Counters of the steps of all tables of a run; they ride on the jobs that write the tables."""

    def __init__(self) -> None:
        self._seen: list[tuple[str, str, Observation]] = []

    def of(self, table: str) -> Watch:
        def watch(df: DataFrame, step: str, date: str | None = None, **metrics: Column) -> DataFrame:
            dates = [F.min(date).cast("date").alias("first_date"), F.max(date).cast("date").alias("last_date")] if date else []
            out, seen = observe_step(df, f"{table}: {step}", *dates, *[m.alias(name) for name, m in metrics.items()])
            self._seen.append((table, step, seen))
            return out

        return watch

    def report(self, spark: SparkSession) -> DataFrame:
        """Report rows, once the jobs have run: a step's rows and dates, and its further counts as ``step: count``."""
        rows = []
        for table, step, seen in self._seen:
            found = observed(seen)
            rows.append((table, "step", step, found.pop("rows", None), found.pop("first_date", None), found.pop("last_date", None)))
            rows += [(table, "step", f"{step}: {name}", n, None, None) for name, n in found.items()]
        counts = spark.createDataFrame(rows, "table string, check string, item string, n long, first_date date, last_date date")
        return counts.withColumn("value", F.lit(None).cast("double")).select(*REPORT_COLUMNS)
