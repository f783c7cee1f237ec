"""A training-data pipeline over ``documents``.

Each stage gets what the stage before it kept, written as Parquet and read
again; all but the last return the columns of ``documents``.

1. toxicity: documents the classifier chain rejects go.
2. near_duplicates: of each group of SimHash near-duplicates one document stays.
3. repeated_strings: bytes covered by strings of 50 bytes that an earlier document holds go.
4. mixture: documents are taken, some twice, to the target weights of their sources, in curriculum order.
5. packing: token ids are packed into sequences of 2048.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscore.llm import mixing, packing, simhash, suffix, toxicity
from peerscore.llm.common import materialise, table
from peerscore.session import recorded_scratch, remove


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def drop_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``n_chars`` follows the text."""
    left = suffix.shortened(docs)
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else left


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


# Scratch tables behind the stage that ran last, by application.
_LAST_STAGE: dict[str, list[str]] = {}


#: Rows that pass between Spark and Python at once, if the session says nothing else.  Both sides hold the texts of a batch,
#: in memory outside the heap that is kept for later batches; of Spark's own 10,000 rows those are some 20 MB each time.
BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def tidy(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that first deletes the scratch tables of the one before it.

    A stage begins when the one before has been written, so nothing reads them any more.
    """

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        made = _LAST_STAGE.pop(app, [])
        suffix.forget(spark, made)
        remove(spark, made)
        made = _LAST_STAGE[app] = []
        # For the session, as what a stage returns is computed after it.
        if _BATCH not in spark.conf.getAll:
            spark.conf.set(_BATCH, BATCH_ROWS)
        with recorded_scratch(made):
            return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("toxicity", tidy(drop_toxic)),
    ("near_duplicates", tidy(drop_near_duplicates)),
    ("repeated_strings", tidy(drop_repeated_strings)),
    ("mixture", tidy(mix_sources)),
    ("packing", tidy(pack_sequences)),
]

#: Trained models, hashes of shingles and token ids are beyond SQL; a test compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what the stages keep of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
