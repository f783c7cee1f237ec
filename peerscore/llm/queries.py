"""One query for each operator of this package, over its whole table, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bitplanes, hamming, html_text, langid, lexical, licenses, mixing, packing, simhash, suffix, token_counts, toxicity
from .common import table


def op1_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_exact_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming.search(table(spark, sf_dir, "embeddings"))


HAMMING_SQL = """WITH codes AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x > 0 AS INTEGER)) AS code FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.code, c.code), lambda z: CAST(z[1] <> z[2] AS INTEGER))) AS INTEGER) AS distance
  FROM codes q JOIN codes c ON c.vec_id <> q.vec_id AND len(c.code) = len(q.code) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM pairs) WHERE rank <= 10"""


def op6_mix_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.withColumn("first_position", F.round("first_position", 6))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents"))


def op9_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_bitplane_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplanes.cluster(table(spark, sf_dir, "embeddings"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# Name -> (callable(spark, sf_dir), SQL or None).
QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_projected_neighbours": (op1_projected_neighbours, None),
    "op2_best_fit_packing": (op2_best_fit_packing, None),
    "op3_license_scan": (op3_license_scan, licenses.scan_sql()),
    "op4_html_main_text": (op4_html_main_text, None),
    "op5_exact_hamming_topk": (op5_exact_hamming_topk, HAMMING_SQL),
    "op6_mix_to_weights": (op6_mix_to_weights, mixing.mix_sql()),
    "op7_simhash_near_dedup": (op7_simhash_near_dedup, None),
    "op8_suffix_array_dedup": (op8_suffix_array_dedup, suffix.remove_repeats_sql()),
    "op9_toxicity_chain": (op9_toxicity_chain, None),
    "op10_language_centroids": (op10_language_centroids, None),
    "op11_bitplane_kmeans": (op11_bitplane_kmeans, bitplanes.cluster_sql()),
    "op12_token_counts": (op12_token_counts, None),
    "op13_lexical_search": (op13_lexical_search, lexical.search_sql()),
}
