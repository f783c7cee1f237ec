"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other.  The model of a category sees
the words of a text and the probabilities of the categories before it.  In
training those are out-of-fold predictions, so a later model learns how far to
trust an earlier one on texts that one has not seen.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gives_back, materialise

#: Labelled rows the chain is trained on, at most: the first by hash of doc_id.
TRAINING_ROWS = 20_000
#: Words the models may use, at most: those whose share differs most between toxic and other training texts, ...
VOCABULARY = 128
#: ... if it differs by this many standard errors.
LEAST_Z = 5.0
FOLDS = 4
THRESHOLD = 0.5
#: Weight of the L1 penalty, as a share of the training rows.
PENALTY = 2e-4

# Seed words that tell a labelled toxic text's kind of toxicity.  The final category needs none of them.
INSULT = ("idiot", "moron", "stupid", "clown", "loser", "fool", "dumb", "imbecile")
CONTEMPT = ("trash", "scum", "worthless", "pathetic", "disgusting", "garbage", "vermin", "filth")
_PUNCTUATION = ".,;:!?\"'()[]{}*#$%&|<>-_/\\`~"
#: Lengths of the beginnings of words that count as features.
PREFIXES = (5, 7)
#: Categories in the order of the chain.
CATEGORIES = ("insult", "contempt", "toxic")


def words_of(text: str | None) -> set[str]:
    """Distinct lower-case words of a whole text, without the punctuation around them."""
    return {w.strip(_PUNCTUATION) for w in text.lower().split()} if text else set()


def features_of(words: set[str]) -> set[str]:
    """Words, their beginnings (``5:``, ``7:``), and beginnings that two different words share (``5+:``).

    Beginnings stand for the inflected and compound forms of a word.
    """
    found = set(words)
    for n in PREFIXES:
        heads = [w[:n] for w in words if len(w) >= n]
        distinct = set(heads)
        found.update(f"{n}:{h}" for h in distinct)
        if n == PREFIXES[0] and len(distinct) < len(heads):
            found.update(f"{n}+:{h}" for h, c in Counter(heads).items() if c > 1)
    return found


class Features:
    """The chosen features of texts, looked up without making all others."""

    def __init__(self, names: list[str]) -> None:
        self.names = names
        self.words = {f: i for i, f in enumerate(names) if ":" not in f}
        self.heads = {n: {f.split(":", 1)[1]: i for i, f in enumerate(names) if f.startswith(f"{n}:")} for n in PREFIXES}
        self.pairs = {f.split(":", 1)[1]: i for i, f in enumerate(names) if f.startswith(f"{PREFIXES[0]}+:")}

    def matrix(self, texts: list[str | None]) -> np.ndarray:
        x = np.zeros((len(texts), len(self.names)))
        for row, text in enumerate(texts):
            words = words_of(text)
            found = [self.words[w] for w in words & self.words.keys()]
            for n, heads in self.heads.items():
                if heads:
                    found.extend({heads[h] for w in words if (h := w[:n]) in heads and len(w) >= n})
            if self.pairs:
                n = PREFIXES[0]
                met = Counter(h for w in words if (h := w[:n]) in self.pairs)
                found.extend(self.pairs[h] for h, c in met.items() if c > 1)
            x[row, found] = 1
        return x


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def copy_key(words: set[str]) -> str:
    """Equal for most near copies: the least words of a text under three hash functions."""
    coded = [w.encode() for w in words]
    return "/".join(str(min((zlib.crc32(w, salt) for w in coded), default=0)) for salt in (1, 2, 3))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY, rounds: int = 400) -> tuple[np.ndarray, float]:
    """L1-penalised logistic regression by accelerated proximal gradient steps; equal rows are fitted as one with a weight."""
    n, d = x.shape
    if not n:
        return np.zeros(d), -30.0  # nothing is known to be toxic
    both, counts = np.unique(np.column_stack([x, y]), axis=0, return_counts=True)
    share = counts / n
    full, y = np.column_stack([both[:, :-1], np.ones(len(both))]), both[:, -1]
    rate = min(max(float(share @ y), 1e-3), 1 - 1e-3)
    w = np.zeros(d + 1)
    w[-1] = np.log(rate / (1 - rate))
    # The largest eigenvalue of the Gram matrix, by power iteration, bounds the curvature.
    gram = full.T @ (full * share[:, None])
    v = np.ones(d + 1)
    for _ in range(30):
        v = gram @ v
        v /= np.linalg.norm(v)
    step = 3.6 / np.linalg.norm(gram @ v)
    ahead, momentum = w.copy(), 1.0
    for _ in range(rounds):
        moved = ahead - step * (full.T @ (share * (_sigmoid(full @ ahead) - y)))
        moved[:-1] = np.sign(moved[:-1]) * np.maximum(np.abs(moved[:-1]) - step * penalty, 0)
        after = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        ahead = moved + (momentum - 1) / after * (moved - w)
        w, momentum = moved, after
    return w[:-1], float(w[-1])


@dataclass
class Chain:
    """Models in the order of their categories; a model's last weights belong to earlier probabilities."""

    features: Features
    models: list[tuple[np.ndarray, float]] = field(default_factory=list)

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        x = self.features.matrix(texts)
        out = np.zeros((len(texts), len(self.models)))
        for n, (weights, bias) in enumerate(self.models):
            own = x.shape[1]
            out[:, n] = _sigmoid(x @ weights[:own] + out[:, :n] @ weights[own:] + bias)
        return out


def fit_chain(features: Features, x: np.ndarray, labels: np.ndarray, folds: int = FOLDS) -> Chain:
    """A chain over the columns of ``labels``; rows are dealt to folds by turn."""
    chain = Chain(features)
    fold = np.arange(len(x)) % folds
    for n in range(labels.shape[1]):
        y = labels[:, n].astype(np.float64)
        held_out = np.zeros(len(x))
        for f in range(folds):
            weights, bias = fit_logistic(x[fold != f], y[fold != f])
            held_out[fold == f] = _sigmoid(x[fold == f] @ weights + bias)
        chain.models.append(fit_logistic(x, y))
        x = np.column_stack([x, held_out])
    return chain


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS) -> DataFrame:
    """``(doc_id, text, toxic)`` of at most ``limit`` labelled rows, the first by hash of doc_id."""
    marked = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").select(F.col("doc_id").alias("_doc"), F.col("toxic").cast("int").alias("_toxic"))
    picked = marked.orderBy(F.xxhash64("_doc"), "_doc", "_toxic").limit(limit)
    texts = docs.filter(F.col("text").isNotNull()).select("doc_id", "text")
    # ``limit`` numbers bound what the broadcast holds; the texts stay where they are read.
    return texts.join(F.broadcast(picked), texts["doc_id"] == F.col("_doc")).select("doc_id", F.col("text").cast("string"), F.col("_toxic").alias("toxic"))


def chosen_features(rows: DataFrame, most: int = VOCABULARY, least_z: float = LEAST_Z) -> list[str]:
    """Features of ``rows (features, toxic)`` whose share differs most between toxic and other rows, by a two-proportion z-score."""
    totals = rows.agg(F.sum((F.col("toxic") > 0).cast("long")).alias("n1"), F.sum((F.col("toxic") <= 0).cast("long")).alias("n0")).first()
    n1, n0 = max(totals["n1"] or 0, 1), max(totals["n0"] or 0, 1)
    counts = rows.select(F.explode("features").alias("feature"), "toxic").groupBy("feature").agg(
        F.sum((F.col("toxic") > 0).cast("long")).alias("c1"), F.sum((F.col("toxic") <= 0).cast("long")).alias("c0")
    )
    pooled = (F.col("c1") + F.col("c0")) / (n1 + n0)
    spread = F.sqrt(F.greatest(pooled * (1 - pooled), F.lit(1e-9)) * (1 / n1 + 1 / n0))
    z = F.abs(F.col("c1") / n1 - F.col("c0") / n0) / spread
    best = counts.filter((F.col("feature") != "") & (F.col("c1") + F.col("c0") >= 3)).withColumn("z", z).filter(F.col("z") >= least_z)
    return [r["feature"] for r in best.orderBy(F.col("z").desc(), "feature").limit(most).collect()]


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS) -> Chain:
    """The chain for :data:`CATEGORIES`; only labelled toxic texts count for a kind of toxicity."""

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [words_of(t) for t in batch["text"].to_pylist()]
            columns = [batch["doc_id"], pa.array([sorted(features_of(w)) for w in words], pa.list_(pa.string()))]
            columns += [pa.array([copy_key(w) for w in words], pa.string()), batch["toxic"]]
            columns += [pa.array([not w.isdisjoint(seeds) for w in words]) for seeds in (INSULT, CONTEMPT)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "features", "key", "toxic", "insult", "contempt"])

    kinds = "doc_id long, features array<string>, key string, toxic int, insult boolean, contempt boolean"
    every = materialise(training_rows(docs, labels, limit).mapInArrow(gives_back(featured), kinds), "toxicity-training")
    # Of near copies one counts, lest the words of a text that was copied often look like signs of its label.
    first = every.groupBy("key").agg(F.min(F.struct("doc_id", "toxic")).alias("first")).select("key", "first.*").distinct()
    rows = materialise(every.join(first, ["key", "doc_id", "toxic"]).dropDuplicates(["key"]), "toxicity-rows")
    features = Features(chosen_features(rows))
    place = {name: i for i, name in enumerate(features.names)}

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[place[f] for f in own if f in place] for own in batch["features"].to_pylist()]
            columns = [batch[c] for c in ("doc_id", "toxic", "insult", "contempt")] + [pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "toxic", "insult", "contempt", "found"])

    # The places of the features in each training row; both numbers are bounded.
    small = rows.mapInArrow(gives_back(coded), "doc_id long, toxic int, insult boolean, contempt boolean, found array<int>")
    held = small.orderBy("doc_id", "toxic").limit(limit).toPandas()
    x = np.zeros((len(held), len(place)))
    for row, found in enumerate(held["found"]):
        x[row, np.asarray(found, dtype=np.int64)] = 1
    toxic = held["toxic"].to_numpy(dtype=np.int64) > 0
    marks = [held[kind].to_numpy(dtype=bool) & toxic for kind in CATEGORIES[:-1]]
    return fit_chain(features, x, np.column_stack([*marks, toxic]))


def score(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``p_<category>`` for each category and ``is_toxic``; these replace columns of the same names.

    Defined results: null and empty texts are scored as texts without words.
    """
    names = [f"p_{c}" for c in CATEGORIES]
    kept = [c for c in docs.columns if c not in (*names, "is_toxic")]
    plain = docs.select(*kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = chain.probabilities(batch.column(len(kept)).to_pylist())
            columns = [batch[c] for c in kept]
            columns += [pa.array(p[:, n]) for n in range(len(names))] + [pa.array(p[:, -1] >= threshold)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *names, "is_toxic"])

    schema = plain.schema
    for name in names:
        schema = schema.add(name, "double")
    text = "_text"
    while text in docs.columns:
        text += "_"
    return plain.withColumn(text, F.col("text").cast("string")).mapInArrow(gives_back(run), schema.add("is_toxic", "boolean"))


def without_toxic(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the chain does not reject; null and empty texts stay."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(chain.probabilities(batch.column(at).to_pylist())[:, -1] < threshold))

    return docs.mapInArrow(gives_back(run), docs.schema)


def classify(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, p_insult, p_contempt, p_toxic, is_toxic)``, one row per row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``, ``labels`` ``doc_id`` and ``toxic``;
    other columns are ignored.  Defined results: unlabelled documents and null
    labels take no part in training; a document labelled several times counts
    each time; without any label every probability is next to zero and nothing
    is toxic; an empty table gives no rows.
    """
    chain = train(docs, labels, limit)
    return score(docs.select("doc_id", "text"), chain, threshold).drop("text")
