"""Language identification by the nearest of several centroids per language.

Texts become TF-IDF vectors of hashed byte n-grams.  Document frequencies cover
every training document; the centroids of a language come from spherical
k-means over a bounded number of its documents.  A text takes the language of
the centroid with the largest cosine; one farther from it than that centroid's
own documents are is marked as rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise

#: Places of the n-gram vector: a power of two.
BITS = 12
SIZE = 1 << BITS
GRAMS = (2, 3, 4)
#: Centroids of a language.
CENTROIDS = 4
#: Documents of a language its centroids are fitted on, at most: the first by hash of doc_id.
PER_LANGUAGE = 1000
#: Added to the documents that pass the bound on the hash, so that enough do for small numbers, too.
_SPARE = 64
ROUNDS = 12
#: Standard deviations below its documents' mean cosine at which a centroid rejects a text.
REJECT = 4.0
UNDETERMINED = "und"
#: Texts whose vectors are held at once.
_BLOCK = 256

_BLANKED = bytes(c if chr(c).isalpha() or c > 127 else 32 for c in range(256))
_LETTER = re.compile(r"[^\W\d_]")


def has_letters(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def counts_of(text: str | None) -> np.ndarray:
    """Counts of the hashed n-grams of a whole text; ASCII other than letters counts as blank."""
    out = np.zeros(SIZE, dtype=np.int64)
    if not text:
        return out
    raw = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(_BLANKED) + b" ", dtype=np.uint8)
    value = raw.astype(np.uint32)
    for n in range(2, max(GRAMS) + 1):
        if len(raw) < n:
            break
        value = (value[:-1] << np.uint32(8)) | raw[n - 1 :]
        if n in GRAMS:
            place = ((value + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(32 - BITS)
            out += np.bincount(place, minlength=SIZE)
    return out


def vectors_of(texts: list[str | None], idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors; a text without n-grams gives a zero vector."""
    x = np.stack([np.log1p(counts_of(t)) for t in texts]).astype(np.float32) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def training(docs: DataFrame) -> DataFrame:
    return docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string"), F.col("lang").cast("string")
    )


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """Smoothed inverse document frequency of each place over all rows; one row per place reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(SIZE + 1, dtype=np.int64)
        for batch in batches:
            for text in batch["text"].to_pylist():
                seen[:-1] += counts_of(text) > 0
                seen[-1] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SIZE + 1, dtype=np.int32)), pa.array(seen)], ["place", "n"])

    rows = docs.select("text").mapInArrow(run, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(SIZE + 1)
    for row in rows:
        found[row["place"]] = row["n"]
    return (np.log((1 + found[-1]) / (1 + found[:-1])) + 1).astype(np.float32)


@dataclass
class Centroids:
    idf: np.ndarray
    languages: list[str]
    matrix: np.ndarray
    floors: np.ndarray

    def predict(self, texts: list[str | None]) -> Iterator[tuple[str, float, bool]]:
        for at in range(0, len(texts), _BLOCK):
            part = texts[at : at + _BLOCK]
            near = vectors_of(part, self.idf) @ self.matrix.T if self.languages else np.zeros((len(part), 0))
            for text, row in zip(part, near):
                if not len(row) or not has_letters(text):
                    yield UNDETERMINED, 0.0, True
                    continue
                best = int(row.argmax())
                yield self.languages[best], float(min(max(row[best], 0.0), 1.0)), bool(row[best] < self.floors[best])


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS) -> Centroids:
    """Centroids from the rows of :func:`training`."""
    rows = training(docs)
    idf = inverse_frequencies(rows)
    # Chosen without their texts, so that only the texts of the chosen ones move: at most ``per_language`` rows for a
    # language, which is what the broadcast holds.  A doc_id that repeats counts once.  A bound on the hash that follows
    # from the number of a language's documents comes first, so no task gets more than about twice as many of a language.
    ids = materialise(rows.select("doc_id", "lang").distinct(), "langid-ids")
    share = F.xxhash64("doc_id") / float(1 << 64) + 0.5
    enough = (2 * per_language + _SPARE) / F.col("_all")
    few = ids.join(ids.groupBy("lang").agg(F.count("*").alias("_all")), "lang").filter(share < enough)
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = few.select("doc_id", "lang").withColumn("_n", F.row_number().over(by_hash)).filter(F.col("_n") <= per_language)
    chosen = rows.join(F.broadcast(picked), ["doc_id", "lang"]).groupBy("doc_id", "lang", "_n").agg(F.min("text").alias("text"))

    def cluster(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["_n", "doc_id"])
        x = vectors_of([t for t in part["text"] if has_letters(t)], idf) if part["text"].map(has_letters).any() else None
        if x is None:
            return pd.DataFrame([], columns=["lang", "number", "centroid", "floor"])
        # Start from the mean, then ever from the text that is least like the centroids so far.
        centres = [x.mean(0)]
        for _ in range(min(centroids, len(x)) - 1):
            centres.append(x[np.max([x @ c / max(np.linalg.norm(c), 1e-12) for c in centres], axis=0).argmin()])
        centre = np.stack(centres)
        for _ in range(ROUNDS):
            centre = centre / np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-12)
            own = (x @ centre.T).argmax(1)
            centre = np.stack([x[own == k].sum(0) if (own == k).any() else centre[k] for k in range(len(centre))])
        centre = centre / np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-12)
        near = x @ centre.T
        own, best = near.argmax(1), near.max(1)
        rows = []
        for k in range(len(centre)):
            mine = best[own == k]
            if len(mine):
                rows.append((part["lang"].iloc[0], k, centre[k].astype(np.float32).tobytes(), float(mine.mean() - REJECT * mine.std())))
        return pd.DataFrame(rows, columns=["lang", "number", "centroid", "floor"])

    # A few rows for each language.
    found = chosen.groupBy("lang").applyInPandas(cluster, "lang string, number int, centroid binary, floor double").toPandas()
    found = found.sort_values(["lang", "number"])
    matrix = np.stack([np.frombuffer(c, dtype=np.float32) for c in found["centroid"]]) if len(found) else np.zeros((0, SIZE), np.float32)
    return Centroids(idf, found["lang"].tolist(), matrix, found["floor"].to_numpy(dtype=np.float64))


def identify(docs: DataFrame, model: Centroids | None = None) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, rejected)``, one row per row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``, and ``lang`` where no model is
    given; other columns are ignored, and only ``text`` bears on a prediction.
    Defined results: null texts and texts without a letter, and all texts where
    nothing could be learned, are ``und`` with score 0 and rejected; a null
    doc_id counts as an empty one; an empty table gives no rows.
    """
    model = model or fit(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(model.predict(batch["text"].to_pylist()))
            columns = [pa.array(c, t) for c, t in zip(zip(*found) if found else [[]] * 3, (pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], *columns], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    asked = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string"))
    return asked.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
