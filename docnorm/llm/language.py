"""Language identification by nearest centroid.

A text becomes a TF-IDF vector of hashed byte trigrams of its letters, scaled to length 1.
Each language has several centroids, found by spherical k-means over its training vectors;
a text gets the language of the centroid with the highest cosine. Where that cosine lies
below what the language's own training texts reach, the text is rejected.

The model (document frequencies, centroids, rejection distances) is fitted on a bounded
sample: ``PER_LANGUAGE`` labelled documents a language, ``SAMPLE`` in all.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from docnorm.llm.common import table
from docnorm.llm.sampling import bounded_sample

DIMENSIONS, CENTROIDS, PER_LANGUAGE, SAMPLE = 8192, 4, 1500, 12_000
#: Share of a language's own training texts that may lie beyond its rejection distance, and
#: how much further out than that a text may lie.
REJECT_SHARE, REJECT_SLACK = 0.001, 0.5
LETTER = regex.compile(r"\p{L}")

#: Bytes: ASCII letters lower-cased, other ASCII to space, the rest as it is.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[:128] = 32
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)


def trigram_counts(texts: pa.Array) -> np.ndarray:
    """[texts, DIMENSIONS] counts of hashed byte trigrams of words; null: none.

    Works on Arrow's text buffer as a whole: fold, squeeze spaces, hash, count.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    lengths = np.diff(offsets)
    # a space before each text and behind the last, so that words at the ends count as words
    own = np.repeat(np.arange(n, dtype=np.int32), lengths + 1)
    place = np.arange(len(raw)) + np.repeat(np.arange(1, n + 1), lengths)
    folded = np.full(len(own) + 1, 32, np.uint8)
    folded[place] = FOLD[raw]
    accent = (folded[:-1] == 0xC3) & (folded[1:] >= 0x80) & (folded[1:] <= 0x9E) & (folded[1:] != 0x97)
    folded[1:][accent] += 32
    keep = np.r_[True, (folded[1:] != 32) | (folded[:-1] != 32)]
    own = np.r_[own, n - 1 if n else 0].astype(np.int32)[keep]
    folded = folded[keep].astype(np.uint32)
    code = (folded[:-2] << 16 | folded[1:-1] << 8 | folded[2:]) * np.uint32(0x9E3779B1) >> np.uint32(32 - 13)
    inside = own[1:-1]  # a trigram belongs to the text of its middle byte; a space there only spans words
    code = code[folded[1:-1] != 32]
    inside = inside[folded[1:-1] != 32]
    counts = np.bincount(inside.astype(np.int64) * DIMENSIONS + code, minlength=n * DIMENSIONS)
    return counts.reshape(n, DIMENSIONS).astype(np.float32)


def has_letter(texts: pa.Array) -> np.ndarray:
    return np.array([t is not None and LETTER.search(t) is not None for t in texts.to_pylist()], bool)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # [languages * CENTROIDS, DIMENSIONS]
    of: np.ndarray  # language of each centroid
    nearest: np.ndarray  # lowest cosine at which a language is not rejected

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        v = np.log1p(counts) * self.idf
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number, cosine, rejected)."""
        cosines = self.vectors(counts) @ self.centroids.T
        best = cosines.argmax(axis=1)
        score = np.clip(cosines[np.arange(len(best)), best], 0, 1).astype(np.float64)
        return self.of[best], score, score < self.nearest[self.of[best]]


def cluster(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from the mean, then what is farthest from all so far."""
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=-1, keepdims=True), 1e-12)
    centres = [unit(vectors.mean(axis=0))]
    while len(centres) < min(k, len(vectors)):
        centres.append(vectors[(vectors @ np.array(centres).T).max(axis=1).argmin()])
    centres = np.array(centres, np.float32)
    for _ in range(rounds):
        of = (vectors @ centres.T).argmax(axis=1)
        centres = np.array([unit(vectors[of == c].mean(axis=0)) if (of == c).any() else centres[c] for c in range(len(centres))])
    return centres


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, sample: int = SAMPLE, centroids: int = CENTROIDS) -> Model | None:
    """Model from labelled documents (doc_id, text, lang); None without any labelled text."""
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    chosen = bounded_sample(labelled, "lang", per_language, sample, F.struct("doc_id", "text"))

    def counted(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                counts = trigram_counts(some.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [some.column("lang"), pa.array([np.flatnonzero(c).astype(np.int32) for c in counts], pa.list_(pa.int32())),
                     pa.array([c[c > 0] for c in counts], pa.list_(pa.float32()))], names=["lang", "at", "count"])

    rows = chosen.mapInArrow(counted, "lang string, at array<int>, count array<float>").toPandas()
    rows = rows[rows["at"].map(len) > 0].sort_values("lang", kind="stable", ignore_index=True)
    if rows.empty:
        return None
    found = np.zeros(DIMENSIONS)
    for at in rows["at"]:
        found[at] += 1
    languages = sorted(rows["lang"].unique())
    model = Model(languages, np.log((1 + len(rows)) / (1 + found)).astype(np.float32) + 1, None, None, None)
    groups, nearest = [], []
    for lang in languages:  # one language's vectors are held at a time
        own = rows[rows["lang"] == lang]
        vectors = np.zeros((len(own), DIMENSIONS), np.float32)
        for vector, at, count in zip(vectors, own["at"], own["count"], strict=True):
            vector[at] = np.log1p(count) * model.idf[at]
            vector /= np.linalg.norm(vector)
        groups.append(cluster(vectors, centroids))
        nearest.append(REJECT_SLACK * np.quantile((vectors @ groups[-1].T).max(axis=1), REJECT_SHARE))
    model.centroids = np.concatenate(groups).astype(np.float32)
    model.of = np.repeat(np.arange(len(languages)), [len(g) for g in groups])
    model.nearest = np.array(nearest)
    return model


def predict(docs: DataFrame, model: Model | None, keep: list[Column] | None = None) -> DataFrame:
    """``keep`` columns (default doc_id) plus lang_pred, score and rejected per row of docs.

    Null text and text without a letter: ``und``, score 0, rejected. Any other text gets a
    learned language, ``und`` only when nothing was learned. Whole texts count, whatever
    their length; rows that repeat are predicted alike; an empty table gives an empty result.
    """
    keep = [F.col("doc_id")] if keep is None else keep
    rows = docs.select(*keep, F.col("text").alias("_text"))
    kept = rows.drop("_text").schema
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the fitting sample

    def predicted(batches):
        known = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                texts = some.column(some.num_columns - 1)
                letters = has_letter(texts)
                lang, score, far = (["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool))
                if known is not None and len(texts):
                    of, score, far = known.predict(trigram_counts(texts))
                    lang = [known.languages[i] if ok else "und" for i, ok in zip(of, letters, strict=True)]
                    score, far = np.where(letters, score, 0.0), far | ~letters
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(far, pa.bool_())],
                    names=[*some.schema.names[:-1], "lang_pred", "score", "rejected"])

    out = kept.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return rows.mapInArrow(predicted, out)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op6_language_centroids(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    return predict(docs, model, [F.col("doc_id"), held_out().alias("held_out")])


def drop_unidentified(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose language is identified, all columns as they were."""
    model = fit(docs)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return predict(docs, model, [whole]).where("NOT rejected").select("row.*")
