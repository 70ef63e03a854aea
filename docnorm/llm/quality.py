"""Quality grades by ordinal cumulative-link regression on hashed text.

Ratings are graded 0 (toxic), 1 (poor) and 2 (good). One weight vector over hashed text
features is shared by all grades, ordered thresholds part them:
P(grade >= g) = sigmoid(w.x - threshold_g). The expected grade ranks documents and the tail
probability P(grade >= 2) selects them.

The model is fitted on a bounded sample: ``PER_GRADE`` rated documents a grade.
"""
from __future__ import annotations

import re
import zlib
from functools import lru_cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docnorm.llm.common import table, write_table
from docnorm.llm.sampling import bounded_sample

BITS, PER_GRADE, STEPS, RIDGE = 17, 4000, 250, 5e-5
STYLE = 8  # features kept ahead of the hashed ones
WORD_PARTS, DIGITS = re.compile(r"[^\W\d_]+|[^\w\s]+"), re.compile(r"\d")


@lru_cache(maxsize=300_000)
def _bucket(part: str) -> int:
    return STYLE + (zlib.crc32(part.encode()) & ((1 << BITS) - 1))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(places, values): style shares, then presence of hashed words and of punctuation runs
    (weighted by the logarithm of their number). Null counts as empty."""
    text = text or ""
    parts = WORD_PARTS.findall(text)
    low = list(map(str.lower, parts))
    n, words, chars = max(len(parts), 1), text.count(" ") + 1, max(len(text), 1)
    style = [sum(map(str.isupper, parts)) / n, 1 - sum(map(str.isalpha, parts)) / n, len(set(low)) / n,
             len(DIGITS.findall(text)) / chars, np.log1p(words) / 10, 1 / words,
             sum(map(eq, low, low[1:])) / n, text.count("\n") / chars * 10]
    at, count = np.unique(np.fromiter(map(_bucket, low), np.int32, len(low)), return_counts=True)
    return np.r_[np.arange(STYLE, dtype=np.int32), at], np.r_[style, np.minimum(np.log1p(count), 2) * 0.3]


def packed(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CSR of the features of texts: row starts, places, values."""
    rows = [features(t) for t in texts]
    starts = np.r_[0, np.cumsum([len(at) for at, _ in rows])].astype(np.int64)
    if not rows:
        return starts, np.zeros(0, np.int64), np.zeros(0)
    return starts, np.concatenate([at for at, _ in rows]).astype(np.int64), np.concatenate([v for _, v in rows])


def scores(starts: np.ndarray, at: np.ndarray, value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """w.x of every row; rows are never empty, style comes first."""
    return np.add.reduceat(weight[at] * value, starts[:-1]) if len(starts) > 1 else np.zeros(0)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Weights, ascending thresholds (their gaps are exponentials, so the order holds)."""

    def __init__(self, weight: np.ndarray, cuts: np.ndarray):
        self.weight, self.cuts = weight, cuts

    def tails(self, csr: tuple) -> np.ndarray:
        """[rows, thresholds] of P(grade >= 1), P(grade >= 2), ..."""
        return sigmoid(scores(*csr, self.weight)[:, None] - self.cuts[None, :])


def fit_rows(csr: tuple, grades: np.ndarray, n_grades: int, steps: int = STEPS, rare: int | None = None) -> Model:
    """Full-batch Adam on the cumulative-link likelihood with a ridge; every grade weighs the
    same. Hashed features are scaled by inverse document frequency (the scale becomes part of
    the weights); those of fewer than ``rare`` rows (by default 3 and one more for every 500
    rows) are left out."""
    starts, at, value = csr
    rows = np.repeat(np.arange(len(grades), dtype=np.int32), np.diff(starts))
    rare = 3 + len(grades) // 500 if rare is None else rare
    found = np.bincount(at, minlength=STYLE + (1 << BITS))
    scale = np.log((1 + len(grades)) / (1 + found)) / 4 * (found >= rare)
    scale[:STYLE] = 1
    value = (value * scale[at]).astype(np.float32)
    share = 1 / np.maximum(np.bincount(grades, minlength=n_grades), 1)[grades] / n_grades
    weight, low, gaps = np.zeros(len(scale)), 0.0, np.zeros(max(n_grades - 2, 0))
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (weight, np.zeros(1), gaps)]
    for step in range(1, steps + 1):
        cuts = low + np.r_[0.0, np.cumsum(np.exp(gaps))]
        tail = sigmoid(scores(starts, at, value, weight)[:, None] - cuts[None, :])
        bounds = np.c_[np.ones(len(grades)), tail, np.zeros(len(grades))]
        each = np.arange(len(grades))
        up, down = bounds[each, grades], bounds[each, grades + 1]
        mass = np.maximum(up - down, 1e-9)
        # of log(up - down) by the score, and by the two thresholds beside the grade
        by_up, by_down = up * (1 - up) / mass * share, down * (1 - down) / mass * share
        slope = by_up - by_down
        grad_w = RIDGE * weight - np.bincount(at, slope[rows] * value, len(weight))
        grad_cut = np.bincount(np.maximum(grades - 1, 0), by_up * (grades > 0), n_grades - 1)
        grad_cut -= np.bincount(np.minimum(grades, n_grades - 2), by_down * (grades < n_grades - 1), n_grades - 1)
        grads = (grad_w, np.array([grad_cut.sum()]), np.array([grad_cut[g + 1:].sum() for g in range(len(gaps))]) * np.exp(gaps))
        moves = []
        for (m, v), g in zip(state, grads, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            moves.append(0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8))
        weight, low, gaps = weight - moves[0], low - moves[1][0], gaps - moves[2]
    return Model((weight * scale).astype(np.float32), low + np.r_[0.0, np.cumsum(np.exp(gaps))])


def fit(docs: DataFrame, ratings: DataFrame, n_grades: int = 3, per_grade: int = PER_GRADE) -> Model | None:
    """Model from documents (doc_id, text) and ratings (doc_id, grade 0..n_grades-1); None
    without ratings of two grades.

    The sample is drawn from the ratings, so only its texts are looked up and moved; of
    documents that share an id one is taken.
    """
    known = ratings.where(F.col("grade").between(0, n_grades - 1)).select("doc_id", "grade")
    sample = write_table(bounded_sample(known, "grade", per_grade, per_grade * n_grades, F.col("doc_id")), "rated")
    chosen = docs.select("doc_id", "text").join(sample, "doc_id").dropDuplicates(["doc_id"])

    def vectors(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                starts, place, value = packed(some.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [some.column("grade").cast(pa.int32()), pa.array(np.split(place.astype(np.int32), starts[1:-1])[:some.num_rows], pa.list_(pa.int32())),
                     pa.array(np.split(value.astype(np.float32), starts[1:-1])[:some.num_rows], pa.list_(pa.float32()))],
                    names=["grade", "at", "value"])

    rows = chosen.mapInArrow(vectors, "grade int, at array<int>, value array<float>").toPandas()
    if rows["grade"].nunique() < 2:
        return None
    rows = rows.sort_values("grade", kind="stable")
    starts, grades = np.r_[0, np.cumsum(rows["at"].map(len))].astype(np.int64), rows["grade"].to_numpy().astype(np.int64)
    csr = starts, np.concatenate(rows["at"].to_list()), np.concatenate(rows["value"].to_list())
    del rows
    return fit_rows(csr, grades, n_grades)


def grade(docs: DataFrame, model: Model | None, select: float = 0.5) -> DataFrame:
    """doc_id, expected_grade, tail_probability (of the top grade) and kept per row of docs
    (doc_id, text).

    Null text counts as empty text; whole texts count; rows that repeat are graded alike;
    without ratings of two grades both numbers are null and every row is kept. An empty table
    gives an empty result. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the feature space

    def graded(batches):
        known = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                tails = known.tails(packed(some.column("text").to_pylist())) if known is not None else None
                mean, top = (tails.sum(axis=1), tails[:, -1]) if tails is not None else ([None] * some.num_rows, [None] * some.num_rows)
                kept = top >= select if tails is not None else [True] * some.num_rows
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), pa.array(mean, pa.float64()), pa.array(top, pa.float64()), pa.array(kept, pa.bool_())],
                    names=["doc_id", "expected_grade", "tail_probability", "kept"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        graded, "doc_id long, expected_grade double, tail_probability double, kept boolean")


def ratings(labels: DataFrame) -> DataFrame:
    """doc_id and grade from labels (doc_id, quality, toxic): toxic 0, poor 1, good 2; a label
    that is null or contradicts another of the same document is left out."""
    graded = F.when(F.col("toxic") == 1, F.lit(0)).when(F.col("quality") == 0, F.lit(1)).when(F.col("quality") == 1, F.lit(2))
    return (labels.select("doc_id", graded.alias("grade")).where("grade IS NOT NULL AND doc_id IS NOT NULL")
            .groupBy("doc_id").agg(F.min("grade").alias("grade"), F.max("grade").alias("other"))
            .where("grade = other").select("doc_id", "grade"))


def op10_ordinal_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return grade(docs, fit(docs, ratings(table(spark, sf_dir, "labels"))))
