"""Text quality by nearest-neighbour voting in a latent semantic space.

A text becomes TF-IDF counts of character-shape n-grams, words and word repeats. The IDF is
counted over all texts, the latent space is fitted on a bounded sample of labelled texts, and
the vectors of that sample with their labels are broadcast. Every text is compared with all of
them in blocks of exact cosine products; its nearest ones vote with their label, weighted by
similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlens.llm.common import text_or_empty
from turnlens.llm.hashing import WordHashes, code_points, rolling, words
from turnlens.llm.latent import idf_of, random_basis, right_singular, sum_arrays
from turnlens.sources.tables import pin

SHAPES, WORDS, REPEATS = 4096, 4096, 2
COLUMNS = SHAPES + WORDS + REPEATS
SHAPE_WEIGHT, WORD_WEIGHT, REPEAT_WEIGHT = 1.0, 0.35, 1.0


@dataclass(frozen=True)
class Voting:
    """``references`` bounds the labelled sample, and so what is collected and broadcast."""

    references: int = 4096
    rank: int = 48
    neighbours: int = 15
    sharpness: float = 4.0
    threshold: float = 0.3


def _classes() -> np.ndarray:
    """Class of each ASCII character: letters and digits by kind, others by themselves."""
    table = np.arange(256, dtype=np.int64) + 10
    table[128:] = 1
    for first, last, kind in (("a", "z", 1), ("A", "Z", 2), ("0", "9", 3)):
        table[ord(first) : ord(last) + 1] = kind
    return table


CLASSES = _classes()


def counts(text: str, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(columns, how often) of one whole text."""
    kinds = CLASSES[np.minimum(code_points(text), 255)]
    if len(kinds):
        kinds = kinds[np.concatenate(([True], (kinds[1:] != kinds[:-1]) | (kinds[1:] > 3)))]
    shapes = [rolling(kinds, n) % np.uint64(SHAPES) for n in (2, 3, 4)]
    named = hashes.of(words(text))
    found = np.concatenate([*shapes, SHAPES + named.astype(np.uint64) % np.uint64(WORDS)]).astype(np.int64)
    columns, often = np.unique(found, return_counts=True)
    same = int(np.count_nonzero(named[1:] == named[:-1]))
    again = len(named) - len(np.unique(named))
    extra = [(COLUMNS - 2, same), (COLUMNS - 1, again if len(named) and again > 0.6 * len(named) else 0)]
    extra = [(c, n) for c, n in extra if n]
    return np.append(columns, [c for c, _ in extra]).astype(np.int64), np.append(often, [n for _, n in extra]).astype(np.float64)


def weighted(columns: np.ndarray, often: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF with each kind of feature at its own length, so that long texts do not count more."""
    values = np.log1p(often) * idf[columns]
    out = np.zeros(len(values))
    for low, high, weight in (
        (0, SHAPES, SHAPE_WEIGHT),
        (SHAPES, SHAPES + WORDS, WORD_WEIGHT),
    ):
        part = (columns >= low) & (columns < high)
        norm = np.sqrt((values[part] ** 2).sum())
        if norm > 0:
            out[part] = weight * values[part] / norm
    total = max(1.0, often[(columns >= SHAPES) & (columns < SHAPES + WORDS)].sum())
    part = columns >= SHAPES + WORDS
    out[part] = REPEAT_WEIGHT * np.minimum(1.0, often[part] / total)
    return out


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, float]:
    """In how many texts each column occurs, and how many texts there are; over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, total = WordHashes(), np.zeros(COLUMNS + 1)
        for batch in batches:
            for text in batch.column(0):
                total[counts(text.as_py(), hashes)[0]] += 1
                total[COLUMNS] += 1
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    total = sum_arrays(docs.select(text_or_empty(text_col)).mapInArrow(count, "part binary"), COLUMNS + 1)
    return total[:COLUMNS], total[COLUMNS]


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, learn: Column, references: int, id_col: str, text_col: str
) -> DataFrame:
    """id, text, label of at most ``references`` labelled rows for which ``learn`` holds.

    Ids are taken in the order of a hash; a label is the smallest given for an id, a text the
    smallest given for an id.
    """
    known = (
        labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & learn)
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.min(label_col).alias("label"))
    )
    # Ids without a text must not use up the sample, so labels are matched before the cut.
    present = docs.select(F.col(id_col).alias("id")).distinct()
    chosen = known.join(present, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(references)
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    sample = texts.join(F.broadcast(chosen), "id")  # at most ``references`` narrow rows
    return sample.groupBy("id", "label").agg(F.min("text").alias("text"))


class Space:
    """The fitted space: what a task needs to turn texts into latent vectors."""

    def __init__(self, idf: np.ndarray, axes: np.ndarray):
        self.idf, self.axes = idf, axes.astype(np.float32)

    def vector(self, text: str, hashes: WordHashes) -> np.ndarray:
        columns, often = counts(text, hashes)
        raw = weighted(columns, often, self.idf).astype(np.float32) @ self.axes[columns]
        return raw / max(float(np.linalg.norm(raw)), 1e-12)


def fit_space(sample: DataFrame, idf: np.ndarray, rank: int) -> Space:
    basis = random_basis(COLUMNS, rank + 16)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, product = WordHashes(), np.zeros((COLUMNS, basis.shape[1]))
        for batch in batches:
            for text in batch.column(0):
                columns, often = counts(text.as_py(), hashes)
                row = weighted(columns, often, idf)
                product[columns] += np.outer(row, row @ basis[columns])
        yield pa.RecordBatch.from_arrays([pa.array([product.tobytes()], pa.binary())], ["part"])

    product = sum_arrays(sample.select("text").mapInArrow(sketch, "part binary"), basis.size)
    axes, _ = right_singular(product.reshape(basis.shape), basis, rank)
    return Space(idf, axes)


def neighbour_scores(
    vectors: np.ndarray, references: np.ndarray, labels: np.ndarray, voting: Voting, block: int = 512
) -> np.ndarray:
    """Similarity-weighted share of label 1 among the nearest references of each vector."""
    prior = float(labels.mean()) if len(labels) else 0.5
    out = np.full(len(vectors), prior)
    k = min(voting.neighbours, len(labels))
    for at in range(0, len(vectors) if k else 0, block):
        cosines = vectors[at : at + block] @ references.T
        nearest = np.argpartition(cosines, -k, axis=1)[:, -k:]
        weights = np.maximum(np.take_along_axis(cosines, nearest, axis=1), 0.0).astype(np.float64) ** voting.sharpness
        total = weights.sum(axis=1)
        votes = (weights * labels[nearest]).sum(axis=1)
        out[at : at + block] = np.where(total > 1e-9, votes / np.maximum(total, 1e-9), prior)
    return np.clip(out, 0.0, 1.0)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    voting: Voting = Voting(),
) -> DataFrame:
    """All columns of ``docs`` with quality_score (0 to 1, higher: label 1 likelier).

    ``learn`` says on ``labels`` which rows may be learned from. Labels that are null or not 0
    or 1 are not learned from. Null and empty texts are alike and get the share of good
    labels; texts of any length are read whole; equal texts get equal scores; without any
    label every score is 0.5. A column of ``docs`` named quality_score is replaced.
    """
    spark = docs.sparkSession
    frequencies, rows = document_frequencies(docs, text_col)
    idf = idf_of(frequencies, rows)
    sample = pin(labelled_sample(docs, labels, label_col, learn, voting.references, id_col, text_col), "labelled")
    space = fit_space(sample, idf, voting.rank)
    shared = spark.sparkContext.broadcast((space.idf, space.axes))

    @F.pandas_udf("array<float>")
    def vectors_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes, own = WordHashes(), Space(*shared.value)
        for batch in batches:
            yield pd.Series([own.vector(t, hashes) for t in batch])

    known = sample.select("id", "label", vectors_of("text").alias("vector")).orderBy("id").collect()  # bounded
    reference = np.array([r["vector"] for r in known], np.float32).reshape(len(known), space.axes.shape[1])
    given = np.array([r["label"] for r in known], np.float64)
    voters = spark.sparkContext.broadcast((reference, given))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes, own = WordHashes(), Space(*shared.value)
        for batch in batches:
            vectors = np.array([own.vector(t, hashes) for t in batch], np.float32).reshape(len(batch), -1)
            yield pd.Series(neighbour_scores(vectors, *voters.value, voting))

    return docs.withColumn("quality_score", score(text_or_empty(text_col)))


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    """crc32 of the id as text modulo ``folds`` equals ``fold``; a null id is in no fold."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))
