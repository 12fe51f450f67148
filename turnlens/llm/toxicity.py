"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

The features of a bounded sample of labelled texts are made on all executors; the learner
reads that sample as a stream. Per-coordinate rates and an L1 penalty leave a few thousand
weights, which are broadcast; every text is then scored in one pass without a shuffle.
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
from turnlens.llm.hashing import WordHashes, mix, words
from turnlens.llm.quality import labelled_sample
from turnlens.sources.tables import pin

BITS = 22


@dataclass(frozen=True)
class Ftrl:
    """``sample`` bounds the labelled texts that are learned from."""

    sample: int = 20_000
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.1
    threshold: float = 0.3


class Features:
    """Distinct columns of single words, their beginnings, neighbouring words and words with one
    between. The beginnings let rarer forms of a word share what is learned."""

    def __init__(self) -> None:
        self.hashes = WordHashes()
        self.starts = {size: WordHashes() for size in (4, 5)}

    def __call__(self, text: str) -> np.ndarray:
        found = words(text)
        named = self.hashes.of(found).astype(np.uint64)
        pairs = mix(named[:-1], 1) + mix(named[1:], 2)
        skips = mix(named[:-2], 3) + mix(named[2:], 4)
        kinds = [mix(named, 5), mix(pairs, 6), mix(skips, 7)]
        distinct = set(found)
        for size, hashes in self.starts.items():
            starts = hashes.of([w for w in {w[:size] for w in distinct if len(w) > size}])
            kinds.append(mix(starts, 7 + size))
        return np.unique(np.concatenate(kinds) >> np.uint64(64 - BITS)).astype(np.int32)


class Learner:
    def __init__(self, ftrl: Ftrl):
        self.ftrl = ftrl
        self.z, self.n = np.zeros(1 << BITS), np.zeros(1 << BITS)
        self.bias_z = self.bias_n = 0.0

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        f = self.ftrl
        shrunk = np.sign(z) * np.maximum(np.abs(z) - f.l1, 0.0)
        return -shrunk / ((f.beta + np.sqrt(n)) / f.alpha + f.l2)

    def bias(self) -> float:
        f = self.ftrl
        return -self.bias_z / ((f.beta + self.bias_n**0.5) / f.alpha)

    def learn(self, columns: np.ndarray, label: int) -> None:
        z, n = self.z[columns], self.n[columns]
        w, b = self.weights(z, n), self.bias()
        error = sigmoid(w.sum() + b) - label
        rate = self.ftrl.alpha
        grown = np.sqrt(n + error * error)
        self.z[columns] = z + error - (grown - np.sqrt(n)) / rate * w
        self.n[columns] = n + error * error
        more = (self.bias_n + error * error) ** 0.5
        self.bias_z += error - (more - self.bias_n**0.5) / rate * b
        self.bias_n += error * error

    def model(self) -> tuple[np.ndarray, np.ndarray, float]:
        w = self.weights(self.z, self.n)
        kept = np.flatnonzero(w)
        return kept.astype(np.int32), w[kept].astype(np.float32), self.bias()


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def train(sample: DataFrame, ftrl: Ftrl) -> tuple[np.ndarray, np.ndarray, float]:
    """(columns, weights, bias) from id, text, label rows of a bounded sample."""

    @F.pandas_udf("array<int>")
    def columns_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features()
        for batch in batches:
            yield pd.Series([features(t) for t in batch])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = Learner(ftrl)
        rows = [(found.values.to_numpy(), label) for batch in batches for found, label in zip(batch.column(0), batch.column(1).to_pylist())]
        for epoch in range(ftrl.epochs if rows else 0):
            for i in np.random.default_rng(epoch).permutation(len(rows)):
                learner.learn(*rows[i])
        columns, weights, bias = learner.model()
        yield pa.RecordBatch.from_arrays(
            [pa.array([columns.tobytes()]), pa.array([weights.tobytes()]), pa.array([bias])], ["columns", "weights", "bias"]
        )

    made = pin(sample.select("id", columns_of("text").alias("found"), "label"), "ngrams")
    one = made.repartition(1).sortWithinPartitions("id").select("found", F.col("label").cast("int"))  # bounded by ``sample``
    row = one.mapInArrow(learn, "columns binary, weights binary, bias double").first()
    if row is None:
        return np.empty(0, np.int32), np.empty(0, np.float32), 0.0
    return np.frombuffer(row[0], np.int32), np.frombuffer(row[1], np.float32), row[2]


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    ftrl: Ftrl = Ftrl(),
) -> DataFrame:
    """All columns of ``docs`` with toxicity_score (0 to 1, higher: label 1 likelier).

    ``learn`` says on ``labels`` which rows may be learned from. Labels that are null or not 0
    or 1 are not learned from. Null and empty texts are alike and get the score of the bias;
    texts of any length are read whole; equal texts get equal scores; without any label every
    score is 0.5. A column of ``docs`` named toxicity_score is replaced.
    """
    sample = labelled_sample(docs, labels, label_col, learn, ftrl.sample, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(train(sample, ftrl))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        columns, weights, bias = model.value
        dense = np.zeros(1 << BITS, np.float32)
        dense[columns] = weights
        features = Features()
        for batch in batches:
            yield pd.Series([float(sigmoid(dense[features(t)].sum(dtype=np.float64) + bias)) for t in batch])

    return docs.withColumn("toxicity_score", score(text_or_empty(text_col)))
