"""k-means for a range of k at once: every pass over the vectors serves all models."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from turnlens.operators.vectors import nearest_of

#: Rows whose distances are held at once.
ROWS = 512


@dataclass(frozen=True)
class Sweep:
    """Centres and mean silhouette (squared distances) by k."""

    centers: dict[int, np.ndarray]
    silhouettes: dict[int, float]

    @property
    def best(self) -> int:
        """The k of the largest silhouette; ties: the smaller k."""
        return min(self.silhouettes, key=lambda k: (-self.silhouettes[k], k))

    def assign(self, df: DataFrame, k: int, embedding: str = "embedding", out: str = "topic_id") -> DataFrame:
        """Add the topic of model ``k`` per row (ties: the smaller id)."""
        nearest = nearest_of(df, np.arange(len(self.centers[k])), self.centers[k])
        return df.withColumn(out, nearest(F.col(embedding))["id"].cast("int"))


def sweep(df: DataFrame, ks: range, seed: int = 42, most_steps: int = 20, tolerance: float = 1e-4) -> Sweep:
    """Models for every k of ``ks`` over the column ``embedding``; ``df`` should be a written table.

    All models start from one k-means++ sequence, of which model k takes the first k. Each step
    assigns the rows to the centres of all models that still move and sums them up in one pass.
    Only sums per topic reach the driver. With fewer distinct vectors than k, model k has one
    topic each; a k of fewer than two topics has no silhouette.
    """
    vectors = df.select("embedding")
    seeds = _seeds(vectors, max(ks), seed)
    centers = {k: seeds[:k].copy() for k in ks}
    moving = set(ks)
    for _ in range(most_steps):
        if not moving:
            break
        for k, (sizes, sums, _) in _sums(vectors, {k: centers[k] for k in moving}).items():
            means = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centers[k])
            if ((means - centers[k]) ** 2).sum(axis=1).max() <= tolerance**2:
                moving.discard(k)
            centers[k] = means
    return Sweep(centers, _silhouettes(vectors, centers))


def _per_partition(vectors: DataFrame, start: Callable, schema: str) -> DataFrame:
    """``start()`` gives (add, rows): ``add`` takes some vectors, ``rows`` the partition's totals at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add, rows = start()
        for batch in batches:
            values = batch.column(0)
            x = np.asarray(values.flatten(), dtype="float64").reshape(len(values), -1)
            for i in range(0, len(x), ROWS):
                add(x[i : i + ROWS])
        yield pa.RecordBatch.from_pylist(rows(), schema=arrow)

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return vectors.mapInArrow(run, schema)


def _seeds(vectors: DataFrame, count: int, seed: int) -> np.ndarray:
    """Up to ``count`` distinct vectors: the next one is drawn by its squared distance to those before.

    The draw of a row depends on its vector only, not on where it lies: of exponential variables
    with the distances as rates the smallest wins. Equal vectors take part once.
    """
    picked: list[list[float]] = []
    for number in range(count):
        u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(number), "embedding"), 11) + F.lit(0.5)) * F.lit(2.0**-53)
        if picked:
            chosen = np.array(picked)
            near = nearest_of(vectors, np.arange(len(chosen)), chosen)(F.col("embedding"))["distance"]
            square = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
            apart = 2 * near + square
        else:
            apart = F.lit(1.0)
        drawn = vectors.withColumn("apart", apart).filter(F.col("apart") > 1e-9).withColumn("draw", -F.log(u) / F.col("apart"))
        found = drawn.agg(F.min(F.struct("draw", F.col("embedding").cast("array<double>").alias("v"))).alias("x")).first()["x"]
        if found is None:
            break
        picked.append(found["v"])
    if not picked:
        raise ValueError("no rows to cluster")
    return np.array(picked)


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmin((centers**2).sum(axis=1) / 2 - x @ centers.T, axis=1)


def _sums(vectors: DataFrame, centers: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By k: rows, sum of vectors and sum of squares per topic, from one pass."""
    shared = vectors.sparkSession.sparkContext.broadcast(centers)

    def start():
        models = shared.value
        totals = {k: (np.zeros(len(c), "int64"), np.zeros(c.shape), np.zeros(len(c))) for k, c in models.items()}

        def add(x: np.ndarray) -> None:
            square = (x**2).sum(axis=1)
            for k, (sizes, sums, squares) in totals.items():
                topic = _nearest(x, models[k])
                sizes += np.bincount(topic, minlength=len(sizes))
                squares += np.bincount(topic, square, len(sizes))
                sums += (topic == np.arange(len(sizes))[:, None]) @ x

        def rows() -> list[dict]:
            return [
                {"k": k, "topic": t, "n": int(sizes[t]), "square": float(squares[t]), "total": sums[t].tolist()}
                for k, (sizes, sums, squares) in totals.items()
                for t in np.flatnonzero(sizes).tolist()
            ]

        return add, rows

    parts = _per_partition(vectors, start, "k int, topic int, n long, square double, total array<double>")
    whole = parts.withColumn("v", array_to_vector("total")).groupBy("k", "topic").agg(
        F.sum("n").alias("n"), F.sum("square").alias("square"), vector_to_array(Summarizer.sum(F.col("v"))).alias("total")
    )
    out = {k: (np.zeros(len(c), "int64"), np.zeros(c.shape), np.zeros(len(c))) for k, c in centers.items()}
    for r in whole.collect():
        sizes, sums, squares = out[r["k"]]
        sizes[r["topic"]], sums[r["topic"]], squares[r["topic"]] = r["n"], r["total"], r["square"]
    return out


def _silhouettes(vectors: DataFrame, centers: dict[int, np.ndarray]) -> dict[int, float]:
    """Mean silhouette by k, for the rows' nearest centres: one pass for the topics, one for the rows."""
    stats = {}
    for k, (sizes, sums, squares) in _sums(vectors, centers).items():
        used = np.flatnonzero(sizes)
        if len(used) > 1:
            size = sizes[used]
            stats[k] = (centers[k][used], size, sums[used] / size[:, None], squares[used] / size)
    if not stats:
        raise ValueError("a silhouette needs at least two topics")
    shared = vectors.sparkSession.sparkContext.broadcast(stats)

    def start():
        totals = {k: [0, 0.0] for k in shared.value}

        def add(x: np.ndarray) -> None:
            square, at = (x**2).sum(axis=1), np.arange(len(x))
            for k, (middle, size, mean, mean_square) in shared.value.items():
                # Mean squared distance to a topic = squared distance to its mean + its spread.
                distance = np.maximum(square[:, None] + mean_square - 2 * x @ mean.T, 0)
                topic = _nearest(x, middle)
                own = size[topic]
                inside = distance[at, topic] * own / np.maximum(own - 1, 1)
                distance[at, topic] = np.inf
                outside = distance.min(axis=1)
                spread = np.maximum(inside, outside)
                known = (own > 1) & (spread > 0)
                totals[k][0] += len(x)
                totals[k][1] += float(((outside - inside)[known] / spread[known]).sum())

        return add, lambda: [{"k": k, "n": n, "total": total} for k, (n, total) in totals.items()]

    parts = _per_partition(vectors, start, "k int, n long, total double")
    means = parts.groupBy("k").agg((F.sum("total") / F.sum("n")).alias("mean")).collect()
    return {r["k"]: r["mean"] for r in sorted(means, key=lambda r: r["k"])}


def select_k(df: DataFrame, k_min: int = 4, k_max: int = 10, seed: int = 42) -> DataFrame:
    """Silhouette for every k of the range, best first (ties: the smaller k)."""
    found = sweep(df, range(k_min, k_max + 1), seed).silhouettes
    scores = df.sparkSession.createDataFrame(list(found.items()), "k int, silhouette double")
    return scores.orderBy(F.desc("silhouette"), "k")
