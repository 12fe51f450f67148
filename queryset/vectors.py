"""Vectors: normalisation, centroids, silhouettes, k-means, text features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queryset.adapter import CENTROIDS, table, with_sql
from queryset.registry import query
from turnlens.operators import vectors
from turnlens.operators.sweep import sweep
from turnlens.sources.tables import pin


@query(
    """SELECT vec_id, round(list_sum(list_transform(unit, lambda x: x * x)), 6) AS norm,
      round(list_sum(unit), 6) AS total
    FROM (SELECT vec_id, list_transform(v, lambda x: x / n) AS unit
      FROM (SELECT vec_id, embedding::DOUBLE[] AS v,
        sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS n FROM embeddings))"""
)
def l2_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = table(spark, sf_dir, "embeddings").select("vec_id", vectors.l2_normalize(F.col("embedding")).alias("u"))
    zero = F.lit(0.0)
    return unit.select(
        "vec_id",
        F.round(F.aggregate("u", zero, lambda a, x: a + x * x), 6).alias("norm"),
        F.round(F.aggregate("u", zero, lambda a, x: a + x), 6).alias("total"),
    )


@query(with_sql(CENTROIDS) + "SELECT vec_id, label, topic_id::BIGINT AS topic_id FROM nearest JOIN embeddings USING (vec_id)")
def centroid_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "embeddings")
    return vectors.nearest_centroid(points, vectors.mean_vectors(points, "label")).select(
        "vec_id", "label", "topic_id"
    )


def silhouette_sql(points: str, distance: str) -> str:
    """Brute force over all pairs."""
    return f"""WITH points AS ({points}),
    d AS (SELECT a.vec_id, a.label AS own, b.label AS other, count(*) AS n, sum({distance}) AS total
      FROM points a, points b GROUP BY 1, 2, 3),
    s AS (SELECT vec_id, own, max(CASE WHEN own = other THEN n END) AS size,
        max(CASE WHEN own = other THEN total END) AS inside, min(CASE WHEN own <> other THEN total / n END) AS outside
      FROM d GROUP BY vec_id, own)
    SELECT vec_id, round(CASE WHEN size = 1 THEN 0 ELSE (outside - inside / (size - 1))
      / greatest(outside, inside / (size - 1)) END, 6) AS silhouette FROM s"""


DISTANCE = "list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])"


@query(silhouette_sql("SELECT * FROM embeddings", f"{DISTANCE} * {DISTANCE}"))
def silhouette_squared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silhouettes for squared distances: topic means only, for any number of rows."""
    points = table(spark, sf_dir, "embeddings").withColumnRenamed("label", "topic_id")
    scored = vectors.silhouettes(points)
    return scored.select("vec_id", F.round("silhouette", 6).alias("silhouette"))


@query(
    """SELECT count(*) AS n_rows, 6 AS n_topics, true AS ids_in_range, true AS at_nearest_mean FROM embeddings"""
)
def kmeans_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k-means has no SQL form; what must hold of any result does: every row is in one of the six
    topics, and all but a hundredth of them are in the topic whose mean is nearest."""
    points = pin(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "points")
    placed = pin(vectors.assign_topics(points, k=6), "placed")
    nearest = vectors.nearest_centroid(placed, vectors.mean_vectors(placed, "topic_id"), out="nearest")
    return nearest.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("topic_id").cast("int").alias("n_topics"),
        F.bool_and(F.col("topic_id").between(0, 5)).alias("ids_in_range"),
        (F.avg((F.col("topic_id") == F.col("nearest")).cast("int")) >= 0.99).alias("at_nearest_mean"),
    )


@query(
    """SELECT 7 AS n_k, 4 AS k_min, 10 AS k_max, true AS best_first, true AS as_recomputed
    FROM (SELECT count(*) FROM embeddings)"""
)
def select_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan over k: every k once, best first, and the best silhouette as recomputed from the rows' topics."""
    points = pin(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "points")
    models = sweep(points, range(4, 11))
    scores = spark.createDataFrame(list(models.silhouettes.items()), "k int, silhouette double")
    again = vectors.silhouettes(models.assign(points, models.best)).agg(F.avg("silhouette")).scalar()
    top = F.max_by("k", F.struct("silhouette", -F.col("k")))
    return scores.agg(
        F.count("*").cast("int").alias("n_k"),
        F.min("k").alias("k_min"),
        F.max("k").alias("k_max"),
        (top == models.best).alias("best_first"),
        F.abs(F.max("silhouette") - again).alias("apart"),
    ).select("n_k", "k_min", "k_max", "best_first", (F.col("apart") < 1e-6).alias("as_recomputed"))


@query("SELECT doc_id, 384 AS dims, 1.0::DOUBLE AS norm FROM documents")
def embed_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default text features: every document gets a vector of length one."""
    embedded = vectors.embed_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return embedded.select("doc_id", F.size("embedding").alias("dims"), F.round(norm, 4).alias("norm"))


@query(
    """SELECT doc_id, 2 AS dims, floor((1 + length(text)) / (1 + length(text) - length(replace(text, ' ', '')))::DOUBLE
      + 0.1234567)::BIGINT AS chars_per_space FROM documents"""
)
def embed_with_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user embedding function on Arrow batches: characters and spaces, scaled to length one."""

    def embed(texts):
        return [[1 + len(t), 1 + t.count(" ")] for t in texts]

    out = vectors.embed_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), embed)
    ratio = F.get("embedding", F.lit(0)).cast("double") / F.get("embedding", F.lit(1)).cast("double")
    return out.select("doc_id", F.size("embedding").alias("dims"), F.floor(ratio + 0.1234567).alias("chars_per_space"))
