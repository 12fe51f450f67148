"""The driver tables as inputs: turns from ``conversations``, stub models, SQL building blocks.

Every expression here exists twice, as Spark columns and as DuckDB SQL.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnlens.functions.text import WHITESPACE
from turnlens.functions.values import array_mean
from turnlens.operators.annotate import CallPolicy
from turnlens.operators.satisfaction import flag_rated_turns
from turnlens.operators.vectors import mean_vectors, nearest_centroid
from turnlens.operators.topics import select_cluster_rows
from turnlens.schemas import ISSUE_LABELS, KEY

#: Stub models answer at once, so a bad reply is not waited for.
STUB_POLICY = CallPolicy(on_error="fallback", max_retries=1, base_sleep=0.0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``conversations`` table as turns; ratings follow from the ids."""
    c, t = F.col("conv_id"), F.col("turn")
    ratings = F.array(1 + (c * 3 + t * 5) % 5, 1 + (c + t * 2) % 5, 1 + (c * 7 + t) % 5)
    user = F.col("role") == "user"
    return table(spark, sf_dir, "conversations").select(
        F.when(c % 2 == 0, "SGD").otherwise("CCPE").alias("dataset"),
        "conv_id",
        (t + 1).alias("turn_id"),
        F.when(user, "USER").when(F.col("role") == "assistant", "SYSTEM").otherwise("INSTRUCTION").alias("speaker"),
        "text",
        (user & (c % 10 == 0) & (t == 4)).alias("is_overall"),
        F.when(user, ratings).alias("scores"),
    )


def rated_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with mean rating and the dataset flag."""
    return flag_rated_turns(turns(spark, sf_dir).withColumn("satisfaction_mean", array_mean(F.col("scores"))))


def tagged_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rated turns with issue tags that follow from the text length, on the low turns."""
    n = F.length("text")
    labels = F.array(*[F.lit(x) for x in ISSUE_LABELS])
    low = F.col("low_satisfaction")
    picked = F.array(F.get(labels, (n % 8).cast("int")), F.get(labels, (F.floor(n / 8) % 8).cast("int")))
    severities = F.array(*[F.lit(x) for x in ("LOW", "MEDIUM", "HIGH")])
    reason = F.when(n % 3 == 0, "").when(n % 7 == 0, "nan").otherwise(F.concat(F.lit("length "), n.cast("string")))
    return rated_turns(spark, sf_dir).withColumns(
        {
            "issues": F.when(low, picked).otherwise(F.array().cast("array<string>")),
            "severity": F.when(low, F.get(severities, (n % 3).cast("int"))).otherwise("NONE"),
            "reason": F.when(low, reason).otherwise(""),
        }
    )


def topic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad turns, each with a vector of the ``embeddings`` table, put to the nearest label mean."""
    vectors = table(spark, sf_dir, "embeddings")
    rows = select_cluster_rows(tagged_turns(spark, sf_dir))
    n_vectors = vectors.agg(F.count("*")).scalar()
    placed = rows.withColumn("vec_id", (F.col("conv_id") * 8 + F.col("turn_id")) % n_vectors)
    embedded = placed.join(vectors.select("vec_id", "embedding"), "vec_id")
    return nearest_centroid(embedded, mean_vectors(vectors, "label")).drop("vec_id", "embedding")


def joined(c: Column | str) -> Column:
    """An array of texts as one text, so that both engines hash it alike."""
    return F.array_join(c, "|")


# --- stub models: the reply depends on the prompt length only -------------------------


def score_stub():
    def score(prompt: str):
        n = len(prompt)
        if n % 11 == 0:
            return "not json"
        if n % 13 == 0:
            return {"score": "4", "reason": "text score"}
        if n % 17 == 0:
            return {"score": 2}
        if n % 19 == 0:
            return {"score": 9, "reason": "off scale"}
        return {"score": 1 + n % 5, "reason": f" length {n} "}

    return score


def tag_stub():
    labels = list(ISSUE_LABELS)

    def tag(prompt: str):
        n = len(prompt)
        if n % 11 == 0:
            return "[not json"
        if n % 13 == 0:
            return {"issues": [" loop ", "NOPE"], "severity": "urgent"}
        if n % 17 == 0:
            return {"issues": "TONE_ISSUE", "severity": None, "reason": None}
        severity = ["low", "HIGH", " Medium ", "urgent"][n % 4]
        return {"issues": [labels[n % 8], labels[n // 8 % 8]], "severity": severity, "reason": f" length {n}"}

    return tag


def repair_stub():
    def repair(prompt: str):
        n = len(prompt)
        if n % 11 == 0:
            return "not json"
        return {
            "root_cause": f" cause {n} ",
            "suggested_prompt_changes": ["shorten", " ", f" ask {n}"],
            "system_prompt_snippet": f"Ask {n}." if n % 2 else None,
            "guardrail_rules": " one rule ",
            "evaluation_checks": [n, "done"],
            "other": 1,
        }

    return repair


# --- DuckDB ----------------------------------------------------------------------------


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(sql: str) -> str:
    return f"trim({sql}, {quote(WHITESPACE)})"


def sql_fill(template: str, **slots: str) -> str:
    """SQL twin of the prompt templates."""
    pieces = re.split(r"\{(\w+)\}", template)
    return " || ".join(f"coalesce({slots[p]}, '')" if i % 2 else quote(p) for i, p in enumerate(pieces) if p)


def sql_list(values) -> str:
    return "[" + ", ".join(quote(v) for v in values) + "]"


TURNS = """turns AS (
  SELECT CASE WHEN conv_id % 2 = 0 THEN 'SGD' ELSE 'CCPE' END AS dataset, conv_id, turn + 1 AS turn_id,
    CASE role WHEN 'user' THEN 'USER' WHEN 'assistant' THEN 'SYSTEM' ELSE 'INSTRUCTION' END AS speaker, text,
    role = 'user' AND conv_id % 10 = 0 AND turn = 4 AS is_overall,
    CASE WHEN role = 'user' THEN [1 + (conv_id * 3 + turn * 5) % 5, 1 + (conv_id + turn * 2) % 5,
      1 + (conv_id * 7 + turn) % 5] END AS scores
  FROM conversations)"""

RATED = """rated AS (
  SELECT *, coalesce(speaker = 'USER' AND satisfaction_mean < 3 AND NOT is_overall, false) AS low_satisfaction
  FROM (SELECT *, list_sum(scores) / len(scores)::DOUBLE AS satisfaction_mean FROM turns))"""

CONTEXT = """ctx AS (
  SELECT *, last_value(CASE WHEN speaker = 'SYSTEM' THEN text END IGNORE NULLS) OVER (
    PARTITION BY dataset, conv_id ORDER BY turn_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_system_text
  FROM turns)"""

TAGGED = f"""tagged AS (
  SELECT *,
    CASE WHEN low_satisfaction THEN [({sql_list(ISSUE_LABELS)})[length(text) % 8 + 1],
      ({sql_list(ISSUE_LABELS)})[length(text) // 8 % 8 + 1]] ELSE [] END AS issues,
    CASE WHEN low_satisfaction THEN (['LOW', 'MEDIUM', 'HIGH'])[length(text) % 3 + 1] ELSE 'NONE' END AS severity,
    CASE WHEN NOT low_satisfaction OR length(text) % 3 = 0 THEN '' WHEN length(text) % 7 = 0 THEN 'nan'
      ELSE 'length ' || length(text) END AS reason
  FROM rated)"""

CENTROIDS = """centroids AS (
  SELECT topic_id, list(x ORDER BY pos) AS centroid
  FROM (SELECT label AS topic_id, pos, avg(x) AS x
    FROM (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
    GROUP BY label, pos)
  GROUP BY topic_id),
nearest AS MATERIALIZED (
  SELECT vec_id, arg_min(topic_id, list_distance(embedding::DOUBLE[], centroid)) AS topic_id
  FROM embeddings, centroids GROUP BY vec_id)"""

TOPIC_ROWS = f"""{CENTROIDS},
clusterable AS MATERIALIZED (
  SELECT dataset, conv_id, turn_id, text, issues, severity, reason FROM tagged
  WHERE speaker = 'USER' AND low_satisfaction
    AND len(list_filter(issues, lambda x: x <> 'SUCCESS_BEST_PRACTICE')) > 0),
topic_rows AS MATERIALIZED (
  SELECT c.* EXCLUDE (vec_id), n.topic_id::BIGINT AS topic_id
  FROM (SELECT clusterable.*, (conv_id * 8 + turn_id) % n_vectors AS vec_id
    FROM clusterable, (SELECT count(*) AS n_vectors FROM embeddings)) c
  JOIN nearest n USING (vec_id))"""

SUMMARY = """issue_ranks AS (
  SELECT topic_id, issue, row_number() OVER (PARTITION BY topic_id ORDER BY n DESC, first_seen) AS rank
  FROM (SELECT topic_id, issue, count(*) AS n, min(row(dataset, conv_id, turn_id, pos)) AS first_seen
    FROM (SELECT topic_id, dataset, conv_id, turn_id, unnest(issues) AS issue, generate_subscripts(issues, 1) AS pos
      FROM topic_rows)
    GROUP BY topic_id, issue)),
ordered_rows AS (
  SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY dataset, conv_id, turn_id) AS rank FROM topic_rows),
top_two AS (
  SELECT topic_id, 'Topic ' || topic_id || ': ' || string_agg(issue, ' / ' ORDER BY rank) AS topic_label
  FROM issue_ranks WHERE rank <= 2 GROUP BY topic_id),
summary AS (
  SELECT topic_id, topic_label, n_examples, top_issues, example_texts, coalesce(example_reason, '') AS example_reason
  FROM (SELECT topic_id, count(*) AS n_examples,
      list(text ORDER BY rank) FILTER (WHERE rank <= 3) AS example_texts,
      arg_min(reason, rank) FILTER (WHERE reason <> '' AND lower(reason) <> 'nan') AS example_reason
    FROM ordered_rows GROUP BY topic_id)
  JOIN top_two USING (topic_id)
  JOIN (SELECT topic_id, list(issue ORDER BY rank) AS top_issues FROM issue_ranks WHERE rank <= 3 GROUP BY topic_id)
    USING (topic_id))"""

TURN_TOPICS = """turn_topics AS (
  SELECT t.*, coalesce(r.topic_id, -1) AS topic_id, coalesce(l.topic_label, 'UNCLUSTERED') AS topic_label
  FROM tagged t LEFT JOIN topic_rows r USING (dataset, conv_id, turn_id) LEFT JOIN top_two l USING (topic_id))"""


def with_sql(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


TOPIC_PARTS = (TURNS, RATED, TAGGED, TOPIC_ROWS, SUMMARY)
KEY_SQL = ", ".join(KEY)
