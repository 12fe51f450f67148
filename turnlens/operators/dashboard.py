"""Dashboard tables: turns, repairs, topics and sandbox cases."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnlens.functions.text import default_topic_label, reason_text, repaired_prompt
from turnlens.functions.values import listed, nan_to_null, to_numeric, to_numeric_id
from turnlens.operators.context import transcripts
from turnlens.operators.profile import pick_flag
from turnlens.operators.topics import attach_topics
from turnlens.schemas import (
    CONV,
    DASHBOARD_INPUT_COLUMNS,
    DASHBOARD_TURN_COLUMNS,
    REPAIR_COLUMNS,
    REPAIR_LIST_FIELDS,
    SUMMARY_COLUMNS,
    TOPIC_ROW_COLUMNS,
    UNCLUSTERED_ID,
    first_existing,
    require_columns,
    select_existing,
)
from turnlens.sources.exports import export_json_array, export_jsonl
from turnlens.sources.tables import broadcast_if_small, pin

#: Score columns in order of preference; the dataset mean comes after them.
SCORE_CANDIDATES = ("llm_satisfaction_score", "llm_score", "score")

# Fixed value: the prompt every sandbox case starts from.
BASELINE_SYSTEM_PROMPT = (
    "You are a helpful assistant. Be concise, accurate, and user-focused. "
    "If information is missing, ask clarifying questions. Avoid repeating the same question."
)


class Dashboard(NamedTuple):
    turns: DataFrame
    repairs: DataFrame
    topics: DataFrame
    sandbox: DataFrame


def resolve_score(turns: DataFrame, candidates: Sequence[str] = SCORE_CANDIDATES) -> DataFrame:
    """``satisfaction_score`` and ``satisfaction_source`` from the first column the table has."""
    model_column = first_existing(turns, candidates)
    name = model_column or first_existing(turns, ["satisfaction_mean"])
    source = "llm" if model_column else "dataset" if name else "missing"
    score = to_numeric(F.col(name)) if name else F.lit(None).cast("double")
    return turns.withColumns({"satisfaction_score": score, "satisfaction_source": F.lit(source)})


def repair_labels(repairs: DataFrame) -> DataFrame:
    """One label per topic id: the first in label order."""
    ids = repairs.select(to_numeric_id(F.col("topic_id").cast("string")).alias("topic_id"), "topic_label")
    return ids.dropna(subset=["topic_id"]).groupBy("topic_id").agg(F.min("topic_label").alias("topic_label"))


def enrich_turns(
    turns: DataFrame, topic_rows: DataFrame, repairs: DataFrame, candidates: Sequence[str] = SCORE_CANDIDATES
) -> DataFrame:
    """Turns with normalised issues, topic id and label, and the unified score."""
    require_columns(turns, DASHBOARD_INPUT_COLUMNS, "turns")
    require_columns(topic_rows, TOPIC_ROW_COLUMNS, "topic rows")
    require_columns(repairs, REPAIR_COLUMNS, "repairs")

    def typed(df: DataFrame) -> DataFrame:
        ids = {c: to_numeric_id(F.col(c).cast("string")) for c in ("conv_id", "turn_id")}
        return df.withColumns({"dataset": F.col("dataset").cast("string"), **ids})

    assigned = typed(topic_rows).withColumn("topic_id", to_numeric_id(F.col("topic_id").cast("string")))
    normal = typed(turns).withColumn("issues", listed(turns, "issues"))
    return resolve_score(attach_topics(normal, assigned, repair_labels(repairs)), candidates)


def dashboard_turns(enriched: DataFrame) -> DataFrame:
    """The export columns that exist, missing numbers as null."""
    out = select_existing(enriched, DASHBOARD_TURN_COLUMNS)
    return out.withColumn("satisfaction_score", nan_to_null(F.col("satisfaction_score")))


def dashboard_repairs(repairs: DataFrame) -> DataFrame:
    require_columns(repairs, REPAIR_COLUMNS, "repairs")
    fields = {"topic_id": _topic_number()}
    for name in REPAIR_COLUMNS[1:]:
        fields[name] = listed(repairs, name) if name in REPAIR_LIST_FIELDS else F.coalesce(name, F.lit(""))
    return repairs.select(*[c.alias(name) for name, c in fields.items()])


def _topic_number():
    return F.coalesce(to_numeric_id(F.col("topic_id").cast("string")), F.lit(UNCLUSTERED_ID))


def topic_metrics(enriched: DataFrame) -> DataFrame:
    """User turns, low rate and mean score per topic."""
    clustered = enriched.filter((F.col("speaker") == "USER") & (F.col("topic_id") > UNCLUSTERED_ID))
    return clustered.groupBy("topic_id").agg(
        F.count("turn_id").alias("n_user_turns"),
        F.avg(pick_flag(enriched).cast("int")).alias("low_satisfaction_rate"),
        F.avg("satisfaction_score").alias("avg_satisfaction"),
    )


def dashboard_topics(summary: DataFrame, enriched: DataFrame, repairs: DataFrame) -> DataFrame:
    """Topic summary with the repair labels and turn metrics, biggest first."""
    require_columns(summary, SUMMARY_COLUMNS, "topic summary")
    base = summary.select(
        _topic_number().alias("topic_id"),
        F.coalesce(F.col("n_examples").cast("long"), F.lit(0)).alias("n_examples"),
        listed(summary, "top_issues").alias("top_issues"),
        listed(summary, "example_texts").alias("example_texts"),
        F.coalesce("example_reason", F.lit("")).alias("example_reason"),
    )
    joined = base.join(repair_labels(repairs), "topic_id", "left").join(topic_metrics(enriched), "topic_id", "left")
    return joined.select(
        "topic_id",
        "n_examples",
        "top_issues",
        "example_texts",
        "example_reason",
        F.coalesce("topic_label", default_topic_label(F.col("topic_id"))).alias("topic_label"),
        F.coalesce("n_user_turns", F.lit(0)).alias("n_user_turns"),
        F.coalesce("low_satisfaction_rate", F.lit(0.0)).alias("low_satisfaction_rate"),
        "avg_satisfaction",
    ).orderBy(F.desc("n_examples"), F.desc("n_user_turns"), "topic_id")


def example_conversations(topic_rows: DataFrame, turns: DataFrame, per_topic: int = 2, max_turns: int = 14) -> DataFrame:
    """The first conversations of every topic with their transcripts, as a list per topic."""
    in_order = Window.partitionBy("topic_id").orderBy(*CONV)
    picked = (
        topic_rows.select("topic_id", *CONV)
        .distinct()
        .withColumn("rank", F.row_number().over(in_order))
        .filter(F.col("rank") <= per_topic)
    )
    # At most per_topic rows per topic: the turn table is filtered in place, not shuffled.
    picked = pin(picked, "picked")
    wanted = broadcast_if_small(picked.select(*CONV).distinct())
    texts = transcripts(turns.join(wanted, CONV, "left_semi"), max_turns)
    entry = F.struct("rank", F.struct("dataset", "conv_id", F.coalesce("snippet", F.lit("")).alias("snippet")).alias("c"))
    return (
        picked.join(texts, CONV, "left")
        .groupBy("topic_id")
        .agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["c"]).alias("example_conversations"))
    )


def sandbox_cases(repairs: DataFrame, topic_rows: DataFrame, turns: DataFrame) -> DataFrame:
    """Per topic: baseline and repaired prompt, example conversations, test messages, guardrails."""
    require_columns(repairs, REPAIR_COLUMNS, "repairs")
    no_examples = F.array().cast("array<struct<dataset:string,conv_id:bigint,snippet:string>>")
    cases = repairs.join(example_conversations(topic_rows, turns), "topic_id", "left")
    return cases.select(
        "topic_id",
        reason_text(F.col("topic_label")).alias("topic_label"),
        F.lit(BASELINE_SYSTEM_PROMPT).alias("baseline_system_prompt"),
        repaired_prompt(BASELINE_SYSTEM_PROMPT, F.col("system_prompt_snippet")).alias("repaired_system_prompt"),
        F.coalesce("example_conversations", no_examples).alias("example_conversations"),
        listed(repairs, "evaluation_checks").alias("test_user_messages"),
        listed(repairs, "guardrail_rules").alias("guardrail_rules"),
    )


def build_dashboard(
    turns: DataFrame,
    topic_rows: DataFrame,
    summary: DataFrame,
    repairs: DataFrame,
    candidates: Sequence[str] = SCORE_CANDIDATES,
) -> Dashboard:
    """All four tables. The enriched turns are written once, as three of them read it."""
    enriched = pin(enrich_turns(turns, topic_rows, repairs, candidates), "dashboard-turns")
    return Dashboard(
        dashboard_turns(enriched),
        dashboard_repairs(repairs),
        dashboard_topics(summary, enriched, repairs),
        sandbox_cases(repairs, topic_rows, enriched),
    )


def export_dashboard(board: Dashboard, folder: str, arrays: bool = False) -> dict[str, str]:
    """Write all tables as JSON Lines; with ``arrays`` the topic-sized ones as one JSON array each."""
    if not arrays:
        tables = {"turns": board.turns, "repairs": board.repairs, "topics": board.topics, "sandbox_cases": board.sandbox}
        return {name: export_jsonl(df, f"{folder}/{name}") for name, df in tables.items()}
    ranked = board.topics.withColumns({"_n": -F.col("n_examples"), "_u": -F.col("n_user_turns")})
    topics = export_json_array(ranked, f"{folder}/topics", ["_n", "_u", "topic_id"], drop=["_n", "_u"])
    return {
        "turns": export_jsonl(board.turns, f"{folder}/turns"),
        "repairs": export_json_array(board.repairs, f"{folder}/repairs", ["topic_id"]),
        "topics": topics,
        "sandbox_cases": export_json_array(board.sandbox, f"{folder}/sandbox_cases", ["topic_id"]),
    }
