"""Repair packages: one model call per topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnlens.functions.keys import request_key
from turnlens.functions.prompts import repair_prompt
from turnlens.functions.replies import normalize_repair, parse_reply
from turnlens.functions.text import default_topic_label, topic_description
from turnlens.functions.values import empty_strings, listed
from turnlens.operators.annotate import CallPolicy, ModelFn, annotate, inputs_prompt, takes_inputs
from turnlens.operators.topics import first_examples
from turnlens.schemas import REPAIR_FIELDS, SUMMARY_COLUMNS, UNCLUSTERED_ID, ensure_column, require_columns

TASK = "prompt_repair"


def describe_topics(
    summary: DataFrame,
    turns: DataFrame | None = None,
    extra: int = 3,
    max_examples: int = 5,
    dedupe_examples: bool = False,
) -> DataFrame:
    """Add ``topic_description`` to a topic summary.

    With ``turns``, the first ``extra`` user texts of the topic follow the summary's
    examples; both often hold the same texts, ``dedupe_examples`` keeps each once.
    """
    require_columns(summary, SUMMARY_COLUMNS, "topic summary")
    summary = ensure_column(summary, "topic_label", F.lit(""))
    examples = listed(summary, "example_texts")
    if turns is not None:
        clustered = turns.filter((F.col("speaker") == "USER") & (F.col("topic_id") != UNCLUSTERED_ID))
        more = first_examples(clustered, extra).withColumnRenamed("example_texts", "extra_texts")
        summary = summary.join(more, "topic_id", "left")
        examples = F.concat(examples, F.coalesce("extra_texts", empty_strings()))
    if dedupe_examples:
        examples = F.array_distinct(examples)
    text = topic_description(
        F.col("topic_id"),
        F.col("topic_label"),
        F.col("n_examples"),
        listed(summary, "top_issues"),
        examples,
        F.col("example_reason"),
        max_examples,
    )
    return summary.withColumn("topic_description", text).drop("extra_texts")


def repair_requests(described: DataFrame, model: str, strict: bool = False) -> DataFrame:
    description = F.col("topic_description")
    # The detailed prompt is another request; the plain key stays that of the short one.
    variant = {"prompt_variant": F.lit("detailed")} if strict else {}
    return described.withColumns(
        {
            "request_key": request_key(TASK, model, topic_description=description, **variant),
            "prompt": repair_prompt(description, detailed=strict),
        }
    )


def repair_topics(
    summary: DataFrame,
    turns: DataFrame | None,
    fn: ModelFn,
    model: str = "default",
    cache_path: str | None = None,
    strict: bool = False,
    policy: CallPolicy = CallPolicy(),
    raw_inputs: bool = False,
) -> DataFrame:
    """Repair package per topic: root cause, prompt changes, snippet, guardrails, checks.

    ``fn`` takes a ready prompt, or with ``raw_inputs`` the topic description.
    """
    label = F.col("topic_label") if "topic_label" in summary.columns else default_topic_label(F.col("topic_id"))
    described = describe_topics(summary, turns).withColumn("_label", label)
    requests = repair_requests(described, model, strict)
    if raw_inputs:
        fn, requests = takes_inputs(fn), requests.withColumn("prompt", inputs_prompt(F.col("topic_description")))
    replied = annotate(requests, fn, TASK, model, cache_path, policy, F.lit(True))
    replied = replied.withColumn("reply", parse_reply(F.col("response_json")))
    fields = normalize_repair(F.col("reply"), strict)
    return replied.select(
        "topic_id", F.col("_label").alias("topic_label"), *[fields[name].alias(name) for name in REPAIR_FIELDS]
    )


def rank_topics(topics: DataFrame, repairs: DataFrame | None = None) -> DataFrame:
    """Biggest pain first: ``priority_rank`` by examples, then user turns, then topic id.

    With ``repairs`` the fix for each topic comes along.
    """
    # A topic table: one row per topic.
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("n_examples"), F.desc("n_user_turns"), "topic_id")
    ranked = topics.withColumn("priority_rank", F.row_number().over(order))
    return ranked if repairs is None else ranked.join(repairs.drop("topic_label"), "topic_id", "left")
