"""Failure tagging of user turns with low satisfaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlens.functions.keys import request_key
from turnlens.functions.prompts import issue_prompt
from turnlens.functions.replies import issue_labels, issue_reason, issue_severity, parse_reply
from turnlens.functions.text import scored_snippet, snippet
from turnlens.functions.values import empty_strings
from turnlens.operators.annotate import CallPolicy, ModelFn, annotate, inputs_prompt, takes_inputs
from turnlens.operators.context import ensure_last_system_text, written_context
from turnlens.schemas import TAGGING_COLUMNS, UNTAGGED_SEVERITY, ensure_column, require_columns

TASK = "issue_tagging"


def is_low_user_turn(strict: bool = False) -> Column:
    user = F.col("speaker").eqNullSafe("USER")
    if strict:
        return user & F.col("is_overall").eqNullSafe(False) & F.col("low_satisfaction_llm").eqNullSafe(True)
    return user & F.col("low_satisfaction").eqNullSafe(True)


def tagging_requests(turns: DataFrame, model: str, strict: bool = False) -> DataFrame:
    """Turns with snippet, key and prompt on the low ones.

    The strict rules take the model flag, leave overall turns out and show the score
    and its rationale in the snippet.
    """
    if strict:
        turns = ensure_column(ensure_column(turns, "is_overall", F.lit(False)), "low_satisfaction_llm", F.lit(False))
        turns = ensure_column(turns, "llm_satisfaction_score", F.lit(None).cast("int"))
        turns = ensure_column(turns, "llm_satisfaction_reason", F.lit(None).cast("string"))
    else:
        require_columns(turns, TAGGING_COLUMNS, "turns")
    context = ensure_last_system_text(turns)
    system, text = F.col("last_system_text"), F.col("text")
    shown = (
        scored_snippet(system, text, F.col("llm_satisfaction_score"), F.col("llm_satisfaction_reason"))
        if strict
        else snippet(system, text)
    )
    low = is_low_user_turn(strict)
    # The detailed prompt is another request; the plain key stays that of the short one.
    variant = {"prompt_variant": F.lit("detailed")} if strict else {}
    with_snippet = context.withColumn("snippet", F.when(low, shown))
    return with_snippet.withColumns(
        {
            "request_key": F.when(low, request_key(TASK, model, snippet=F.col("snippet"), **variant)),
            "prompt": F.when(low, issue_prompt(F.col("snippet"), detailed=strict)),
        }
    )


def is_valid_tag(reply: object) -> bool:
    """What the strict rules take: an object whose issues, if given, can be read as a list."""
    return isinstance(reply, dict) and isinstance(reply.get("issues"), (list, dict, str, type(None)))


def tag_issues(
    turns: DataFrame,
    fn: ModelFn,
    model: str = "default",
    cache_path: str | None = None,
    strict: bool = False,
    policy: CallPolicy = CallPolicy(),
    raw_inputs: bool = False,
) -> DataFrame:
    """Add ``issues``, ``severity`` and ``reason``: model tags on low user turns, defaults elsewhere.

    Earlier columns of those names are replaced. The strict rules keep taxonomy labels
    only and give a failed call a fallback tag. ``fn`` takes a ready prompt, or with
    ``raw_inputs`` the snippet. To tag a sample, take it first (``sample_conversations``).
    """
    bare = turns.drop("issues", "severity", "reason")
    if not strict:
        require_columns(bare, TAGGING_COLUMNS, "turns")
    # A stage table has its context; for any other it is computed once and written.
    context = bare if "last_system_text" in bare.columns else written_context(bare)
    requests = tagging_requests(context, model, strict)
    if raw_inputs:
        asked_for = F.when(F.col("request_key").isNotNull(), inputs_prompt(F.col("snippet")))
        fn, requests = takes_inputs(fn), requests.withColumn("prompt", asked_for)
    valid = is_valid_tag if strict else None
    replied = annotate(requests, fn, TASK, model, cache_path, policy, is_low_user_turn(strict), valid).withColumn(
        "reply", parse_reply(F.col("response_json"))
    )
    asked, reply = F.col("request_key").isNotNull(), F.col("reply")
    return replied.withColumns(
        {
            "issues": F.when(asked, issue_labels(reply, strict)).otherwise(empty_strings()),
            "severity": F.when(asked, issue_severity(reply, strict)).otherwise(UNTAGGED_SEVERITY),
            "reason": F.when(asked, issue_reason(reply, strict)).otherwise(""),
        }
    ).drop("request_key", "response_json", "error", "source", "reply", "snippet")
