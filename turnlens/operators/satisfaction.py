"""Satisfaction: dataset-rated flags and model scores per user turn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlens.functions.keys import request_key, turn_key
from turnlens.functions.prompts import satisfaction_prompt
from turnlens.functions.replies import coerce_score, is_low_score, parse_reply, score_reason
from turnlens.functions.values import to_numeric
from turnlens.operators.annotate import CallPolicy, ModelFn, annotate, inputs_prompt, takes_inputs
from turnlens.operators.context import add_last_system_text, written_context
from turnlens.schemas import LOW_SCORE, SCORING_COLUMNS, ensure_column, require_columns

TASK = "satisfaction_score"


def flag_rated_turns(turns: DataFrame, dataset: str | None = None) -> DataFrame:
    """Add ``low_satisfaction`` from the corpus ratings: a USER turn, not overall, mean below 3."""
    df = turns if dataset is None else turns.withColumn("dataset", F.lit(dataset))
    mean = to_numeric(F.col("satisfaction_mean"))
    low = (F.col("speaker") == "USER") & (mean < LOW_SCORE) & ~F.col("is_overall")
    return df.withColumns({"satisfaction_mean": mean, "low_satisfaction": F.coalesce(low, F.lit(False))})


def is_scorable() -> Column:
    return F.col("speaker").eqNullSafe("USER") & F.col("is_overall").eqNullSafe(False)


def scoring_requests(turns: DataFrame, model: str, strict: bool = False) -> DataFrame:
    """Turns with ``last_system_text``, and key and prompt on the scorable ones."""
    require_columns(turns, SCORING_COLUMNS, "turns")
    return with_requests(add_last_system_text(turns), model, strict)


def with_requests(context: DataFrame, model: str, strict: bool = False) -> DataFrame:
    """Key and prompt on the scorable turns, which have their last system text."""
    context = ensure_column(context, "is_overall", F.lit(False))
    user, system = F.col("text"), F.col("last_system_text")
    key = turn_key(model, user, system) if strict else request_key(TASK, model, user_text=user, last_system_text=system)
    return context.withColumns(
        {
            "request_key": F.when(is_scorable(), key),
            "prompt": F.when(is_scorable(), satisfaction_prompt(user, system, detailed=strict)),
        }
    )


def is_valid_score(reply: object) -> bool:
    """What the strict rules take: an integer score from 1 to 5 and a text reason."""
    if not isinstance(reply, dict):
        return False
    score = reply.get("score")
    return type(score) is int and 1 <= score <= 5 and isinstance(reply.get("reason"), str)


def score_satisfaction(
    turns: DataFrame,
    fn: ModelFn,
    model: str = "default",
    cache_path: str | None = None,
    strict: bool = False,
    policy: CallPolicy = CallPolicy(),
    raw_inputs: bool = False,
) -> DataFrame:
    """Score every scorable user turn with ``fn`` and flag the low ones.

    ``fn`` takes a ready prompt, or with ``raw_inputs`` the user text and the last
    system text. To score a sample, take it first (``sample_conversations``).

    Forgiving rules write ``satisfaction_score``, ``satisfaction_reason``,
    ``satisfaction_source`` and replace ``low_satisfaction``. The strict rules write
    ``llm_satisfaction_score``, ``llm_satisfaction_reason`` and ``low_satisfaction_llm``
    and keep the dataset flag; a failed call scores 3.
    """
    score_name = "llm_satisfaction_score" if strict else "satisfaction_score"
    reason_name = "llm_satisfaction_reason" if strict else "satisfaction_reason"
    flag_name = "low_satisfaction_llm" if strict else "low_satisfaction"
    outputs = [score_name, reason_name, "satisfaction_source", flag_name]
    require_columns(turns, SCORING_COLUMNS, "turns")
    requests = with_requests(written_context(turns.drop(*outputs)), model, strict)
    if raw_inputs:
        inputs = inputs_prompt(F.col("text"), F.col("last_system_text"))
        fn, requests = takes_inputs(fn), requests.withColumn("prompt", F.when(is_scorable(), inputs))
    valid = is_valid_score if strict else None
    replied = annotate(requests, fn, TASK, model, cache_path, policy, is_scorable(), valid).withColumn(
        "reply", parse_reply(F.col("response_json"))
    )
    asked, reply = F.col("request_key").isNotNull(), F.col("reply")
    scored = replied.withColumns(
        {
            score_name: F.when(asked, coerce_score(reply, strict)),
            reason_name: F.when(asked, score_reason(reply, strict, F.col("error"))),
            "satisfaction_source": F.when(asked, F.col("source") if strict else F.lit("llm")),
        }
    )
    return scored.withColumn(flag_name, is_low_score(F.col(score_name))).drop(
        "request_key", "response_json", "error", "source", "reply"
    )
