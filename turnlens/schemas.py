"""Table schemas, join keys, fixed vocabularies and schema guards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A conversation and a turn inside it; every join and window uses these.
CONV = ["dataset", "conv_id"]
KEY = ["dataset", "conv_id", "turn_id"]

# The failure taxonomy, severities, defaults and placeholders that
# appear in outputs.
ISSUE_LABELS = (
    "MISSING_CONTEXT",
    "WRONG_FACT",
    "TONE_ISSUE",
    "LOOP",
    "UNSUPPORTED_INTENT",
    "SLOW_RESPONSE",
    "HANDOFF_REQUIRED",
    "SUCCESS_BEST_PRACTICE",
)
NO_FAILURE_LABEL = "SUCCESS_BEST_PRACTICE"
SEVERITIES = ("LOW", "MEDIUM", "HIGH")
DEFAULT_SEVERITY = "MEDIUM"
UNTAGGED_SEVERITY = "NONE"
UNCLUSTERED_ID = -1
UNCLUSTERED_LABEL = "UNCLUSTERED"
LOW_SCORE = 3
NO_SYSTEM_TURN = "[No previous system turn available]"
REPAIR_TEXT_FIELDS = ("root_cause", "system_prompt_snippet")
REPAIR_LIST_FIELDS = ("suggested_prompt_changes", "guardrail_rules", "evaluation_checks")
REPAIR_FIELDS = (
    "root_cause",
    "suggested_prompt_changes",
    "system_prompt_snippet",
    "guardrail_rules",
    "evaluation_checks",
)

TURNS_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn_id", T.LongType()),
        T.StructField("speaker", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("dialog_act", T.StringType()),
        T.StructField("entity_tag", T.StringType()),
        T.StructField("scores_raw", T.StringType()),
        T.StructField("scores", T.ArrayType(T.IntegerType())),
        T.StructField("is_overall", T.BooleanType()),
        T.StructField("satisfaction_mean", T.DoubleType()),
        T.StructField("label", T.StringType()),
        T.StructField("low_satisfaction", T.BooleanType()),
    ]
)

REPLIES_SCHEMA = T.StructType(
    [
        T.StructField("request_key", T.StringType()),
        T.StructField("task", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("response_json", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)

# Stage inputs.
SCORING_COLUMNS = ("dataset", "conv_id", "turn_id", "speaker", "text")
TAGGING_COLUMNS = SCORING_COLUMNS + ("low_satisfaction",)
CLUSTERING_COLUMNS = TAGGING_COLUMNS + ("issues",)
SUMMARY_COLUMNS = ("topic_id", "n_examples", "top_issues", "example_texts", "example_reason")
TOPIC_ROW_COLUMNS = ("dataset", "conv_id", "turn_id", "topic_id")
REPAIR_COLUMNS = ("topic_id", "topic_label") + REPAIR_FIELDS
DASHBOARD_INPUT_COLUMNS = CLUSTERING_COLUMNS + ("severity", "reason")
DASHBOARD_TURN_COLUMNS = (
    "dataset",
    "conv_id",
    "turn_id",
    "speaker",
    "text",
    "satisfaction_score",
    "low_satisfaction",
    "issues",
    "severity",
    "reason",
    "topic_id",
    "topic_label",
    "satisfaction_source",
)


def require_columns(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Raise ``ValueError`` naming every column of ``columns`` that ``df`` lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{name} is missing columns: {missing}")
    return df


def ensure_column(df: DataFrame, name: str, default: Column) -> DataFrame:
    """Add ``name`` with ``default`` when the table has no such column."""
    return df if name in df.columns else df.withColumn(name, default)


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Project to the columns of the list that exist, in list order."""
    return df.select(*[c for c in columns if c in df.columns])


def first_existing(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """First candidate column the table has; the choice is made per table, not per row."""
    return next((c for c in candidates if c in df.columns), None)


def conform_turns(df: DataFrame) -> DataFrame:
    """Cast a turn table to :data:`TURNS_SCHEMA`, adding absent columns as nulls."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TURNS_SCHEMA.fields
        ]
    )
