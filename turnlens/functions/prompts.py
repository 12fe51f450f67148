"""Prompt columns for the three model tasks, short and detailed forms.

The wording is ours; what matters downstream is the reply contract it asks for.
Templates hold ``{name}`` slots that are filled with columns.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnlens.functions.text import ws_strip
from turnlens.schemas import ISSUE_LABELS, REPAIR_FIELDS

SATISFACTION_SHORT = (
    "Rate how satisfied the user is after the assistant's last message.\n"
    'Reply with JSON: "score" (integer 1 to 5) and "reason" (one sentence).\n\n'
    "Assistant:\n{last_system_text}\n\n"
    "User:\n{user_text}"
)
SATISFACTION_DETAILED = (
    "Rate the user's satisfaction on a scale of 1 to 5.\n"
    "5: problem solved or thanks given. 4: positive with small flaws. 3: neutral or mixed. "
    "2: unhappy, not solved. 1: angry, refused or failed repeatedly.\n"
    'Reply only with JSON holding "score" (integer) and "reason" (at most 25 words).\n\n'
    'Previous assistant message: "{last_system_text}"\n'
    'User message: "{user_text}"'
)
ISSUES_SHORT = (
    "Name the reasons why this chatbot exchange left the user dissatisfied.\n"
    "Labels to choose from: " + ", ".join(ISSUE_LABELS) + "\n"
    'Reply with JSON: "issues" (one label or more), "severity" (LOW, MEDIUM or HIGH), '
    '"reason" (one or two sentences).\n\n{snippet}'
)
ISSUES_DETAILED = (
    "Diagnose this chatbot exchange. Pick every label that applies:\n"
    "MISSING_CONTEXT: known information ignored or asked for again.\n"
    "WRONG_FACT: false or misleading content.\n"
    "TONE_ISSUE: rude, mechanical or without empathy.\n"
    "LOOP: the bot repeats itself.\n"
    "UNSUPPORTED_INTENT: the request is beyond the bot's abilities.\n"
    "SLOW_RESPONSE: the wait bothers the user.\n"
    "HANDOFF_REQUIRED: a human should take over.\n"
    "SUCCESS_BEST_PRACTICE: alone, when nothing failed.\n"
    'Reply with JSON: "issues" (array of labels), "severity" (LOW, MEDIUM or HIGH), '
    '"reason" (one to three sentences).\n\n{snippet}'
)
REPAIR_SHORT = (
    "These user turns share a failure pattern of a virtual assistant. Propose a fix a developer can apply.\n"
    "Reply with JSON of exactly these keys: " + ", ".join(REPAIR_FIELDS) + ". "
    "The two text fields are strings, the others arrays of strings.\n\n{topic_description}"
)
REPAIR_DETAILED = (
    "The topic below groups user turns with low satisfaction, with frequent issue labels, sample messages "
    "and one diagnosis.\n"
    "Give the likely root cause, 3 to 6 prompt changes, a system prompt snippet of 6 to 12 lines, "
    "3 to 6 guardrail rules and 3 to 6 checks that would prove the fix.\n"
    "Reply only with JSON of exactly these keys: " + ", ".join(REPAIR_FIELDS) + ". "
    "root_cause and system_prompt_snippet are strings, the others arrays of strings.\n\n{topic_description}"
)


def fill(template: str, **slots: Column) -> Column:
    """Concatenate a template with columns in its ``{name}`` slots (null counts as empty)."""
    pieces = re.split(r"\{(\w+)\}", template)
    columns = [
        F.coalesce(slots[piece], F.lit("")) if i % 2 else F.lit(piece) for i, piece in enumerate(pieces) if piece
    ]
    return F.concat(*columns)


def satisfaction_prompt(user_text: Column, last_system_text: Column, detailed: bool = False) -> Column:
    if detailed:
        return fill(SATISFACTION_DETAILED, user_text=user_text, last_system_text=last_system_text)
    return fill(SATISFACTION_SHORT, user_text=ws_strip(user_text), last_system_text=ws_strip(last_system_text))


def issue_prompt(snippet: Column, detailed: bool = False) -> Column:
    if detailed:
        return fill(ISSUES_DETAILED, snippet=snippet)
    return fill(ISSUES_SHORT, snippet=ws_strip(snippet))


def repair_prompt(topic_description: Column, detailed: bool = False) -> Column:
    if detailed:
        return fill(REPAIR_DETAILED, topic_description=topic_description)
    return fill(REPAIR_SHORT, topic_description=ws_strip(topic_description))
