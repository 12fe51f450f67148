"""Text expressions: whitespace, fields, snippets, labels, descriptions (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnlens.schemas import NO_SYSTEM_TURN

#: Every character that counts as whitespace when a text is stripped.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def ws_strip(c: Column) -> Column:
    """Strip Unicode whitespace from both ends (plain ``trim`` removes spaces only)."""
    return F.trim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    return F.ltrim(c, F.lit(WHITESPACE)) == ""


def null_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def tab_fields(c: Column) -> Column:
    return F.split(c, "\t")


def field(fields: Column, position: int) -> Column:
    """Field by 0-based position, ``''`` when the line is shorter."""
    return F.coalesce(F.get(fields, F.lit(position)), F.lit(""))


def is_overall_line(speaker: Column, text: Column) -> Column:
    return (speaker == "USER") & (text == "OVERALL")


def reason_text(c: Column) -> Column:
    return ws_strip(F.coalesce(c, F.lit("")))


def snippet(last_system_text: Column, text: Column) -> Column:
    """Bot message and user message, with a placeholder when the bot has not spoken yet."""
    bot = F.coalesce(last_system_text, F.lit(NO_SYSTEM_TURN))
    return F.concat(F.lit("Bot: "), bot, F.lit("\nUser: "), F.coalesce(text, F.lit("")))


def scored_snippet(last_system_text: Column, text: Column, score: Column, reason: Column) -> Column:
    """:func:`snippet` plus the estimated score (printed as a decimal) and its rationale."""
    return F.concat(
        snippet(last_system_text, text),
        F.lit("\nSatisfaction score (estimated): "),
        F.coalesce(score.cast("double").cast("string"), F.lit("nan")),
        F.lit("\nSatisfaction rationale: "),
        F.coalesce(reason, F.lit("")),
    )


def role_name(speaker: Column) -> Column:
    return F.when(speaker == "USER", "User").when(speaker == "SYSTEM", "System").otherwise("Bot")


def transcript_line(speaker: Column, text: Column) -> Column:
    return F.concat(role_name(speaker), F.lit(": "), F.coalesce(text, F.lit("")))


def default_topic_label(topic_id: Column) -> Column:
    return F.concat(F.lit("Topic "), topic_id.cast("string"))


def topic_label(topic_id: Column, top_issues: Column) -> Column:
    """``Topic 3: LOOP / WRONG_FACT``: the two most frequent issues, or ``General``."""
    core = null_if_empty(F.array_join(F.slice(top_issues, 1, 2), " / "))
    return F.concat(default_topic_label(topic_id), F.lit(": "), F.coalesce(core, F.lit("General")))


def topic_description(
    topic_id: Column,
    label: Column,
    n_examples: Column,
    top_issues: Column,
    examples: Column,
    reason: Column,
    max_examples: int = 5,
) -> Column:
    """Multi-line description of a topic for the repair model.

    The label line and the reason block appear only when non-blank; examples are
    numbered from 1 and cut at ``max_examples``.
    """
    label = ws_strip(F.coalesce(label, F.lit("")))
    reason = reason_text(reason)
    issues = F.coalesce(null_if_empty(F.array_join(top_issues, ", ")), F.lit("[none]"))
    numbered = F.transform(
        F.slice(examples, 1, max_examples),
        lambda x, i: F.concat((i + 1).cast("string"), F.lit(") "), x),
    )
    shown = F.when(F.size(examples) > 0, F.array_join(numbered, "\n")).otherwise("[No example texts available]")
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Topic ID: "), topic_id.cast("string")),
        F.when(label != "", F.concat(F.lit("Topic label: "), label)),
        F.concat(F.lit("Number of examples: "), n_examples.cast("string")),
        F.concat(F.lit("Most frequent issue labels: "), issues),
        F.lit(""),
        F.lit("Representative user messages:"),
        shown,
        F.when(reason != "", F.concat(F.lit("\nRepresentative diagnostic reason:\n"), reason)),
    )


def repaired_prompt(baseline: str, snippet_col: Column) -> Column:
    """Baseline prompt, then a blank line and the repair snippet when there is one."""
    s = reason_text(snippet_col)
    return F.when(s != "", F.concat(F.lit(baseline + "\n\n"), s)).otherwise(F.lit(baseline))
