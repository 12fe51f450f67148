"""Model replies: JSON text -> typed, normalised columns.

A reply is parsed once into a variant. A text that is no JSON object is a failed
call; ``from_json`` into a struct cannot tell that apart from an object of nulls.
``strict`` selects the validating rules, otherwise the forgiving ones apply.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnlens.functions.text import reason_text, ws_strip
from turnlens.functions.values import clean_entries, empty_strings, normalize_list, normalize_list_text
from turnlens.schemas import (
    DEFAULT_SEVERITY,
    ISSUE_LABELS,
    LOW_SCORE,
    NO_FAILURE_LABEL,
    REPAIR_FIELDS,
    REPAIR_TEXT_FIELDS,
    SEVERITIES,
)

# What a failed call yields under the validating rules.
FALLBACK_SCORE = 3
FALLBACK_SCORE_REASON = "LLM_ERROR: "
FALLBACK_ISSUES = ("HANDOFF_REQUIRED",)
FALLBACK_SEVERITY = "HIGH"
FALLBACK_ISSUE_REASON = "Tagging failed due to API error."
FALLBACK_ROOT_CAUSE = "Repair generation failed due to API/parse error."


def parse_reply(c: Column) -> Column:
    """Variant of a JSON text, null when it does not parse."""
    return F.try_parse_json(c)


def json_kind(v: Column, path: str = "$") -> Column:
    """Type name at a path (``BIGINT``, ``STRING``, ``ARRAY<...>``, ``VOID``), null if absent."""
    return F.schema_of_variant(v if path == "$" else F.try_variant_get(v, path, "variant"))


def is_object(v: Column) -> Column:
    return F.coalesce(json_kind(v).startswith("OBJECT"), F.lit(False))


def text_field(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "string")


def list_field(v: Column, name: str) -> Column:
    """List of strings from a reply field that may be an array, a text, null or absent."""
    path = f"$.{name}"
    kind = json_kind(v, path)
    return (
        F.when(kind.startswith("ARRAY"), normalize_list(F.try_variant_get(v, path, "array<string>")))
        .when(kind.isNull() | (kind == "VOID"), empty_strings())
        .otherwise(normalize_list_text(text_field(v, name)))
    )


def valid_score(v: Column) -> Column:
    """True when the reply has an integer score 1..5 and a text reason."""
    score = F.try_variant_get(v, "$.score", "int")
    ok = (json_kind(v, "$.score") == "BIGINT") & score.between(1, 5) & (json_kind(v, "$.reason") == "STRING")
    return F.coalesce(is_object(v) & ok, F.lit(False))


def coerce_score(v: Column, strict: bool = False) -> Column:
    """Score of a reply. Forgiving: integers, truncated decimals and integer texts, no range check."""
    if strict:
        return F.when(valid_score(v), F.try_variant_get(v, "$.score", "int")).otherwise(F.lit(FALLBACK_SCORE))
    from_text = ws_strip(text_field(v, "score")).try_cast("int")
    is_text = json_kind(v, "$.score") == "STRING"
    return F.when(is_text, from_text).otherwise(F.try_variant_get(v, "$.score", "int"))


def score_reason(v: Column, strict: bool = False, error: Column | None = None) -> Column:
    """Reason of a scored reply; under the validating rules a failure names its error.

    ``error`` is the name of the exception the call ended with, when known.
    """
    if not strict:
        return reason_text(text_field(v, "reason"))
    kind = json_kind(v)
    guessed = (
        F.when(v.isNull(), "JSONDecodeError")
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY") | (kind == "STRING"), "ValueError")
        .otherwise("TypeError")
    )
    name = guessed if error is None else F.coalesce(error, guessed)
    failed = F.concat(F.lit(FALLBACK_SCORE_REASON), name)
    return F.when(valid_score(v), text_field(v, "reason")).otherwise(failed)


def is_low_score(score: Column) -> Column:
    return F.coalesce(score < LOW_SCORE, F.lit(False))


def usable_issues(v: Column) -> Column:
    """True when the reply is an object whose issues, if given, can be read as a list."""
    kind = json_kind(v, "$.issues")
    readable = kind.isNull() | kind.startswith("ARRAY") | kind.startswith("OBJECT") | (kind == "STRING")
    return F.coalesce(is_object(v) & readable, F.lit(False))


def normalize_issues(issues: Column) -> Column:
    """Strip and upper-case labels, keep the taxonomy only, never empty."""
    labels = F.filter(F.transform(issues, lambda x: F.upper(ws_strip(x))), lambda x: x.isin(*ISSUE_LABELS))
    return F.when(F.size(labels) > 0, labels).otherwise(F.array(F.lit(NO_FAILURE_LABEL)))


def issue_labels(v: Column, strict: bool = False) -> Column:
    if not strict:
        return list_field(v, "issues")
    given = F.when(json_kind(v, "$.issues").startswith("ARRAY"), list_field(v, "issues")).otherwise(empty_strings())
    fallback = F.array(*[F.lit(x) for x in FALLBACK_ISSUES])
    return F.when(usable_issues(v), normalize_issues(given)).otherwise(fallback)


def normalize_severity(c: Column, strict: bool = False) -> Column:
    """Upper-cased severity, ``MEDIUM`` by default; ``strict`` forces it into the scale."""
    if strict:
        upper = F.upper(c)
        return F.when(upper.isin(*SEVERITIES), upper).otherwise(F.lit(DEFAULT_SEVERITY))
    return F.coalesce(ws_strip(F.upper(F.when(c != "", c))), F.lit(DEFAULT_SEVERITY))


def issue_severity(v: Column, strict: bool = False) -> Column:
    severity = normalize_severity(text_field(v, "severity"), strict)
    return F.when(usable_issues(v), severity).otherwise(F.lit(FALLBACK_SEVERITY)) if strict else severity


def issue_reason(v: Column, strict: bool = False) -> Column:
    reason = reason_text(text_field(v, "reason"))
    if not strict:
        return reason
    explicit_null = json_kind(v, "$.reason") == "VOID"
    kept = F.when(explicit_null, F.lit("None")).otherwise(reason)
    return F.when(usable_issues(v), kept).otherwise(F.lit(FALLBACK_ISSUE_REASON))


def normalize_repair(v: Column, strict: bool = False) -> dict[str, Column]:
    """The five repair fields of a reply; other keys are ignored, missing ones become empty."""
    fields = {}
    for name in REPAIR_FIELDS:
        if name in REPAIR_TEXT_FIELDS:
            value = reason_text(text_field(v, name))
        else:
            value = clean_entries(list_field(v, name)) if strict else list_field(v, name)
        fields[name] = value
    if strict:
        failed = ~is_object(v)
        fields["root_cause"] = F.when(failed, F.lit(FALLBACK_ROOT_CAUSE)).otherwise(fields["root_cause"])
    return fields
