"""Numbers and lists: coercion, score lists, list normalisation (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlens.functions.text import ws_strip


def empty_strings() -> Column:
    return F.array().cast("array<string>")


def parse_scores(c: Column) -> Column:
    """``"3,3,4"`` -> ``[3, 3, 4]``; blank text, or any element that is no integer -> null."""
    parts = F.transform(F.split(ws_strip(c), ","), lambda x: ws_strip(x).try_cast("int"))
    bad = (ws_strip(c) == "") | F.exists(parts, lambda x: x.isNull())
    return F.when(~bad, parts)


def array_mean(c: Column) -> Column:
    """Mean of a number array; null for null and empty arrays."""
    total = F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(c) > 0, total / F.size(c))


def to_numeric(c: Column) -> Column:
    """Coercing cast to double: anything that is no finite-or-infinite number -> null."""
    number = c.try_cast("double")
    return F.when(~F.isnan(number), number)


def to_numeric_id(c: Column) -> Column:
    """Coercing cast of a text to bigint: exact for integers, ``"3.0"`` is 3, ``"x"`` is null."""
    return F.coalesce(c.try_cast("bigint"), to_numeric(c).try_cast("bigint"))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def normalize_list(c: Column) -> Column:
    """Array column: null -> ``[]``; a null entry becomes the text ``None``."""
    return F.coalesce(F.transform(c, lambda x: F.coalesce(x.cast("string"), F.lit("None"))), empty_strings())


def normalize_list_text(c: Column, literals: bool = False) -> Column:
    """Text column: blank or null -> ``[]``, else a one-entry list of the stripped text.

    With ``literals`` a text that looks like ``['A', 'B']`` is read as a list; when
    it does not parse it stays a single entry.
    """
    s = ws_strip(c)
    single = F.array(s)
    if literals:
        parsed = F.from_json(s, "array<string>")
        single = F.when(s.startswith("[") & s.endswith("]"), F.coalesce(parsed, single)).otherwise(single)
    return F.when(s.isNull() | (s == ""), empty_strings()).otherwise(single)


def listed(df: DataFrame, name: str) -> Column:
    """Column as a list of texts, whether it is stored as an array or as text."""
    is_array = df.schema[name].dataType.typeName() == "array"
    return normalize_list(F.col(name)) if is_array else normalize_list_text(F.col(name), literals=True)


def clean_entries(c: Column) -> Column:
    """Strip every list entry and drop the blank ones."""
    return F.filter(F.transform(c, ws_strip), lambda x: x != "")


def join_entries(c: Column) -> Column:
    """Flatten a list for display: entries joined by a bar."""
    return F.array_join(F.coalesce(c, empty_strings()), " | ")


def has_real_issue(issues: Column) -> Column:
    """True when the list names at least one failure (any label but the success label)."""
    return F.coalesce(F.exists(issues, lambda i: i != "SUCCESS_BEST_PRACTICE"), F.lit(False))


def has_issues(issues: Column) -> Column:
    return F.coalesce(F.size(issues) > 0, F.lit(False))
