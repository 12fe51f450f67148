"""Column functions on hand-written values."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from turnlens import schemas
from turnlens.functions import keys, prompts, replies, text, values


@pytest.fixture
def value(spark):
    """Evaluate a column on one row of named text values."""

    def evaluate(column, **cells):
        frame = spark.range(1).select(*[F.lit(v).cast("string").alias(k) for k, v in cells.items()] or ["id"])
        return frame.select(column.alias("x")).first()["x"]

    return evaluate


@pytest.mark.parametrize(
    "raw, want",
    [
        ("3,3,4", [3, 3, 4]),
        (" 3 , 4 ", [3, 4]),
        ("", None),
        ("  ", None),
        (None, None),
        ("3,x", None),
        ("3,4,", None),
        ("3.5", None),
        ("-1", [-1]),
    ],
)
def test_parse_scores(value, raw, want):
    assert value(values.parse_scores(F.col("c")), c=raw) == want


def test_array_mean(value):
    mean = values.array_mean(values.parse_scores(F.col("c")))
    assert value(mean, c="1,2,2") == pytest.approx(5 / 3)
    assert value(mean, c="") is None


@pytest.mark.parametrize("raw, want", [("3.5", 3.5), ("x", None), ("", None), (None, None), ("NaN", None), (" 7 ", 7.0)])
def test_to_numeric(value, raw, want):
    assert value(values.to_numeric(F.col("c")), c=raw) == want


def test_to_numeric_id(value):
    assert value(values.to_numeric_id(F.col("c")), c="3.0") == 3
    assert value(values.to_numeric_id(F.col("c")), c="1e300") is None


@pytest.mark.parametrize("raw", ["  a b\t\n", "\x1ca\x1f", "", "　", "ab", " x "])
def test_ws_strip_equals_python(value, raw):
    assert value(text.ws_strip(F.col("c")), c=raw) == raw.strip()
    assert value(text.is_blank(F.col("c")), c=raw) == (not raw.strip())


@pytest.mark.parametrize(
    "raw, literals, want",
    [
        (" a ", False, ["a"]),
        ("", False, []),
        (None, True, []),
        ("['A', 'B']", True, ["A", "B"]),
        ("['A', 'B']", False, ["['A', 'B']"]),
        ('["A", 1]', True, ["A", "1"]),
        ("[A]", True, ["[A]"]),
        ("[]", True, []),
    ],
)
def test_normalize_list_text(value, raw, literals, want):
    assert value(values.normalize_list_text(F.col("c"), literals), c=raw) == want


def test_normalize_list(value):
    null_list = F.lit(None).cast("array<string>")
    assert value(values.normalize_list(null_list)) == []
    assert value(values.normalize_list(F.array(F.lit("a"), F.lit(None)))) == ["a", "None"]
    assert value(values.clean_entries(F.array(F.lit(" a "), F.lit(" ")))) == ["a"]


@pytest.mark.parametrize(
    "reply, lenient, strict, reason",
    [
        ('{"score":2,"reason":"not solved"}', 2, 2, "not solved"),
        ('{"score":"4","reason":"r"}', 4, 3, "LLM_ERROR: ValueError"),
        ('{"score":" 4 ","reason":"r"}', 4, 3, "LLM_ERROR: ValueError"),
        ('{"score":"3.7","reason":"r"}', None, 3, "LLM_ERROR: ValueError"),
        ('{"score":3.7,"reason":"r"}', 3, 3, "LLM_ERROR: ValueError"),
        ('{"score":3.0,"reason":"r"}', 3, 3, "LLM_ERROR: ValueError"),
        ('{"score":true,"reason":"r"}', 1, 3, "LLM_ERROR: ValueError"),
        ('{"score":9,"reason":"r"}', 9, 3, "LLM_ERROR: ValueError"),
        ('{"score":null,"reason":"r"}', None, 3, "LLM_ERROR: ValueError"),
        ('{"score":2}', None if False else 2, 3, "LLM_ERROR: ValueError"),
        ('{"score":2,"reason":5}', 2, 3, "LLM_ERROR: ValueError"),
        ("not json", None, 3, "LLM_ERROR: JSONDecodeError"),
        ("[1]", None, 3, "LLM_ERROR: ValueError"),
        ("7", None, 3, "LLM_ERROR: TypeError"),
        (None, None, 3, "LLM_ERROR: JSONDecodeError"),
    ],
)
def test_scores(value, reply, lenient, strict, reason):
    v = replies.parse_reply(F.col("c"))
    assert value(replies.coerce_score(v), c=reply) == lenient
    assert value(replies.coerce_score(v, strict=True), c=reply) == strict
    assert value(replies.score_reason(v, strict=True), c=reply) == reason


def test_lenient_reason_is_stripped_text(value):
    v = replies.parse_reply(F.col("c"))
    assert value(replies.score_reason(v), c='{"reason":" a\\n"}') == "a"
    assert value(replies.score_reason(v), c='{"reason":null}') == ""
    assert value(replies.score_reason(v), c='{"reason":5}') == "5"


@pytest.mark.parametrize(
    "reply, lenient, strict",
    [
        (
            '{"issues":["LOOP"],"severity":"HIGH","reason":"x"}',
            (["LOOP"], "HIGH", "x"),
            (["LOOP"], "HIGH", "x"),
        ),
        (
            '{"issues":[" loop ","NOPE"],"severity":"urgent"}',
            ([" loop ", "NOPE"], "URGENT", ""),
            (["LOOP"], "MEDIUM", ""),
        ),
        ("{}", ([], "MEDIUM", ""), (["SUCCESS_BEST_PRACTICE"], "MEDIUM", "")),
        (
            '{"issues":"LOOP","severity":" high ","reason":" r "}',
            (["LOOP"], "HIGH", "r"),
            (["SUCCESS_BEST_PRACTICE"], "MEDIUM", "r"),
        ),
        (
            '{"issues":null}',
            ([], "MEDIUM", ""),
            (["HANDOFF_REQUIRED"], "HIGH", "Tagging failed due to API error."),
        ),
        ("bad", ([], "MEDIUM", ""), (["HANDOFF_REQUIRED"], "HIGH", "Tagging failed due to API error.")),
        ('{"issues":[1,null]}', (["1", "None"], "MEDIUM", ""), (["SUCCESS_BEST_PRACTICE"], "MEDIUM", "")),
    ],
)
def test_issue_replies(value, reply, lenient, strict):
    v = replies.parse_reply(F.col("c"))
    for flag, want in ((False, lenient), (True, strict)):
        got = (
            value(replies.issue_labels(v, flag), c=reply),
            value(replies.issue_severity(v, flag), c=reply),
            value(replies.issue_reason(v, flag), c=reply),
        )
        assert got == want


def test_repair_replies(value):
    v = replies.parse_reply(F.col("c"))
    reply = '{"root_cause":" r ","guardrail_rules":"one","suggested_prompt_changes":[" a ",""],"other":1}'
    lenient = {k: value(c, c=reply) for k, c in replies.normalize_repair(v).items()}
    assert lenient == {
        "root_cause": "r",
        "suggested_prompt_changes": [" a ", ""],
        "system_prompt_snippet": "",
        "guardrail_rules": ["one"],
        "evaluation_checks": [],
    }
    strict = {k: value(c, c=reply) for k, c in replies.normalize_repair(v, True).items()}
    assert strict["suggested_prompt_changes"] == ["a"]
    failed = {k: value(c, c="bad") for k, c in replies.normalize_repair(v, True).items()}
    assert failed["root_cause"] == replies.FALLBACK_ROOT_CAUSE and failed["guardrail_rules"] == []


@pytest.mark.parametrize("user", ['say "hi"\n\t/ é', " padded ", ""])
def test_request_key_is_the_hash_of_canonical_json(value, user):
    key = keys.request_key("t", "m", user_text=F.col("u"), last_system_text=F.col("s"))
    payload = {"task": "t", "model": "m", "user_text": user.strip(), "last_system_text": ""}
    canonical = json.dumps(payload, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    assert value(key, u=user, s=None) == hashlib.sha256(canonical.encode()).hexdigest()


def test_turn_key(spark):
    row = spark.createDataFrame([("D", 1, 2, "u", None)], "dataset string, conv_id long, turn_id long, t string, s string")
    got = row.select(keys.turn_key("m", F.col("t"), F.col("s"))).first()[0]
    assert got == hashlib.sha256(b"D|1|2|m|u|").hexdigest()


def test_snippets(value):
    assert value(text.snippet(F.col("s"), F.col("t")), s=None, t="hi") == f"Bot: {schemas.NO_SYSTEM_TURN}\nUser: hi"
    scored = text.scored_snippet(F.col("s"), F.col("t"), F.lit(2), F.lit("why"))
    assert value(scored, s="b", t="hi") == (
        "Bot: b\nUser: hi\nSatisfaction score (estimated): 2.0\nSatisfaction rationale: why"
    )


def test_topic_label(value):
    ids, none = F.lit(3), values.empty_strings()
    assert value(text.topic_label(ids, F.array(F.lit("A"), F.lit("B"), F.lit("C")))) == "Topic 3: A / B"
    assert value(text.topic_label(ids, F.array(F.lit("A")))) == "Topic 3: A"
    assert value(text.topic_label(ids, none)) == "Topic 3: General"


def test_topic_description(value):
    examples = F.array(*[F.lit(x) for x in "abcdef"])
    full = text.topic_description(F.lit(1), F.lit(" L "), F.lit(9), F.array(F.lit("A"), F.lit("B")), examples, F.lit(" r "))
    assert value(full).split("\n") == [
        "Topic ID: 1",
        "Topic label: L",
        "Number of examples: 9",
        "Most frequent issue labels: A, B",
        "",
        "Representative user messages:",
        *["1) a", "2) b", "3) c", "4) d", "5) e"],
        "",
        "Representative diagnostic reason:",
        "r",
    ]
    none = values.empty_strings()
    bare = text.topic_description(F.lit(1), F.lit(""), F.lit(0), none, none, F.lit(None).cast("string"))
    assert value(bare) == (
        "Topic ID: 1\nNumber of examples: 0\nMost frequent issue labels: [none]\n\n"
        "Representative user messages:\n[No example texts available]"
    )


def test_prompts_fill_their_slots(value):
    short = prompts.satisfaction_prompt(F.col("u"), F.col("s"))
    assert value(short, u=" hi ", s=None) == prompts.SATISFACTION_SHORT.format(user_text="hi", last_system_text="")
    detailed = prompts.issue_prompt(F.col("u"), detailed=True)
    assert value(detailed, u="x") == prompts.ISSUES_DETAILED.format(snippet="x")
    assert all(label in prompts.ISSUES_SHORT for label in schemas.ISSUE_LABELS)


def test_guards(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match=r"turns is missing columns: \['text'\]"):
        schemas.require_columns(df, ["id", "text"], "turns")
    assert schemas.ensure_column(df, "flag", F.lit(False)).first()["flag"] is False
    assert schemas.ensure_column(df, "id", F.lit(9)).first()["id"] == 0
    assert schemas.select_existing(df, ["x", "id"]).columns == ["id"]
    assert schemas.first_existing(df, ["x", "id"]) == "id"
