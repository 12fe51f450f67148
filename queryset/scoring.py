"""Model scores, issue tags, request keys and the reply cache."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queryset.adapter import (
    CONTEXT,
    KEY_SQL,
    RATED,
    STUB_POLICY,
    TURNS,
    joined,
    rated_turns,
    score_stub,
    sql_fill,
    sql_list,
    strip,
    tag_stub,
    turns,
    with_sql,
)
from queryset.registry import query
from turnlens.functions.keys import request_key as make_request_key
from turnlens.functions.keys import turn_key as make_turn_key
from turnlens.functions.prompts import ISSUES_DETAILED, ISSUES_SHORT, SATISFACTION_DETAILED, SATISFACTION_SHORT
from turnlens.functions.text import scored_snippet, snippet
from turnlens.operators import annotate
from turnlens.operators import profile
from turnlens.operators.context import add_last_system_text, write_turns
from turnlens.operators.issues import tag_issues
from turnlens.operators.satisfaction import score_satisfaction, scoring_requests
from turnlens.schemas import ISSUE_LABELS, KEY, NO_SYSTEM_TURN, REPLIES_SCHEMA
from turnlens.sources.replies import (
    append_cache,
    compact_cache,
    import_cache_jsonl,
    latest,
    lookup,
    read_cache,
    stored_replies,
)
from turnlens.sources.tables import pin, read_table, scratch_path

ASKED = "speaker = 'USER' AND NOT is_overall"
SHORT = sql_fill(SATISFACTION_SHORT, user_text=strip("text"), last_system_text=strip("last_system_text"))
DETAILED = sql_fill(SATISFACTION_DETAILED, user_text="text", last_system_text="last_system_text")

SCORED = f"""scored AS (
  SELECT *, CASE WHEN asked THEN CASE WHEN n % 11 = 0 THEN NULL WHEN n % 13 = 0 THEN 4 WHEN n % 17 = 0 THEN 2
      WHEN n % 19 = 0 THEN 9 ELSE 1 + n % 5 END END AS satisfaction_score,
    CASE WHEN asked THEN CASE WHEN n % 11 = 0 THEN '' WHEN n % 13 = 0 THEN 'text score' WHEN n % 17 = 0 THEN ''
      WHEN n % 19 = 0 THEN 'off scale' ELSE 'length ' || n END END AS satisfaction_reason
  FROM (SELECT *, {ASKED} AS asked, length({SHORT}) AS n FROM ctx))"""

SCORED_STRICT = f"""scored_strict AS (
  SELECT *, CASE WHEN asked THEN CASE WHEN bad THEN 3 ELSE 1 + n % 5 END END AS llm_satisfaction_score,
    CASE WHEN NOT asked THEN NULL WHEN n % 11 = 0 THEN 'LLM_ERROR: JSONDecodeError'
      WHEN bad THEN 'LLM_ERROR: ValueError' ELSE ' length ' || n || ' ' END AS llm_satisfaction_reason
  FROM (SELECT *, n % 11 = 0 OR n % 13 = 0 OR n % 17 = 0 OR n % 19 = 0 AS bad
    FROM (SELECT *, {ASKED} AS asked, length({DETAILED}) AS n FROM ctx)))"""


@query(
    with_sql(TURNS, CONTEXT, SCORED)
    + f"""SELECT {KEY_SQL}, satisfaction_score, satisfaction_reason,
      CASE WHEN asked THEN 'llm' END AS satisfaction_source, coalesce(satisfaction_score < 3, false) AS low_satisfaction
    FROM scored"""
)
def satisfaction_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_satisfaction(turns(spark, sf_dir), score_stub(), policy=STUB_POLICY)
    return scored.select(*KEY, "satisfaction_score", "satisfaction_reason", "satisfaction_source", "low_satisfaction")


@query(
    with_sql(TURNS, CONTEXT, SCORED_STRICT)
    + f"""SELECT {KEY_SQL}, llm_satisfaction_score, llm_satisfaction_reason,
      coalesce(llm_satisfaction_score < 3, false) AS low_satisfaction_llm FROM scored_strict"""
)
def satisfaction_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strict_scores(spark, sf_dir).select(
        *KEY, "llm_satisfaction_score", "llm_satisfaction_reason", "low_satisfaction_llm"
    )


def strict_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_satisfaction(turns(spark, sf_dir), score_stub(), strict=True, policy=STUB_POLICY)


@query(
    with_sql(TURNS, CONTEXT, SCORED_STRICT)
    + """SELECT llm_satisfaction_score, count(*) AS n FROM scored_strict WHERE asked GROUP BY 1 ORDER BY 1"""
)
def score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.score_histogram(strict_scores(spark, sf_dir))


@query(
    with_sql(TURNS, CONTEXT, SCORED)
    + """SELECT round(avg((satisfaction_score IS NOT NULL)::INT), 6) AS scored_coverage,
      round(avg((satisfaction_score < 3)::INT), 6) AS low_rate FROM scored WHERE speaker = 'USER'"""
)
def scored_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_satisfaction(turns(spark, sf_dir), score_stub(), policy=STUB_POLICY)
    coverage = profile.score_coverage(scored, "satisfaction_score", "low_satisfaction")
    return coverage.select(*[F.round(c, 6).alias(c) for c in coverage.columns])


SNIPPET = f"'Bot: ' || coalesce(last_system_text, '{NO_SYSTEM_TURN}') || chr(10) || 'User: ' || text"
LABEL_PAIR = (
    f"[({sql_list(ISSUE_LABELS)})[n % 8 + 1], ({sql_list(ISSUE_LABELS)})[n // 8 % 8 + 1]]"
)


@query(
    with_sql(TURNS, RATED, CONTEXT)
    + f"""SELECT {KEY_SQL}, text, low_satisfaction,
      CASE WHEN NOT low_satisfaction OR n % 11 = 0 THEN '' WHEN n % 13 = 0 THEN ' loop |NOPE'
        WHEN n % 17 = 0 THEN 'TONE_ISSUE' ELSE array_to_string({LABEL_PAIR}, '|') END AS issues,
      CASE WHEN NOT low_satisfaction THEN 'NONE' WHEN n % 11 = 0 THEN 'MEDIUM' WHEN n % 13 = 0 THEN 'URGENT'
        WHEN n % 17 = 0 THEN 'MEDIUM' ELSE (['LOW', 'HIGH', 'MEDIUM', 'URGENT'])[n % 4 + 1] END AS severity,
      CASE WHEN NOT low_satisfaction OR n % 11 = 0 OR n % 13 = 0 OR n % 17 = 0 THEN '' ELSE 'length ' || n END AS reason
    FROM (SELECT rated.*, length({sql_fill(ISSUES_SHORT, snippet=strip(SNIPPET))}) AS n
      FROM rated JOIN (SELECT {KEY_SQL}, last_system_text FROM ctx) USING ({KEY_SQL}))"""
)
def issues_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = tag_issues(rated_turns(spark, sf_dir), tag_stub(), policy=STUB_POLICY)
    return tagged.select(
        *KEY, "text", "low_satisfaction", joined("issues").alias("issues"), "severity", "reason"
    )


SCORED_SNIPPET = (
    f"{SNIPPET} || chr(10) || 'Satisfaction score (estimated): ' || (1 + turn_id % 4)::DOUBLE || chr(10) "
    "|| 'Satisfaction rationale: ' || 'turn ' || turn_id"
)


@query(
    with_sql(TURNS, CONTEXT)
    + f"""SELECT {KEY_SQL},
      CASE WHEN NOT low THEN '' WHEN n % 11 = 0 THEN 'HANDOFF_REQUIRED' WHEN n % 13 = 0 THEN 'LOOP'
        WHEN n % 17 = 0 THEN 'SUCCESS_BEST_PRACTICE' ELSE array_to_string({LABEL_PAIR}, '|') END AS issues,
      CASE WHEN NOT low THEN 'NONE' WHEN n % 11 = 0 THEN 'HIGH' WHEN n % 13 = 0 OR n % 17 = 0 THEN 'MEDIUM'
        ELSE (['LOW', 'HIGH', 'MEDIUM', 'MEDIUM'])[n % 4 + 1] END AS severity,
      CASE WHEN NOT low THEN '' WHEN n % 11 = 0 THEN 'Tagging failed due to API error.' WHEN n % 13 = 0 THEN ''
        WHEN n % 17 = 0 THEN 'None' ELSE 'length ' || n END AS reason
    FROM (SELECT *, speaker = 'USER' AND NOT is_overall AND turn_id % 4 < 2 AS low,
      length({sql_fill(ISSUES_DETAILED, snippet=SCORED_SNIPPET)}) AS n FROM ctx)"""
)
def issues_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores follow from the turn number here; old issue columns are replaced."""
    score = (1 + F.col("turn_id") % 4).cast("int")
    scored = turns(spark, sf_dir).withColumns(
        {
            "llm_satisfaction_score": score,
            "llm_satisfaction_reason": F.concat(F.lit("turn "), F.col("turn_id").cast("string")),
            "low_satisfaction_llm": score < 3,
            "severity": F.lit("old"),
        }
    )
    tagged = tag_issues(scored, tag_stub(), strict=True, policy=STUB_POLICY)
    return tagged.select(*KEY, joined("issues").alias("issues"), "severity", "reason")


@query(
    with_sql(TURNS, CONTEXT)
    + f"""SELECT {KEY_SQL}, {SNIPPET} AS snippet, {SCORED_SNIPPET} AS scored_snippet FROM ctx"""
)
def snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    system, text = F.col("last_system_text"), F.col("text")
    score, reason = 1 + F.col("turn_id") % 4, F.concat(F.lit("turn "), F.col("turn_id").cast("string"))
    return add_last_system_text(turns(spark, sf_dir)).select(
        *KEY,
        snippet(system, text).alias("snippet"),
        scored_snippet(system, text, score, reason).alias("scored_snippet"),
    )


REQUEST_KEY = f"""sha256('{{"last_system_text":' || to_json(coalesce({strip('last_system_text')}, ''))
  || ',"model":"default","task":"satisfaction_score","user_text":' || to_json({strip('text')}) || '}}')"""
REQUESTS = f"""requests AS (
  SELECT *, {REQUEST_KEY} AS request_key, {SHORT} AS prompt FROM ctx WHERE {ASKED})"""


@query(with_sql(TURNS, CONTEXT) + f"SELECT {KEY_SQL}, {REQUEST_KEY} AS request_key FROM ctx")
def request_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    context = add_last_system_text(turns(spark, sf_dir))
    key = make_request_key(
        "satisfaction_score", "default", user_text=F.col("text"), last_system_text=F.col("last_system_text")
    )
    return context.select(*KEY, key.alias("request_key"))


@query(
    with_sql(TURNS, CONTEXT)
    + f"""SELECT {KEY_SQL}, sha256(dataset || '|' || conv_id || '|' || turn_id || '|default|' || text || '|'
      || coalesce(last_system_text, '')) AS turn_key FROM ctx"""
)
def turn_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = make_turn_key("default", F.col("text"), F.col("last_system_text"))
    return add_last_system_text(turns(spark, sf_dir)).select(*KEY, key.alias("turn_key"))


@query(with_sql(TURNS, CONTEXT) + f"SELECT {KEY_SQL}, {SHORT} AS prompt, {DETAILED} AS detailed FROM ctx WHERE {ASKED}")
def scoring_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = turns(spark, sf_dir)
    short = scoring_requests(base, "default").filter("prompt is not null").select(*KEY, "prompt")
    detailed = scoring_requests(base, "default", strict=True).select(*KEY, F.col("prompt").alias("detailed"))
    return short.join(detailed, KEY)


@query(with_sql(TURNS, CONTEXT) + f"SELECT {KEY_SQL}, {SHORT} AS prompt FROM ctx WHERE speaker = 'USER'")
def prompts_without_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turn tables without the column for overall ratings: every user turn is scored."""
    base = turns(spark, sf_dir).drop("is_overall")
    return scoring_requests(base, "default").filter("prompt is not null").select(*KEY, "prompt")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring_requests(turns(spark, sf_dir), "default").filter("request_key is not null")


def earlier_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a first run over the SGD corpus left: one reply per request, some asked again, some broken."""
    asked = requests(spark, sf_dir).filter(F.col("dataset") == "SGD")
    n = F.length("prompt")

    def rows(df: DataFrame, reply, seq: int) -> DataFrame:
        values = {
            "task": F.lit("satisfaction_score"),
            "model": F.lit("default"),
            "response_json": reply,
            "error": F.lit(None).cast("string"),
            "seq": F.lit(seq).cast("long"),
        }
        return df.withColumns(values).select(*REPLIES_SCHEMA.fieldNames())

    first = rows(asked, F.concat(F.lit('{"score":'), (1 + n % 5).cast("string"), F.lit("}")), 1)
    again = rows(asked.filter(F.col("turn_id") > 3), F.when(n % 3 == 0, "{broken").otherwise('{"score":5}'), 2)
    return first.unionByName(again)


CACHE = f"""{REQUESTS},
cache AS (
  SELECT request_key, '{{"score":' || (1 + length(prompt) % 5) || '}}' AS response_json, 1 AS seq
  FROM requests WHERE dataset = 'SGD'
  UNION ALL SELECT request_key, CASE WHEN length(prompt) % 3 = 0 THEN '{{broken' ELSE '{{"score":5}}' END, 2
  FROM requests WHERE dataset = 'SGD' AND turn_id > 3),
latest AS (
  SELECT request_key, max(seq)::BIGINT AS seq, arg_max(response_json, seq) AS response_json
  FROM cache GROUP BY request_key),
usable AS (SELECT * FROM latest WHERE response_json <> '{{broken')"""


@query(with_sql(TURNS, CONTEXT, CACHE) + "SELECT request_key, response_json, seq FROM latest")
def cache_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(earlier_cache(spark, sf_dir)).select("request_key", "response_json", "seq")


@query(
    with_sql(TURNS, CONTEXT, CACHE)
    + f"SELECT {KEY_SQL}, request_key, response_json FROM requests JOIN usable USING (request_key)"
)
def cache_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = annotate.cache_hits(requests(spark, sf_dir), earlier_cache(spark, sf_dir))
    return hits.select(*KEY, "request_key", "response_json")


@query(
    with_sql(TURNS, CONTEXT, CACHE)
    + f"SELECT {KEY_SQL}, request_key FROM requests WHERE request_key NOT IN (SELECT request_key FROM usable)"
)
def cache_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    misses = annotate.cache_misses(requests(spark, sf_dir), earlier_cache(spark, sf_dir))
    return misses.select(*KEY, "request_key")


@query(with_sql(TURNS, CONTEXT, CACHE) + "SELECT request_key, response_json, seq FROM latest")
def cache_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two parts of a stored cache put into one; the rows left are the newest ones."""
    path, rows = scratch_path(spark, "cache"), earlier_cache(spark, sf_dir)
    append_cache(rows.filter("seq = 1"), path)
    append_cache(rows.filter("seq = 2"), path)
    compact_cache(spark, path)
    return read_cache(spark, path, "satisfaction_score", "default").select("request_key", "response_json", "seq")


@query(
    with_sql(TURNS, CONTEXT, CACHE)
    + f"SELECT DISTINCT request_key, response_json FROM usable WHERE request_key IN (SELECT request_key FROM requests WHERE turn_id < 6)"
)
def cache_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies to some requests out of a stored cache that holds other models' replies as well."""
    path, rows = scratch_path(spark, "cache"), earlier_cache(spark, sf_dir)
    append_cache(rows, path)
    append_cache(rows.withColumns({"model": F.lit("other/model"), "response_json": F.lit("{}"), "seq": F.col("seq") + 9}), path)
    asked = requests(spark, sf_dir).filter("turn_id < 6").select("request_key").distinct()
    return lookup(asked, stored_replies(spark, path, "satisfaction_score", "default")).select("request_key", "response_json")


def failing_stub():
    """Every third prompt fails twice before a reply comes, every fifth always, by the length of the prompt."""
    failed: dict[str, int] = {}

    def score(prompt: str):
        n = len(prompt)
        failed[prompt] = failed.get(prompt, 0) + 1
        if n % 5 == 0:
            raise TimeoutError
        if n % 3 == 0 and failed[prompt] < 3:
            raise ConnectionError
        return {"score": 1 + n % 5, "calls": failed[prompt]}

    return score


@query(
    with_sql(TURNS, CONTEXT, REQUESTS)
    + """SELECT request_key, CASE WHEN n % 5 <> 0 THEN 1 + n % 5 END::INT AS score,
      CASE WHEN n % 5 <> 0 THEN CASE WHEN n % 3 = 0 THEN 3 ELSE 1 END END::INT AS calls,
      CASE WHEN n % 5 = 0 THEN 'TimeoutError' END AS error
    FROM (SELECT request_key, min(length(prompt)) AS n FROM requests GROUP BY request_key)"""
)
def retried_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls that fail are tried three times; those that never succeed are given up with their error."""
    asked = annotate.distinct_requests(requests(spark, sf_dir))
    policy = annotate.CallPolicy(on_error="fallback", max_retries=3, base_sleep=0.0)
    replies = pin(annotate.call_model(asked, failing_stub(), policy), "retried")
    value = lambda name: F.get_json_object("response_json", f"$.{name}").cast("int").alias(name)
    return replies.select("request_key", value("score"), value("calls"), "error")


IMPORTED = f"""{REQUESTS},
lines AS (
  SELECT request_key, length(prompt) AS n, turn_id, row_number() OVER (ORDER BY conv_id, turn_id) AS line
  FROM requests WHERE dataset = 'SGD'),
imported AS (
  SELECT request_key, line - (SELECT count(*) FROM lines) AS seq,
    '{{"score":' || (1 + n % 5) || ',"reason":"line of ' || n || '"}}' AS response_json FROM lines
  UNION ALL SELECT request_key, 1, '{{"score":5}}' FROM lines WHERE turn_id > 5)"""


@query(
    with_sql(TURNS, CONTEXT, IMPORTED)
    + """SELECT request_key, arg_max(response_json, seq) AS response_json, max(seq)::BIGINT AS seq
    FROM imported GROUP BY request_key"""
)
def cache_import_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cache kept as JSON Lines in several files, imported next to replies of a run, which win."""
    base = scratch_path(spark, "import")
    asked, n = requests(spark, sf_dir).filter(F.col("dataset") == "SGD"), F.length("prompt")
    entry = F.struct(
        F.col("request_key").alias("key"),
        F.lit("default").alias("model"),
        (1 + n % 5).alias("score"),
        F.concat(F.lit("line of "), n.cast("string")).alias("reason"),
    )
    ordered = asked.repartitionByRange("conv_id").sortWithinPartitions("conv_id", "turn_id")
    ordered.select(F.to_json(entry).alias("value")).write.text(f"{base}/lines")
    append_cache(import_cache_jsonl(spark, f"{base}/lines"), f"{base}/cache", 0)
    live = {"task": "satisfaction_score", "model": "default", "response_json": '{"score":5}', "error": None}
    fresh = asked.filter("turn_id > 5").withColumns({c: F.lit(v).cast("string") for c, v in live.items()})
    append_cache(fresh.withColumn("seq", F.lit(1).cast("long")), f"{base}/cache")
    return latest(read_cache(spark, f"{base}/cache")).select("request_key", "response_json", "seq")


@query(with_sql(TURNS, CONTEXT) + f"SELECT {KEY_SQL}, last_system_text FROM ctx")
def stored_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context of a turn table that is laid out by conversation."""
    path = write_turns(turns(spark, sf_dir), scratch_path(spark, "turns"))
    return add_last_system_text(read_table(spark, path)).select(*KEY, "last_system_text")


@query(
    with_sql(TURNS, CONTEXT, CACHE)
    + f"""SELECT {KEY_SQL}, CASE WHEN speaker = 'USER' AND NOT is_overall THEN
        CASE WHEN u.request_key IS NULL THEN 'llm' ELSE 'cache' END END AS source,
      CASE WHEN speaker = 'USER' AND NOT is_overall THEN coalesce(u.response_json,
        '{{"length": ' || length({SHORT}) || '}}') END AS response_json
    FROM (SELECT *, {REQUEST_KEY} AS request_key FROM ctx) c LEFT JOIN usable u USING (request_key)"""
)
def annotate_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run over both corpora: stored replies are reused, the others are asked in two batches."""

    def reply(prompt: str):
        return {"length": len(prompt)}

    path = scratch_path(spark, "cache")
    append_cache(earlier_cache(spark, sf_dir), path)
    policy = annotate.CallPolicy(max_retries=1, base_sleep=0.0, parallelism=4, commit_batches=2)
    asked = scoring_requests(turns(spark, sf_dir), "default")
    replied = annotate.annotate(asked, reply, "satisfaction_score", "default", path, policy)
    return replied.select(*KEY, "source", "response_json")
