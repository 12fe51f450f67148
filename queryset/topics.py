"""Topics, repairs, dashboard tables and the staged run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queryset.adapter import (
    CONTEXT,
    KEY_SQL,
    RATED,
    STUB_POLICY,
    TAGGED,
    TOPIC_PARTS,
    TURN_TOPICS,
    TURNS,
    joined,
    quote,
    repair_stub,
    score_stub,
    sql_fill,
    strip,
    tag_stub,
    tagged_turns,
    topic_rows,
    turns,
    with_sql,
)
from queryset.registry import query
from queryset.scoring import LABEL_PAIR, SCORED, SNIPPET
from turnlens.functions.prompts import ISSUES_SHORT, REPAIR_DETAILED, REPAIR_SHORT
from turnlens.functions.replies import normalize_repair, parse_reply
from turnlens.operators import dashboard
from turnlens.operators.profile import preview, topic_turn_count
from turnlens.operators.annotate import annotate
from turnlens.operators.context import write_turns
from turnlens.operators.repairs import describe_topics, rank_topics, repair_requests, repair_topics
from turnlens.operators.topics import attach_labels, attach_topics, build_topics, label_topics, summarize_topics
from turnlens.operators.topics import topic_counts as count_topics
from turnlens.plans.diagnosis import Models, diagnose
from turnlens.schemas import KEY, REPAIR_FIELDS
from turnlens.sources.exports import export_json_array, flatten_lists, read_json_array
from turnlens.sources.tables import pin, scratch_path


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pin(topic_rows(spark, sf_dir), "topic-rows")


def shown(df: DataFrame, *lists: str) -> DataFrame:
    return df.withColumns({c: joined(c) for c in lists})


@query(
    with_sql(*TOPIC_PARTS)
    + """SELECT topic_id, topic_label, n_examples, array_to_string(top_issues, '|') AS top_issues,
      array_to_string(example_texts, '|') AS example_texts, example_reason FROM summary"""
)
def topic_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(summarize_topics(rows(spark, sf_dir)), "top_issues", "example_texts")


@query(
    with_sql(*TOPIC_PARTS)
    + f"SELECT {KEY_SQL}, topic_id, topic_label FROM topic_rows LEFT JOIN top_two USING (topic_id)"
)
def topic_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    clustered = rows(spark, sf_dir)
    return attach_labels(clustered, label_topics(clustered)).select(*KEY, "topic_id", "topic_label")


@query(
    with_sql(*TOPIC_PARTS, TURN_TOPICS)
    + f"SELECT {KEY_SQL}, speaker, text, low_satisfaction, topic_id, topic_label FROM turn_topics"
)
def turns_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    clustered = rows(spark, sf_dir)
    attached = attach_topics(tagged_turns(spark, sf_dir), clustered, label_topics(clustered))
    return attached.select(*KEY, "speaker", "text", "low_satisfaction", "topic_id", "topic_label")


@query(
    with_sql(*TOPIC_PARTS, TURN_TOPICS)
    + "SELECT topic_id, topic_label, count(*) AS n FROM turn_topics GROUP BY topic_id, topic_label"
)
def topic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    clustered = rows(spark, sf_dir)
    return count_topics(attach_topics(tagged_turns(spark, sf_dir), clustered, label_topics(clustered)))


@query(
    with_sql(*TOPIC_PARTS)
    + f"""SELECT {KEY_SQL}, topic_id, topic_label, array_to_string(issues, '|') AS issues, severity, reason,
      text AS cluster_text FROM topic_rows LEFT JOIN top_two USING (topic_id)"""
)
def cluster_topics_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic rows of the strict rules, built after an assignment to the nearest centroid."""
    built = build_topics(tagged_turns(spark, sf_dir), rows(spark, sf_dir), 5, 5, strict=True)
    return shown(built.rows, "issues")


EXTRA = """extra AS (
  SELECT topic_id, list(text ORDER BY rank) AS extra_texts
  FROM (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY dataset, conv_id, turn_id) AS rank
    FROM turn_topics WHERE speaker = 'USER' AND topic_id >= 0) WHERE rank <= 3 GROUP BY topic_id),
described AS (
  SELECT *, 'Topic ID: ' || topic_id || chr(10) || 'Topic label: ' || topic_label || chr(10)
    || 'Number of examples: ' || n_examples || chr(10)
    || 'Most frequent issue labels: ' || array_to_string(top_issues, ', ') || chr(10) || chr(10)
    || 'Representative user messages:' || chr(10)
    || array_to_string(list_transform(list_concat(example_texts, extra_texts)[1:5], lambda x, i: i || ') ' || x), chr(10))
    || CASE WHEN example_reason = '' THEN ''
       ELSE chr(10) || chr(10) || 'Representative diagnostic reason:' || chr(10) || example_reason END
    AS topic_description
  FROM summary JOIN extra USING (topic_id))"""


def flow(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Topic rows, summary and turns with topics, each read from a table."""
    clustered = rows(spark, sf_dir)
    built = build_topics(tagged_turns(spark, sf_dir), clustered)
    return clustered, built.summary, pin(built.turns, "turn-topics")


@query(with_sql(*TOPIC_PARTS, TURN_TOPICS, EXTRA) + "SELECT topic_id, topic_description FROM described")
def topic_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, summary, attached = flow(spark, sf_dir)
    return describe_topics(summary, attached).select("topic_id", "topic_description")


REPAIR_PROMPT = sql_fill(REPAIR_SHORT, topic_description=strip("topic_description"))


@query(with_sql(*TOPIC_PARTS, TURN_TOPICS, EXTRA) + f"SELECT topic_id, {REPAIR_PROMPT} AS prompt FROM described")
def repair_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, summary, attached = flow(spark, sf_dir)
    return repair_requests(describe_topics(summary, attached), "default").select("topic_id", "prompt")


DETAILED_PROMPT = sql_fill(REPAIR_DETAILED, topic_description="topic_description")


@query(with_sql(*TOPIC_PARTS, TURN_TOPICS, EXTRA) + f"SELECT topic_id, {DETAILED_PROMPT} AS prompt FROM described")
def repair_prompts_detailed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detailed prompt of the strict rules, which has keys of its own."""
    _, summary, attached = flow(spark, sf_dir)
    described = describe_topics(summary, attached)
    short = repair_requests(described, "default").select(F.col("request_key").alias("short_key"))
    detailed = repair_requests(described, "default", strict=True)
    return detailed.join(short, detailed.request_key == short.short_key, "left_anti").select("topic_id", "prompt")


@query(
    with_sql(*TOPIC_PARTS, TURN_TOPICS)
    + """SELECT count(*) FILTER (WHERE topic_id >= 0) AS n_assigned FROM turn_topics"""
)
def topic_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns that are in a topic."""
    return topic_turn_count(flow(spark, sf_dir)[2])


@query(
    with_sql(*TOPIC_PARTS)
    + """SELECT topic_id, topic_label, n_examples, array_to_string(top_issues, '|') AS top_issues
    FROM summary ORDER BY topic_id LIMIT 1"""
)
def first_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A look at the topic with the smallest id."""
    summary = summarize_topics(rows(spark, sf_dir))
    return shown(preview(summary, 1, ["topic_id"]), "top_issues").select(
        "topic_id", "topic_label", "n_examples", "top_issues"
    )


REPAIRS = f"""{EXTRA},
repairs AS (
  SELECT topic_id, topic_label, CASE WHEN n % 11 = 0 THEN '' ELSE 'cause ' || n END AS root_cause,
    CASE WHEN n % 11 = 0 THEN [] ELSE ['shorten', ' ', ' ask ' || n] END AS suggested_prompt_changes,
    CASE WHEN n % 11 = 0 OR n % 2 = 0 THEN '' ELSE 'Ask ' || n || '.' END AS system_prompt_snippet,
    CASE WHEN n % 11 = 0 THEN [] ELSE ['one rule'] END AS guardrail_rules,
    CASE WHEN n % 11 = 0 THEN [] ELSE [n::VARCHAR, 'done'] END AS evaluation_checks
  FROM (SELECT *, length({REPAIR_PROMPT}) AS n FROM described))"""
REPAIR_SHOWN = """topic_id, topic_label, root_cause, array_to_string(suggested_prompt_changes, ' | ')
  AS suggested_prompt_changes, system_prompt_snippet, array_to_string(guardrail_rules, ' | ') AS guardrail_rules,
  array_to_string(evaluation_checks, ' | ') AS evaluation_checks"""


def repair_flow(spark: SparkSession, sf_dir: str):
    clustered, summary, attached = flow(spark, sf_dir)
    repairs = pin(repair_topics(summary, attached, repair_stub(), policy=STUB_POLICY), "repairs")
    return clustered, summary, attached, repairs


@query(with_sql(*TOPIC_PARTS, TURN_TOPICS, REPAIRS) + f"SELECT {REPAIR_SHOWN} FROM repairs")
def repairs_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_lists(repair_flow(spark, sf_dir)[3])


@query(
    with_sql(*TOPIC_PARTS, TURN_TOPICS, REPAIRS)
    + """SELECT topic_id, CASE WHEN root_cause = '' THEN 'Repair generation failed due to API/parse error.'
        ELSE root_cause END AS root_cause,
      array_to_string(list_filter(list_transform(suggested_prompt_changes, lambda x: trim(x)), lambda x: x <> ''), ' | ')
        AS suggested_prompt_changes FROM repairs"""
)
def repairs_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict reply rules on the replies to the short prompts."""
    _, summary, attached = flow(spark, sf_dir)
    asked = repair_requests(describe_topics(summary, attached), "default")
    replied = annotate(asked, repair_stub(), "prompt_repair", "default", policy=STUB_POLICY)
    fields = normalize_repair(parse_reply(F.col("response_json")), strict=True)
    named = replied.select("topic_id", *[fields[name].alias(name) for name in REPAIR_FIELDS])
    return flatten_lists(named).select("topic_id", "root_cause", "suggested_prompt_changes")


@query(
    with_sql(*TOPIC_PARTS, TURN_TOPICS)
    + f"""SELECT {KEY_SQL}, speaker, text, round(satisfaction_mean, 6) AS satisfaction_score, low_satisfaction,
      array_to_string(issues, '|') AS issues, severity, reason, topic_id, topic_label,
      'dataset' AS satisfaction_source FROM turn_topics"""
)
def dashboard_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    clustered, _, _, repairs = repair_flow(spark, sf_dir)
    enriched = dashboard.enrich_turns(tagged_turns(spark, sf_dir), clustered, repairs)
    out = shown(dashboard.dashboard_turns(enriched), "issues")
    return out.withColumn("satisfaction_score", F.round("satisfaction_score", 6))


METRICS = """metrics AS (
  SELECT topic_id, count(turn_id) AS n_user_turns, round(avg(low_satisfaction::INT), 6) AS low_satisfaction_rate,
    round(avg(satisfaction_mean), 6) AS avg_satisfaction
  FROM turn_topics WHERE speaker = 'USER' AND topic_id >= 0 GROUP BY topic_id)"""


def dashboard_topic_table(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    clustered, summary, _, repairs = repair_flow(spark, sf_dir)
    enriched = dashboard.enrich_turns(tagged_turns(spark, sf_dir), clustered, repairs)
    return dashboard.dashboard_topics(summary, enriched, repairs), repairs


@query(
    with_sql(*TOPIC_PARTS, TURN_TOPICS, METRICS)
    + """SELECT topic_id, n_examples, array_to_string(top_issues, '|') AS top_issues,
      array_to_string(example_texts, '|') AS example_texts, example_reason, topic_label, n_user_turns,
      low_satisfaction_rate, avg_satisfaction
    FROM summary LEFT JOIN metrics USING (topic_id) ORDER BY n_examples DESC, n_user_turns DESC, topic_id"""
)
def dashboard_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics, _ = dashboard_topic_table(spark, sf_dir)
    rounded = {c: F.round(c, 6) for c in ("low_satisfaction_rate", "avg_satisfaction")}
    return shown(topics, "top_issues", "example_texts").withColumns(rounded)


@query(
    with_sql(TURNS, RATED, TAGGED)
    + """SELECT length(text) % 6 AS topic_id, count(turn_id) AS n_user_turns,
      round(avg(low_satisfaction::INT), 6) AS low_satisfaction_rate, round(avg(satisfaction_mean), 6) AS avg_satisfaction
    FROM tagged WHERE speaker = 'USER' GROUP BY 1"""
)
def topic_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics over topics that hold satisfied turns too, so that the rate varies."""
    every = tagged_turns(spark, sf_dir).withColumn("topic_id", F.length("text") % 6)
    metrics = dashboard.topic_metrics(dashboard.resolve_score(every))
    return metrics.withColumns({c: F.round(c, 6) for c in ("low_satisfaction_rate", "avg_satisfaction")})


@query(
    with_sql(*TOPIC_PARTS, TURN_TOPICS, REPAIRS)
    + f"SELECT {REPAIR_SHOWN.replace(' | ', '|')} FROM repairs"
)
def dashboard_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repairs written as one JSON array and read back."""
    repairs = dashboard.dashboard_repairs(repair_flow(spark, sf_dir)[3])
    path = export_json_array(repairs, scratch_path(spark, "repairs-json"), ["topic_id"])
    back = read_json_array(spark, path, repairs.schema)
    return shown(back, "suggested_prompt_changes", "guardrail_rules", "evaluation_checks")


@query(
    with_sql(*TOPIC_PARTS)
    + """SELECT topic_id, CASE WHEN topic_id % 2 = 0 THEN 'Topic ' || topic_id ELSE topic_label END AS topic_label
    FROM summary"""
)
def topic_label_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the dashboard where every other repair has none."""
    clustered, summary, _, repairs = repair_flow(spark, sf_dir)
    repairs = repairs.withColumn("topic_label", F.when(F.col("topic_id") % 2 != 0, F.col("topic_label")))
    enriched = dashboard.enrich_turns(tagged_turns(spark, sf_dir), clustered, repairs)
    return dashboard.dashboard_topics(summary, enriched, repairs).select("topic_id", "topic_label")


@query(
    with_sql(*TOPIC_PARTS, TURN_TOPICS, METRICS, REPAIRS)
    + """SELECT row_number() OVER (ORDER BY n_examples DESC, n_user_turns DESC, topic_id) AS priority_rank, topic_id,
      topic_label, root_cause
    FROM summary LEFT JOIN metrics USING (topic_id) LEFT JOIN (SELECT topic_id, root_cause FROM repairs)
      USING (topic_id)"""
)
def topic_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics, repairs = dashboard_topic_table(spark, sf_dir)
    return rank_topics(topics, repairs).select("priority_rank", "topic_id", "topic_label", "root_cause")


BASELINE = quote(dashboard.BASELINE_SYSTEM_PROMPT)


@query(
    with_sql(
        *TOPIC_PARTS,
        TURN_TOPICS,
        REPAIRS,
        """scripts AS (SELECT dataset, conv_id, string_agg(CASE speaker WHEN 'USER' THEN 'User' WHEN 'SYSTEM' THEN 'System'
            ELSE 'Bot' END || ': ' || text, chr(10) ORDER BY turn_id) AS snippet
          FROM (SELECT *, row_number() OVER (PARTITION BY dataset, conv_id ORDER BY turn_id) AS rank FROM turns)
          WHERE rank <= 14 GROUP BY dataset, conv_id)""",
        """cases AS (SELECT topic_id, string_agg(dataset || '/' || conv_id || '/' || snippet, '||' ORDER BY rank) AS examples
          FROM (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY dataset, conv_id) AS rank
            FROM (SELECT DISTINCT topic_id, dataset, conv_id FROM topic_rows))
          JOIN scripts USING (dataset, conv_id) WHERE rank <= 2 GROUP BY topic_id)""",
    )
    + f"""SELECT topic_id, topic_label, {BASELINE} AS baseline_system_prompt,
      {BASELINE} || CASE WHEN system_prompt_snippet = '' THEN '' ELSE chr(10) || chr(10) || system_prompt_snippet END
        AS repaired_system_prompt, examples AS example_conversations,
      array_to_string(evaluation_checks, '|') AS test_user_messages,
      array_to_string(guardrail_rules, '|') AS guardrail_rules
    FROM repairs JOIN cases USING (topic_id)"""
)
def sandbox_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    clustered, _, attached, repairs = repair_flow(spark, sf_dir)
    cases = dashboard.sandbox_cases(repairs, clustered, attached)
    entry = F.transform("example_conversations", lambda c: F.concat_ws("/", c["dataset"], c["conv_id"], c["snippet"]))
    return shown(cases, "test_user_messages", "guardrail_rules").withColumn(
        "example_conversations", F.array_join(entry, "||")
    )


STAGED = f"""staged AS (
  SELECT *, low AND n % 11 <> 0 AS tagged,
    low AND n % 11 <> 0 AND (n % 13 = 0 OR n % 17 = 0 OR n % 8 <> 7 OR n // 8 % 8 <> 7) AS clustered
  FROM (SELECT *, coalesce(satisfaction_score < 3, false) AS low,
    length({sql_fill(ISSUES_SHORT, snippet=strip(SNIPPET))}) AS n FROM (SELECT * EXCLUDE (n) FROM scored)))"""


@query(
    with_sql(TURNS, CONTEXT, SCORED, STAGED)
    + """SELECT dataset, count(*) AS n_turns, count(satisfaction_score) AS n_scored, sum(low::INT)::BIGINT AS n_low,
      sum(tagged::INT)::BIGINT AS n_tagged, sum(clustered::INT)::BIGINT AS n_clustered, 4 AS n_repairs
    FROM staged GROUP BY dataset"""
)
def staged_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four stages with stub models, counted per dataset."""
    base = scratch_path(spark, "run")
    source = write_turns(turns(spark, sf_dir), f"{base}/turns")
    out = diagnose(spark, source, base, Models(score_stub(), tag_stub(), repair_stub()), k=4, policy=STUB_POLICY)
    return (
        out["turn_topics"]
        .groupBy("dataset")
        .agg(
            F.count("*").alias("n_turns"),
            F.count("satisfaction_score").alias("n_scored"),
            F.count_if("low_satisfaction").alias("n_low"),
            F.count_if(F.size("issues") > 0).alias("n_tagged"),
            F.count_if(F.col("topic_id") >= 0).alias("n_clustered"),
        )
        .withColumn("n_repairs", out["repairs"].agg(F.count("*")).scalar())
    )


STAGED_TURNS = (
    with_sql(TURNS, CONTEXT, SCORED, STAGED)
    + f"""SELECT {KEY_SQL}, satisfaction_score, low AS low_satisfaction,
      CASE WHEN NOT low OR n % 11 = 0 THEN '' WHEN n % 13 = 0 THEN ' loop |NOPE'
        WHEN n % 17 = 0 THEN 'TONE_ISSUE' ELSE array_to_string({LABEL_PAIR}, '|') END AS issues,
      CASE WHEN NOT low THEN 'NONE' WHEN n % 11 = 0 THEN 'MEDIUM' WHEN n % 13 = 0 THEN 'URGENT'
        WHEN n % 17 = 0 THEN 'MEDIUM' ELSE (['LOW', 'HIGH', 'MEDIUM', 'URGENT'])[n % 4 + 1] END AS severity
    FROM staged"""
)


@query(STAGED_TURNS)
def staged_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores and tags of every turn after the first two stages of a run over a stored turn table."""
    base = scratch_path(spark, "run")
    source = write_turns(turns(spark, sf_dir), f"{base}/turns")
    models = Models(score_stub(), tag_stub(), repair_stub())
    out = diagnose(spark, source, base, models, to_stage=2, policy=STUB_POLICY)["issues"]
    return out.select(*KEY, "satisfaction_score", "low_satisfaction", joined("issues").alias("issues"), "severity")


@query(STAGED_TURNS)
def staged_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after a first run over other turns at the same path: no outdated stage is reused."""
    base, path = scratch_path(spark, "run"), scratch_path(spark, "turns")
    models = Models(score_stub(), tag_stub(), repair_stub())
    for rows in (turns(spark, sf_dir).withColumn("text", F.lit("other")), turns(spark, sf_dir)):
        write_turns(rows, path)
        out = diagnose(spark, path, base, models, to_stage=2, policy=STUB_POLICY)["issues"]
    return out.select(*KEY, "satisfaction_score", "low_satisfaction", joined("issues").alias("issues"), "severity")
