"""Counts, shares, summaries, key checks, context windows and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queryset.adapter import (
    CONTEXT,
    KEY_SQL,
    RATED,
    TAGGED,
    TURNS,
    joined,
    rated_turns,
    table,
    tagged_turns,
    turns,
    with_sql,
)
from queryset.registry import query
from turnlens.functions.values import has_issues, has_real_issue
from turnlens.operators import profile
from turnlens.operators.context import add_last_system_text, forward_fill, transcripts
from turnlens.operators.sampling import sample_conversations as sample_convs
from turnlens.operators.sampling import sample_rows as sample_n_rows
from turnlens.schemas import KEY


@query(
    with_sql(TURNS)
    + """SELECT 'rows' AS metric, count(*) AS value FROM turns
    UNION ALL SELECT 'conversations', count(DISTINCT conv_id) FROM turns
    UNION ALL SELECT 'overall_lines', sum(is_overall::INT)::BIGINT FROM turns
    UNION ALL SELECT 'speaker=' || speaker, count(*) FROM turns GROUP BY speaker"""
)
def quick_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.quick_stats(turns(spark, sf_dir))


@query(with_sql(TURNS) + "SELECT DISTINCT dataset, conv_id FROM turns")
def distinct_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_conversations(turns(spark, sf_dir))


@query(
    with_sql(TURNS)
    + """SELECT dataset, speaker, count(*) AS n FROM turns GROUP BY dataset, speaker ORDER BY n DESC, dataset, speaker"""
)
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_counts(turns(spark, sf_dir), ["dataset", "speaker"])


@query(
    with_sql(TURNS, CONTEXT)
    + "SELECT speaker, last_system_text IS NULL AS unseen, count(*) AS n FROM ctx GROUP BY 1, 2"
)
def value_counts_with_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = add_last_system_text(turns(spark, sf_dir))
    kept = seen.withColumn("unseen", F.col("last_system_text").isNull())
    return profile.value_counts(kept, ["speaker", "unseen"], dropna=False)


@query(
    with_sql(TURNS, RATED)
    + """SELECT low_satisfaction, round(count(*) / (SELECT count(*) FROM rated)::DOUBLE, 6) AS share
    FROM rated GROUP BY low_satisfaction"""
)
def value_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_shares(rated_turns(spark, sf_dir), ["low_satisfaction"]).withColumn(
        "share", F.round("share", 6)
    )


def describe_sql(value: str, source: str) -> str:
    parts = ", ".join(
        f"round({e}, 6) AS {n}"
        for n, e in (
            ("mean", f"avg({value})"),
            ("std", f"stddev_samp({value})"),
            ("min", f"min({value})::DOUBLE"),
            ("q25", f"quantile_cont({value}::DOUBLE, 0.25)"),
            ("q50", f"quantile_cont({value}::DOUBLE, 0.5)"),
            ("q75", f"quantile_cont({value}::DOUBLE, 0.75)"),
            ("max", f"max({value})::DOUBLE"),
        )
    )
    return f"SELECT count({value}) AS count, {parts} FROM {source}"


def rounded(described: DataFrame) -> DataFrame:
    return described.select("count", *[F.round(c, 6).alias(c) for c in described.columns if c != "count"])


@query(with_sql(TURNS, RATED) + describe_sql("satisfaction_mean", "rated"))
def describe_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.describe(rated_turns(spark, sf_dir), F.col("satisfaction_mean")))


@query(describe_sql("length(text)", "documents"))
def describe_text_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.describe(table(spark, sf_dir, "documents"), F.length("text")))


@query(describe_sql("value", "events"))
def describe_event_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.describe(table(spark, sf_dir, "events"), F.col("value")))


@query(
    with_sql(TURNS, CONTEXT)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null, "
        f"round((count(*) - count({c})) / count(*)::DOUBLE, 6) AS null_rate FROM ctx"
        for c in ("dataset", "conv_id", "turn_id", "speaker", "text", "is_overall", "scores", "last_system_text")
    )
)
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    nulls = profile.null_profile(add_last_system_text(turns(spark, sf_dir)))
    return nulls.withColumn("null_rate", F.round("null_rate", 6))


@query("SELECT count(*) - count(DISTINCT (user_id, event_type)) AS n_duplicates FROM events")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.duplicate_keys(table(spark, sf_dir, "events"), ["user_id", "event_type"])


@query(with_sql(TURNS, RATED) + "SELECT round(avg(satisfaction_mean), 6) AS mean FROM rated")
def column_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.column_mean(rated_turns(spark, sf_dir), "satisfaction_mean").select(F.round("mean", 6).alias("mean"))


@query(
    """SELECT user_id, event_type, event_id, value
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events) WHERE rn = 1"""
)
def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    return profile.first_per_key(events, ["user_id"], ["event_id"])


@query(with_sql(TURNS, CONTEXT) + f"SELECT {KEY_SQL}, speaker, text, last_system_text FROM ctx")
def last_system_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_last_system_text(turns(spark, sf_dir)).select(*KEY, "speaker", "text", "last_system_text")


@query(
    """SELECT event_id, user_id, event_type, value, last_value(CASE WHEN event_type = 'error' THEN value END IGNORE NULLS)
      OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_error_value
    FROM events"""
)
def last_error_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forward fill over long groups, cut into chunks whose last value is carried over."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    error = F.when(F.col("event_type") == "error", F.col("value"))
    return forward_fill(events, error, "last_error_value", ["user_id"], "event_id", chunk=1000)


@query(
    with_sql(TURNS)
    + """SELECT dataset, conv_id, string_agg(CASE speaker WHEN 'USER' THEN 'User' WHEN 'SYSTEM' THEN 'System' ELSE 'Bot' END
      || ': ' || text, chr(10) ORDER BY turn_id) AS snippet
    FROM (SELECT *, row_number() OVER (PARTITION BY dataset, conv_id ORDER BY turn_id) AS rank FROM turns)
    WHERE rank <= 14 GROUP BY dataset, conv_id"""
)
def conversation_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts(turns(spark, sf_dir))


@query(
    with_sql(TURNS)
    + f"""SELECT {KEY_SQL}, text FROM turns WHERE (dataset, conv_id) IN (
      SELECT (dataset, conv_id) FROM (SELECT DISTINCT dataset, conv_id FROM turns)
      ORDER BY md5('42|' || dataset || '|' || conv_id), dataset, conv_id LIMIT 80)"""
)
def sample_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_convs(turns(spark, sf_dir), 80, seed=42).select(*KEY, "text")


@query(
    with_sql(TURNS, RATED)
    + f"""SELECT {KEY_SQL}, text, round(satisfaction_mean, 6) AS satisfaction_mean FROM rated
    WHERE satisfaction_mean IS NOT NULL ORDER BY rated.satisfaction_mean, {KEY_SQL} LIMIT 20"""
)
def lowest_rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A look at the twenty turns with the lowest mean rating."""
    rated = rated_turns(spark, sf_dir).filter("satisfaction_mean is not null")
    mean = F.round("satisfaction_mean", 6).alias("satisfaction_mean")
    return profile.preview(rated, 20, ["satisfaction_mean", *KEY]).select(*KEY, "text", mean)


@query("SELECT doc_id, lang, source, n_chars FROM documents ORDER BY md5('7|' || doc_id), doc_id LIMIT 800")
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_n_rows(table(spark, sf_dir, "documents"), 800, 7, ["doc_id"]).select(
        "doc_id", "lang", "source", "n_chars"
    )


@query(
    with_sql(TURNS, RATED, TAGGED)
    + """SELECT issue, count(*) AS n FROM (SELECT unnest(issues) AS issue FROM tagged) GROUP BY issue
    ORDER BY n DESC, issue LIMIT 10"""
)
def issue_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.issue_counts(tagged_turns(spark, sf_dir))


@query(
    with_sql(TURNS, RATED, TAGGED)
    + """SELECT (SELECT count(*) FROM tagged WHERE len(issues) > 0) AS n_tagged,
      (SELECT count(*) FROM (SELECT dataset, conv_id, turn_id FROM tagged WHERE low_satisfaction
        EXCEPT SELECT dataset, conv_id, turn_id FROM tagged WHERE len(issues) > 0)) AS n_missing"""
)
def tag_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = tagged_turns(spark, sf_dir)
    missing = profile.missing_keys(tagged.filter("low_satisfaction"), tagged).agg(F.count("*")).scalar()
    return profile.tagged_turn_count(tagged).withColumn("n_missing", missing)


@query(
    with_sql(TURNS, RATED, TAGGED)
    + f"""SELECT {KEY_SQL}, array_to_string(issues, '|') AS issues,
      len(list_filter(issues, lambda x: x <> 'SUCCESS_BEST_PRACTICE')) > 0 AS real_issue FROM tagged
    WHERE len(issues) > 0"""
)
def cluster_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues = F.col("issues")
    return (
        tagged_turns(spark, sf_dir)
        .filter(has_issues(issues))
        .select(*KEY, joined("issues").alias("issues"), has_real_issue(issues).alias("real_issue"))
    )
