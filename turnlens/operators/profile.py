"""Data profiles: counts, shares, null rates, summaries, key checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlens.functions.values import has_issues
from turnlens.operators.ranks import brackets, quantile_points, values_at_ranks
from turnlens.schemas import CONV, KEY, UNCLUSTERED_ID, first_existing

QUARTILES = (0.25, 0.5, 0.75)


def quick_stats(turns: DataFrame) -> DataFrame:
    """Rows, conversations, overall lines and rows per speaker, as ``(metric, value)``."""
    by_speaker = turns.groupBy("speaker").count()
    totals = turns.agg(
        F.count("*").alias("rows"),
        F.countDistinct("conv_id").alias("conversations"),
        F.coalesce(F.sum(F.col("is_overall").cast("long")), F.lit(0)).alias("overall_lines"),
    )
    names = ", ".join(f"'{c}', {c}" for c in totals.columns)
    metrics = totals.select(F.expr(f"stack({len(totals.columns)}, {names}) as (metric, value)"))
    speakers = by_speaker.select(F.concat(F.lit("speaker="), "speaker").alias("metric"), F.col("count").alias("value"))
    return metrics.unionByName(speakers)


def distinct_conversations(turns: DataFrame) -> DataFrame:
    return turns.select(*CONV).distinct()


def value_counts(df: DataFrame, columns: list[str], dropna: bool = True) -> DataFrame:
    """Rows per value combination, most frequent first; rows with nulls are left out unless ``dropna=False``."""
    kept = df.dropna(subset=columns) if dropna else df
    return kept.groupBy(*columns).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *columns)


def value_shares(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of rows per value combination among rows without nulls."""
    total = df.dropna(subset=columns).agg(F.count("*")).scalar()
    return value_counts(df, columns).select(*columns, (F.col("n") / total).alias("share"))


def flag_summary(turns: DataFrame, flag: str = "low_satisfaction") -> DataFrame:
    """Rows, low rows and low ratio per dataset."""
    low = F.col(flag).cast("int")
    return turns.groupBy("dataset").agg(
        F.count("*").alias("n_rows"), F.sum(low).alias("n_low"), F.avg(low).alias("low_ratio")
    )


def column_mean(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.avg(column).alias("mean"))


def describe(df: DataFrame, value: Column, buckets: int = 1000) -> DataFrame:
    """Count, mean, standard deviation, min, exact quartiles and max of a number column.

    The quartiles interpolate between neighbouring ranks. One pass takes the figures and brackets
    for the quartiles, a second one counts below the brackets and moves only the values inside. A bracket with more
    than 50 times ``buckets`` different values is narrowed again; that decides no result.
    """
    values = df.select(value.cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    stats = values.agg(
        F.count("*").alias("count"),
        F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        quantile_points(list(QUARTILES)).alias("around"),
    ).first()
    spark, n = df.sparkSession, stats["count"]
    fields = "count bigint, mean double, std double, min double, q25 double, q50 double, q75 double, max double"
    if n == 0:
        return spark.createDataFrame([(0,) + (None,) * 7], fields)
    wanted = sorted({rank for q in QUARTILES for rank in (int(q * (n - 1)), min(int(q * (n - 1)) + 1, n - 1))})
    at = values_at_ranks(values, n, wanted, brackets(stats["around"], list(QUARTILES), n), 50 * buckets)
    quartiles = []
    for q in QUARTILES:
        low = int(q * (n - 1))
        high = min(low + 1, n - 1)
        quartiles.append(at[low].value + (at[high].value - at[low].value) * (q * (n - 1) - low))
    row = (n, stats["mean"], stats["std"], stats["min"], *quartiles, stats["max"])
    return spark.createDataFrame([row], fields)


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and null rate per column, in one pass."""
    aggregates = [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    totals = df.agg(F.count("*").alias("_rows"), *aggregates)
    names = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    stacked = totals.select("_rows", F.expr(f"stack({len(df.columns)}, {names}) as (column_name, n_null)"))
    rate = F.try_divide("n_null", "_rows").alias("null_rate")
    return stacked.select("column_name", "n_null", rate)


def duplicate_keys(df: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Number of rows after the first of their key."""
    per_key = df.groupBy(*key).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"))


def first_per_key(df: DataFrame, key: list[str], order_by: list[str]) -> DataFrame:
    """The first row of every key in the given order."""
    others = [c for c in df.columns if c not in key]
    first = F.min_by(F.struct(*others), F.struct(*order_by)).alias("row")
    return df.groupBy(*key).agg(first).select(*key, "row.*")


def score_coverage(turns: DataFrame, score: str = "llm_satisfaction_score", flag: str = "low_satisfaction_llm") -> DataFrame:
    """Share of USER turns with a score, and share of low turns among those scored."""
    scored = F.col(score).isNotNull()
    return turns.filter(F.col("speaker") == "USER").agg(
        F.avg(scored.cast("int")).alias("scored_coverage"),
        F.avg(F.when(scored, F.col(flag).cast("int"))).alias("low_rate"),
    )


def score_histogram(turns: DataFrame, score: str = "llm_satisfaction_score") -> DataFrame:
    """Scored USER turns per score, in score order."""
    scored = turns.filter((F.col("speaker") == "USER") & F.col(score).isNotNull())
    return scored.groupBy(score).agg(F.count("*").alias("n")).orderBy(score)


def issue_counts(turns: DataFrame, n: int | None = 10) -> DataFrame:
    """Most frequent issue labels (all of them with ``n=None``), ties by label."""
    counts = turns.select(F.explode("issues").alias("issue")).groupBy("issue").agg(F.count("*").alias("n"))
    ordered = counts.orderBy(F.desc("n"), "issue")
    return ordered if n is None else ordered.limit(n)


def tagged_turn_count(turns: DataFrame) -> DataFrame:
    return turns.agg(F.count_if(has_issues(F.col("issues"))).alias("n_tagged"))


def topic_turn_count(turns: DataFrame) -> DataFrame:
    return turns.agg(F.count_if(F.col("topic_id") > UNCLUSTERED_ID).alias("n_assigned"))


def missing_keys(tags: DataFrame, merged: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Keys that were tagged but carry no issues after the join (none when the join is whole)."""
    covered = merged.filter(has_issues(F.col("issues"))).select(*key)
    return tags.select(*key).distinct().join(covered, key, "left_anti")


def preview(df: DataFrame, n: int, order_by: list | None = None) -> DataFrame:
    """First ``n`` rows, in the given order if there is one."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def pick_flag(df: DataFrame) -> Column:
    """The model flag if the table has one, else the dataset flag, else null."""
    name = first_existing(df, ["low_satisfaction_llm", "low_satisfaction"])
    return F.lit(None).cast("boolean") if name is None else F.col(name)
