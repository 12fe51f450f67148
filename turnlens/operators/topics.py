"""Topics of bad turns: selection, clustering, labels, summaries, attachment to turns."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnlens.functions.text import topic_label
from turnlens.functions.values import empty_strings, has_issues, has_real_issue, listed
from turnlens.operators.sweep import sweep
from turnlens.operators.vectors import EmbedFn, assign_topics, embed_texts
from turnlens.schemas import (
    CLUSTERING_COLUMNS,
    KEY,
    UNCLUSTERED_ID,
    UNCLUSTERED_LABEL,
    ensure_column,
    require_columns,
)
from turnlens.sources.tables import broadcast_if_small, pin


class Topics(NamedTuple):
    rows: DataFrame
    summary: DataFrame
    turns: DataFrame


def is_clusterable(strict: bool = False) -> Column:
    """Low user turns with a real failure; the strict rules take any non-empty issue list."""
    flag, wanted = ("low_satisfaction_llm", has_issues) if strict else ("low_satisfaction", has_real_issue)
    return F.col("speaker").eqNullSafe("USER") & F.col(flag).eqNullSafe(True) & wanted(F.col("issues"))


def select_cluster_rows(tagged: DataFrame, strict: bool = False) -> DataFrame:
    """Rows to cluster. Issues may be lists, texts or list literals."""
    df = ensure_column(ensure_column(tagged, "severity", F.lit("")), "reason", F.lit(""))
    read = df.withColumn("issues", listed(df, "issues"))
    return read.filter(is_clusterable(strict)).select(*KEY, "text", "issues", "severity", "reason")


def in_turn_order(rows: DataFrame) -> DataFrame:
    """``rows`` with ``seq``, a number that grows with the turn key, as a table of its own.

    One range shuffle orders them; then counts, first appearances and first texts need the number
    only, which hash aggregates hold in place.
    """
    if "seq" in rows.columns:
        return rows
    wanted = rows.select("topic_id", *KEY, *[c for c in ("issues", "text", "reason") if c in rows.columns])
    return pin(wanted.orderBy(*KEY).withColumn("seq", F.monotonically_increasing_id()), "turn-order")


def rank_issues(rows: DataFrame, n: int) -> DataFrame:
    """Most frequent issues per topic, ties by first appearance in turn order."""
    # Row number and place in the list as one number; a decimal has room for both.
    place = F.col("seq").cast("decimal(20,0)") * F.lit(10**9).cast("decimal(10,0)") + F.col("pos")
    counted = (
        in_turn_order(rows)
        .select("topic_id", "seq", F.posexplode("issues").alias("pos", "issue"))
        .groupBy("topic_id", "issue")
        .agg(F.count("*").alias("n"), F.min(place.cast("decimal(38,0)")).alias("first_seen"))
    )
    by_count = Window.partitionBy("topic_id").orderBy(F.desc("n"), "first_seen")
    ranked = counted.withColumn("rank", F.row_number().over(by_count)).filter(F.col("rank") <= n)
    return ranked.groupBy("topic_id").agg(_in_rank_order("issue").alias("top_issues"))


def first_examples(rows: DataFrame, n: int) -> DataFrame:
    """First texts per topic in turn order; groups are cut to ``n`` rows before the shuffle."""
    in_order = Window.partitionBy("topic_id").orderBy("seq")
    cut = (
        in_turn_order(rows)
        .select("topic_id", "seq", "text")
        .withColumn("rank", F.row_number().over(in_order))
        .filter(F.col("rank") <= n)
    )
    return cut.groupBy("topic_id").agg(_in_rank_order("text").alias("example_texts"))


def _in_rank_order(value: str) -> Column:
    pairs = F.array_sort(F.collect_list(F.struct("rank", F.coalesce(value, F.lit("")).alias("v"))))
    return F.transform(pairs, lambda x: x["v"])


def summarize_topics(rows: DataFrame, n_issues: int = 3, n_examples: int = 3, strict: bool = False) -> DataFrame:
    """One row per topic: label, size, top issues, example texts and a reason.

    The label always shows the two most frequent issues. The reason is the first
    non-empty one in turn order; the text ``nan`` does not count (in any case, or
    only in lower case under the strict rules).
    """
    reason = F.col("reason") if strict else F.lower("reason")
    given = (F.col("reason") != "") & (reason != "nan")
    rows = in_turn_order(rows)
    sizes = rows.groupBy("topic_id").agg(
        F.count("*").alias("n_examples"), F.min(F.when(given, F.col("seq"))).alias("seq")
    )
    # One row for each topic looks up its reason.
    sizes = sizes.join(rows.select("seq", F.col("reason").alias("example_reason")), "seq", "left")
    sizes = sizes.withColumn("example_reason", F.coalesce("example_reason", F.lit("")))
    issues = F.coalesce("top_issues", empty_strings())
    return (
        sizes.join(rank_issues(rows, max(n_issues, 2)), "topic_id", "left")
        .join(first_examples(rows, n_examples), "topic_id", "left")
        .select(
            "topic_id",
            topic_label(F.col("topic_id"), issues).alias("topic_label"),
            "n_examples",
            F.slice(issues, 1, n_issues).alias("top_issues"),
            F.coalesce("example_texts", empty_strings()).alias("example_texts"),
            "example_reason",
        )
    )


def label_topics(rows: DataFrame) -> DataFrame:
    """``(topic_id, topic_label)`` for every topic."""
    ids = rows.select("topic_id").distinct()
    top = ids.join(rank_issues(rows, 2), "topic_id", "left")
    label = topic_label(F.col("topic_id"), F.coalesce("top_issues", empty_strings()))
    return top.select("topic_id", label.alias("topic_label"))


def attach_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels on clustered rows; the label table is broadcast once a count shows it is small."""
    return rows.join(broadcast_if_small(labels.select("topic_id", "topic_label")), "topic_id", "left")


def attach_topics(
    turns: DataFrame, rows: DataFrame, labels: DataFrame, candidates: Column | None = None
) -> DataFrame:
    """``topic_id`` and ``topic_label`` on all turns, sentinels where unclustered.

    Labels join the clustered rows first, so turns are shuffled once, on their key, and
    never on the topic id, where most rows would share one value. With ``candidates``,
    a condition that every clustered turn meets, the other turns are not shuffled.
    """
    one_each = rows.groupBy(*KEY).agg(F.min("topic_id").alias("topic_id"))  # of several topics of a turn the smallest
    labelled = attach_labels(one_each, labels)
    base = turns.drop("topic_id", "topic_label")
    if candidates is None:
        joined = base.join(labelled, KEY, "left")
    else:
        nothing = {f.name: F.lit(None).cast(f.dataType) for f in labelled.schema.fields if f.name not in KEY}
        found = base.filter(candidates).join(labelled, KEY, "left")
        joined = found.unionByName(base.filter(~candidates).withColumns(nothing))
    return joined.withColumns(
        {
            "topic_id": F.coalesce("topic_id", F.lit(UNCLUSTERED_ID)),
            "topic_label": F.when(F.col("topic_id") < 0, UNCLUSTERED_LABEL).otherwise(
                F.coalesce("topic_label", F.lit(UNCLUSTERED_LABEL))
            ),
        }
    )


def topic_counts(turns: DataFrame) -> DataFrame:
    return turns.groupBy("topic_id", "topic_label").agg(F.count("*").alias("n"))


def build_topics(
    tagged: DataFrame,
    rows: DataFrame,
    n_issues: int = 3,
    n_examples: int = 3,
    strict: bool = False,
    candidates: Column | None = None,
) -> Topics:
    """Summary and attachment for rows that already have a ``topic_id``."""
    summary = pin(summarize_topics(rows, n_issues, n_examples, strict), "topics-summary")
    turns = attach_topics(tagged, rows, summary, candidates)
    if strict:
        kept = attach_labels(rows, summary).withColumnRenamed("text", "cluster_text")
        out = kept.select(*KEY, "topic_id", "topic_label", "issues", "severity", "reason", "cluster_text")
    else:
        out = rows.select(*KEY, "topic_id", "text")
    return Topics(out, summary, turns)


def cluster_topics(
    tagged: DataFrame,
    embed_fn: EmbedFn | None = None,
    k: int | None = 6,
    seed: int = 42,
    strict: bool = False,
    k_range: tuple[int, int] = (4, 10),
) -> Topics:
    """Cluster the bad turns into ``k`` topics, or with None into the best ``k`` of ``k_range``.

    Embeddings are written once before k-means iterates over them. All rows are
    clustered. The strict rules keep five issues and five examples per topic, else three.
    """
    if not strict:
        require_columns(tagged, CLUSTERING_COLUMNS, "tagged turns")
    tagged = tagged.withColumn("issues", listed(tagged, "issues"))
    chosen = select_cluster_rows(tagged, strict)
    embedded = pin(embed_texts(chosen, embed_fn), "embedded")
    if embedded.isEmpty():
        raise ValueError("no rows to cluster: check the low satisfaction flag and the issue lists")
    if k is None:
        models = sweep(embedded, range(k_range[0], k_range[1] + 1), seed)
        placed = models.assign(embedded, models.best)
    else:
        placed = assign_topics(embedded, k, seed)
    rows = pin(placed.drop("embedding"), "topic-rows")
    n = 5 if strict else 3
    return build_topics(tagged, rows, n, n, strict, is_clusterable(strict))
