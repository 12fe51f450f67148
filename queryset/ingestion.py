"""Dialogue parsing, corpus flags, list and number normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queryset.adapter import RATED, TURNS, joined, rated_turns, strip, table, turns, with_sql
from queryset.registry import query
from turnlens.functions.values import (
    array_mean,
    clean_entries,
    join_entries,
    normalize_list_text,
    parse_scores,
    to_numeric,
    to_numeric_id,
)
from turnlens.operators.profile import flag_summary
from turnlens.operators.satisfaction import flag_rated_turns
from turnlens.plans.corpus import build_corpus, union_corpora
from turnlens.schemas import KEY
from turnlens.sources.dialogue import enrich, load_dialogue, parse_dialogue
from turnlens.sources.exports import export_jsonl, read_jsonl
from turnlens.sources.tables import materialize, scratch_path

SCORE_TEXT = """CASE WHEN scores IS NULL THEN '' WHEN turn_id = 3 THEN '3,x' WHEN turn_id = 5 THEN ' 3, 4 '
    WHEN turn_id = 7 THEN '2,' ELSE array_to_string(scores, ',') END"""


def score_text():
    t = F.col("turn_id")
    return (
        F.when(F.col("scores").isNull(), "")
        .when(t == 3, "3,x")
        .when(t == 5, " 3, 4 ")
        .when(t == 7, "2,")
        .otherwise(F.array_join("scores", ","))
    )


def dialogue_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations written as dialogue lines: one file per dataset, conversations cut by split borders."""
    c, t = F.col("conv_id"), F.col("turn_id")
    text = F.when(F.col("is_overall"), "OVERALL").otherwise(F.translate("text", "\n\t", "  "))
    act = F.when(t % 3 == 0, "INFORM").when(t % 3 == 1, "").otherwise("REQUEST")
    line = F.concat_ws("\t", "speaker", text, act, score_text())
    blanks = F.when(c % 4 == 0, F.array(F.lit(""), F.lit(" \t "))).otherwise(F.array(F.lit(" ")))
    lines = F.when(t == 1, F.concat(blanks, F.array(line))).otherwise(F.array(line))
    return turns(spark, sf_dir).select(
        F.col("dataset").alias("file"),
        F.floor((c * 8 + t) / 5).alias("split"),
        c,
        t,
        F.posexplode(lines).alias("j", "value"),
    ).select("file", "split", (c * 100 + t * 10 + F.col("j")).alias("pos"), "value")


LINES = f"""lines AS (
  SELECT dataset AS file, conv_id * 100 + turn_id * 10 + 5 AS pos,
    speaker || chr(9) || CASE WHEN is_overall THEN 'OVERALL' ELSE translate(text, chr(10) || chr(9), '  ') END
      || chr(9) || CASE turn_id % 3 WHEN 0 THEN 'INFORM' WHEN 1 THEN '' ELSE 'REQUEST' END
      || chr(9) || {SCORE_TEXT} AS value FROM turns
  UNION ALL SELECT dataset, conv_id * 100 + turn_id * 10, '' FROM turns WHERE turn_id = 1)"""


def parse_sql(tag: str, scores: bool, strip_raw: bool, overall: bool, closes: bool) -> str:
    """Sequential reading of the lines, as one ordered window."""
    raw = "coalesce(string_split(value, chr(9))[4], '')" if scores else "NULL"
    is_overall = "string_split(value, chr(9))[1] = 'USER' AND string_split(value, chr(9))[2] = 'OVERALL'"
    kept = strip(raw) if strip_raw else raw
    breaks = f"blank OR ({is_overall})" if closes else "blank"
    return with_sql(
        TURNS,
        LINES,
        f"flagged AS (SELECT *, {breaks} AS brk FROM (SELECT *, {strip('value')} = '' AS blank FROM lines))",
        """started AS (SELECT *, NOT blank AND coalesce(lag(brk) OVER (PARTITION BY file ORDER BY pos), true) AS start
           FROM flagged)""",
        "numbered AS (SELECT *, sum(start::INT) OVER (ORDER BY file, pos) - 1 AS conv FROM started)",
        f"""parsed AS (SELECT conv::BIGINT AS conv_id,
           row_number() OVER (PARTITION BY conv ORDER BY file, pos) AS turn_id,
           string_split(value, chr(9))[1] AS speaker, string_split(value, chr(9))[2] AS text,
           nullif(string_split(value, chr(9))[3], '') AS {tag}, nullif({kept}, '') AS scores_raw,
           CASE WHEN {strip(raw)} = '' THEN NULL ELSE list_transform(string_split({strip(raw)}, ','),
             lambda x: TRY_CAST({strip('x')} AS INT)) END AS nums,
           {is_overall if overall else 'false'} AS is_overall FROM numbered WHERE NOT blank)""",
    ) + f"""SELECT conv_id, turn_id, speaker, text, {tag}, scores_raw,
      CASE WHEN len(list_filter(nums, lambda x: x IS NULL)) = 0 THEN array_to_string(nums, '|') END AS scores, is_overall
      FROM parsed"""


def shown(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("scores", joined("scores"))


@query(parse_sql("dialog_act", True, True, True, False))
def parse_dialogue_sgd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(parse_dialogue(dialogue_lines(spark, sf_dir), "sgd"))


@query(parse_sql("entity_tag", True, True, True, True))
def parse_dialogue_ccpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(parse_dialogue(dialogue_lines(spark, sf_dir), "ccpe"))


@query(parse_sql("dialog_act", False, False, False, False))
def parse_dialogue_redial_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(parse_dialogue(dialogue_lines(spark, sf_dir), "redial_action"))


@query(
    f"SELECT 'mwoz' AS format, * FROM ({parse_sql('dialog_act', True, False, True, False)}) UNION ALL "
    f"SELECT 'redial' AS format, * FROM ({parse_sql('dialog_act', True, False, False, False)})"
)
def parse_dialogue_mwoz_redial(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = dialogue_lines(spark, sf_dir)
    parts = [shown(parse_dialogue(lines, fmt)).select(F.lit(fmt).alias("format"), "*") for fmt in ("mwoz", "redial")]
    return parts[0].unionByName(parts[1])


@query(parse_sql("dialog_act", True, True, True, False))
def load_dialogue_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines written as text files, several per dataset in path order, and read back with the loader."""
    path = scratch_path(spark, "dialogue")
    conversation = F.floor(F.col("pos") / 100)
    lines = dialogue_lines(spark, sf_dir).repartitionByRange("file", conversation).sortWithinPartitions("file", "pos")
    lines.select("file", "value").write.partitionBy("file").text(path)
    return shown(load_dialogue(spark, path, "sgd"))


@query(
    with_sql(TURNS, f"s AS (SELECT {', '.join(KEY)}, {SCORE_TEXT} AS score_text FROM turns)")
    + f"""SELECT {', '.join(KEY)}, array_to_string(ok, '|') AS scores,
      round(list_sum(ok) / len(ok)::DOUBLE, 6) AS satisfaction_mean
    FROM (SELECT *, CASE WHEN len(list_filter(nums, lambda x: x IS NULL)) = 0 THEN nums END AS ok
      FROM (SELECT *, CASE WHEN {strip('score_text')} = '' THEN NULL ELSE list_transform(
        string_split({strip('score_text')}, ','), lambda x: TRY_CAST({strip('x')} AS INT)) END AS nums FROM s))"""
)
def parse_scores_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = turns(spark, sf_dir).select(*KEY, parse_scores(score_text()).alias("scores"))
    mean = F.round(array_mean(F.col("scores")), 6)
    return parsed.select(*KEY, joined("scores").alias("scores"), mean.alias("satisfaction_mean"))


@query(
    with_sql(TURNS, RATED)
    + """SELECT dataset, conv_id, turn_id, speaker, is_overall, round(satisfaction_mean, 6) AS satisfaction_mean,
      low_satisfaction FROM rated"""
)
def corpus_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rated_turns(spark, sf_dir).select(
        *KEY, "speaker", "is_overall", F.round("satisfaction_mean", 6).alias("satisfaction_mean"), "low_satisfaction"
    )


@query(
    with_sql(TURNS, RATED)
    + """SELECT dataset, count(*) AS n_rows, sum(low_satisfaction::INT)::BIGINT AS n_low,
      round(avg(low_satisfaction::INT), 6) AS low_ratio FROM rated GROUP BY dataset"""
)
def corpus_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_summary(rated_turns(spark, sf_dir)).withColumn("low_ratio", F.round("low_ratio", 6))


@query(
    with_sql(TURNS, RATED)
    + """SELECT dataset, conv_id, turn_id, speaker, text, dialog_act, entity_tag,
      coalesce(dialog_act, entity_tag) AS label, low_satisfaction
    FROM (SELECT *, CASE WHEN dataset = 'SGD' THEN upper(speaker) END AS dialog_act,
      CASE WHEN dataset = 'CCPE' THEN lower(speaker) END AS entity_tag FROM rated)"""
)
def union_corpora_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two corpora with different tag columns, enriched, flagged and stacked."""
    base = turns(spark, sf_dir)
    sgd = enrich(base.filter("dataset = 'SGD'").drop("dataset").withColumn("dialog_act", F.upper("speaker")), "SGD")
    ccpe = enrich(base.filter("dataset = 'CCPE'").drop("dataset").withColumn("entity_tag", F.lower("speaker")), "CCPE")
    return build_corpus([sgd, ccpe]).select(
        *KEY, "speaker", "text", "dialog_act", "entity_tag", "label", "low_satisfaction"
    )


@query(
    with_sql(TURNS, RATED)
    + """SELECT dataset, conv_id, turn_id, speaker, low_satisfaction FROM rated"""
)
def flagged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each corpus flagged on its own, then stacked."""
    base = turns(spark, sf_dir).withColumn("satisfaction_mean", array_mean(F.col("scores")))
    parts = [flag_rated_turns(base.filter(F.col("dataset") == name), name) for name in ("SGD", "CCPE")]
    return union_corpora(parts).select(*KEY, "speaker", "low_satisfaction")


@query(
    """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
      TRY_CAST(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS BIGINT) AS k_id,
      TRY_CAST(event_type AS DOUBLE) AS from_name, trunc(value)::BIGINT AS value_id FROM events"""
)
def numeric_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select(
        "event_id",
        to_numeric(k).alias("k"),
        to_numeric_id(k).alias("k_id"),
        to_numeric(F.col("event_type")).alias("from_name"),
        to_numeric_id(F.col("value").cast("string")).alias("value_id"),
    )


LITERAL = """CASE WHEN doc_id % 4 = 0 THEN NULL WHEN doc_id % 4 = 1 THEN ' ' || source || chr(10)
  WHEN doc_id % 4 = 2 THEN '[''' || lang || ''', '' ' || source || ' '', '' '']' ELSE '[' || lang || ']' END"""


@query(
    f"""WITH d AS (SELECT doc_id, lang, source, {LITERAL} AS raw FROM documents),
    parsed AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN [] WHEN doc_id % 4 = 1 THEN [{strip('source')}]
      WHEN doc_id % 4 = 2 THEN [lang, ' ' || source || ' ', ' '] ELSE ['[' || lang || ']'] END AS entries,
      CASE WHEN raw IS NULL THEN [] ELSE [{strip('raw')}] END AS plain FROM d)
    SELECT doc_id, array_to_string(entries, ' | ') AS entries, array_to_string(plain, ' | ') AS plain,
      array_to_string(list_filter(list_transform(entries, lambda x: {strip('x')}), lambda x: x <> ''), ' | ') AS cleaned
    FROM parsed"""
)
def normalize_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List literals, single entries and missing values made from document columns."""
    kind, lang, source = F.col("doc_id") % 4, F.col("lang"), F.col("source")
    quoted = F.concat(F.lit("['"), lang, F.lit("', ' "), source, F.lit(" ', ' ']"))
    raw = (
        F.when(kind == 1, F.concat(F.lit(" "), source, F.lit("\n")))
        .when(kind == 2, quoted)
        .when(kind == 3, F.concat(F.lit("["), lang, F.lit("]")))
    )
    entries = normalize_list_text(raw, literals=True)
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        join_entries(entries).alias("entries"),
        join_entries(normalize_list_text(raw)).alias("plain"),
        join_entries(clean_entries(entries)).alias("cleaned"),
    )


@query(with_sql(TURNS) + f"SELECT {', '.join(KEY)}, speaker, text, is_overall FROM turns")
def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stage table built once, then reused: the second build must not run."""

    def rebuilt():
        raise AssertionError("the finished table was not reused")

    path = scratch_path(spark, "turns")
    materialize(spark, path, lambda: turns(spark, sf_dir).select(*KEY, "speaker", "text", "is_overall"))
    return materialize(spark, path, rebuilt)


@query(
    with_sql(TURNS, RATED)
    + f"""SELECT {', '.join(KEY)}, text, round(satisfaction_mean, 6) AS satisfaction_mean, low_satisfaction FROM rated"""
)
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns written as JSON lines and read back, with null fields kept."""
    mean = F.round("satisfaction_mean", 6).alias("satisfaction_mean")
    out = rated_turns(spark, sf_dir).select(*KEY, "text", mean, "low_satisfaction")
    return read_jsonl(spark, export_jsonl(out, scratch_path(spark, "jsonl")), out.schema)
