"""Training-data pipeline: each stage takes the documents that the one before kept.

quality -> line_dedup -> near_dedup -> decontaminate -> pack
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnlens.llm.common import table
from turnlens.llm.decontaminate import contaminated
from turnlens.llm.line_dups import dedup_lines
from turnlens.llm.near_dups import near_duplicates
from turnlens.llm.packing import pack
from turnlens.llm.quality import Voting, in_fold, score_quality
from turnlens.sources.tables import pin

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Number of a row inside a stage; ids may be null or shared.
ROW = "pipeline_row"


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` as a table with a number for each row, so that decisions meet the row they were made for."""
    return pin(docs.withColumn(ROW, F.monotonically_increasing_id()), f"pipeline-{name}-rows")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Each row is scored by its own text, whatever its id; null and empty texts have a score too, and
    repeated rows the same. Very long texts are read whole. Without any document none is returned,
    other columns are kept as they are.
    """
    scored = score_quality(docs, table(spark, sf_dir, "labels"), ~in_fold("doc_id", 5, 0))
    return scored.filter(F.col("quality_score") >= Voting().threshold).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds; none is left out.

    Null texts stay null, empty ones empty; a null id counts as the last; of repeated rows the first
    keeps its lines. Very long texts are read whole, other columns are kept as they are.
    """
    return dedup_lines(docs).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class: that with the smallest id, of repeated rows one.

    Rows with a null id are in classes like others and stay only if their class has no other id.
    Null and empty texts are equal to each other. Very long texts are read whole, other columns are
    kept as they are.
    """
    rows = numbered(docs, "near_dedup")
    kept = near_duplicates(rows, row_col=ROW).filter("kept").select(F.col("row").alias(ROW))
    return rows.join(kept, ROW, "left_semi").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which no benchmark item was found.

    Each row is searched and kept by its own text, whether its id is null, shared or repeated.
    Null and empty texts hold no item and stay. Very long texts are searched whole, other columns
    are kept as they are.
    """
    rows = numbered(docs, "decontaminate")
    leaks = contaminated(rows, table(spark, sf_dir, "benchmark"), id_col=ROW).select(ROW).distinct()
    return rows.join(leaks, ROW, "left_anti").select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces of sequences of at most 2048 tokens.

    Null and empty texts are one end token each, repeated rows are packed once each, and very long
    texts are cut over many sequences; other columns are not read.
    """
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", packed),
]

#: The stages need models and alignments that SQL cannot express; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
