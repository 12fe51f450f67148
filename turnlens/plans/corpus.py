"""Build the turn corpus from dialogue files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from turnlens.operators.satisfaction import flag_rated_turns
from turnlens.schemas import conform_turns
from turnlens.sources.dialogue import ingest


def union_corpora(corpora: Sequence[DataFrame]) -> DataFrame:
    """Stack corpora by column name; a column one of them lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), corpora)


def build_corpus(corpora: Sequence[DataFrame]) -> DataFrame:
    """Flag rated turns and stack the corpora in the common turn schema."""
    return conform_turns(union_corpora([flag_rated_turns(df) for df in corpora]))


def ingest_corpus(spark: SparkSession, files: dict[str, tuple[str, str]]) -> DataFrame:
    """Corpus from ``{dataset: (path, format)}``."""
    return build_corpus([ingest(spark, path, fmt, dataset) for dataset, (path, fmt) in files.items()])
