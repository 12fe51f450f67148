"""JSON exports: one object per line, or one pretty array for topic-sized tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnlens.functions.values import join_entries


def export_jsonl(df: DataFrame, path: str) -> str:
    """One JSON object per row; null fields are written, non-ASCII text is kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def read_jsonl(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def json_array(df: DataFrame, order_by: list[str], drop: Sequence[str] = ()) -> DataFrame:
    """One row: the table without ``drop`` as a pretty JSON array, ordered by ``order_by``."""
    record = F.struct(*[c for c in df.columns if c not in drop])
    keyed = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order_by)], record.alias("record"))
    records = F.transform(F.array_sort(F.array_agg(keyed)), lambda x: x["record"])
    options = {"ignoreNullFields": "false", "pretty": "true"}
    return df.agg(F.to_json(records, options).alias("value"))


def export_json_array(
    df: DataFrame, path: str, order_by: list[str], drop: Sequence[str] = ()
) -> str:
    """Write a topic-sized table as one JSON array file.

    A single array is one value made in one task, for tables that a person reads;
    tables that grow with the data go through :func:`export_jsonl`.
    """
    json_array(df, order_by, drop).coalesce(1).write.mode("overwrite").text(path)
    return path


def read_json_array(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def flatten_lists(df: DataFrame) -> DataFrame:
    """Replace every list-of-text column by one text with the entries joined by a bar."""
    flat = {f.name: join_entries(F.col(f.name)) for f in df.schema.fields if f.dataType.simpleString() == "array<string>"}
    return df.withColumns(flat)
