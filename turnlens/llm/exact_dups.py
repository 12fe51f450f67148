"""Exact duplicates by a tree merge of sorted digest runs, in DataFrame operations only.

Every input partition makes a run: one row per digest with the smallest identifier and a
count. Rounds of a binomial tree (``fan_in`` runs at a time) merge runs by sorting them
together and combining equal digests. The digest space is cut into ranges and every range
has a tree of its own, so even the last round is spread over all executors; a text that a
third of all rows share is one row per run before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnlens.llm.common import text_or_empty
from turnlens.sources.tables import pin

#: What must agree besides the digest: a second hash and the length verify every merge.
KEY = ["digest", "n_bytes", "second"]


def normalised(column: str = "text"):
    """Runs of ASCII white space become one space; nothing else changes."""
    return F.regexp_replace(text_or_empty(column), r"[\x20\x09-\x0D]+", " ")


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, id, digest, n_bytes, second, run: the narrow table that all rounds work on."""
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.spark_partition_id().alias("run"),
        F.col(id_col).alias("id"),
        normalised(text_col).alias("norm"),
    )
    return texts.select(
        "row",
        "run",
        "id",
        F.unhex(F.sha2("norm", 256)).alias("digest"),
        F.octet_length("norm").alias("n_bytes"),
        F.xxhash64("norm").alias("second"),
    )


def merge_runs(rows: DataFrame, fan_in: int = 8, ranges: int | None = None) -> DataFrame:
    """The root run: KEY, keep (no_id, id, row) and group_size, one row per distinct text."""
    spark = rows.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = (rows.agg(F.max("run")).first()[0] or 0) + 1
    merged = (
        rows.withColumn("range", F.pmod("second", F.lit(ranges)))
        .groupBy("range", "run", *KEY)
        .agg(
            F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("keep"),
            F.count(F.lit(1)).alias("group_size"),
        )
    )
    while runs > 1:
        merged = (
            merged.withColumn("run", F.floor(F.col("run") / fan_in))
            .repartition("range", "run")
            .sortWithinPartitions("range", "run", *KEY)
            .groupBy("range", "run", *KEY)
            .agg(F.min("keep").alias("keep"), F.sum("group_size").alias("group_size"))
        )
        runs = -(-runs // fan_in)
    return merged.select(*KEY, "keep", "group_size")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 8) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after runs of ASCII white space become one space.
    Of equal texts the row with the smallest id stays; a null id comes after all others. Of
    repeated rows with the same id exactly one stays. Null texts count as empty texts, which
    equal each other. Very long texts are hashed whole. An empty table gives an empty result.
    Columns other than the two named ones are not read, so their names cannot clash.
    """
    rows = pin(digest_rows(docs, id_col, text_col), "digests")
    root = merge_runs(rows, fan_in)
    joined = rows.drop("run").join(root, KEY)
    return joined.select(
        F.col("id").alias(id_col),
        F.col("keep.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
