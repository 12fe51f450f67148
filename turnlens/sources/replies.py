"""Response cache: a keyed store of model replies in Parquet.

Every write is a part of its own, named after its number, and inside a part the replies lie in
folders by task, model and a hash of their key. A lookup reads the folders of its task and model
only, and of those the replies to what is asked; nothing else is aggregated. Parts that are not
finished are not seen. Compaction puts all finished parts into one and keeps the newest replies.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnlens.functions.replies import parse_reply
from turnlens.schemas import REPLIES_SCHEMA
from turnlens.sources.dialogue import read_lines
from turnlens.sources.tables import delete_path, list_folders, path_exists, table_exists

#: Error name of a reply that parses but that the caller's rules refuse.
INVALID_REPLY = "InvalidReply"

#: Folders that the keys of one task and model are dealt to.
KEY_BUCKETS = 8
FOLDERS = ["task", "model", "bucket"]
STORED_SCHEMA = T.StructType([*REPLIES_SCHEMA.fields, T.StructField("bucket", T.IntegerType())])


def key_bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).cast("int")


def finished_parts(spark: SparkSession, path: str) -> list[str]:
    """Paths of all parts whose write has ended, oldest first."""
    if not path_exists(spark, path):
        return []
    return sorted(p for p in list_folders(spark, path) if "/part_id=" in p and table_exists(spark, p))


def _number(part: str) -> int:
    return int(part.rpartition("part_id=")[2].split("-")[0])


def next_number(spark: SparkSession, path: str) -> int:
    """One more than any finished part has; taken from the names, without reading a reply."""
    return max(map(_number, finished_parts(spark, path)), default=0) + 1


def _read_parts(spark: SparkSession, path: str, parts: list[str]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], STORED_SCHEMA)
    stored = spark.read.schema(STORED_SCHEMA).option("basePath", path.rstrip("/")).parquet(*parts)
    return stored.select(*STORED_SCHEMA.fieldNames())


def stored_replies(spark: SparkSession, path: str, task: str | None = None, model: str | None = None) -> DataFrame:
    """All finished rows with their bucket, of one task and model if given; other folders are not read."""
    rows = _read_parts(spark, path, finished_parts(spark, path))
    for column, wanted in (("task", task), ("model", model)):
        if wanted is not None:
            rows = rows.filter(F.col(column) == wanted)
    return rows


def read_cache(spark: SparkSession, path: str, task: str | None = None, model: str | None = None) -> DataFrame:
    """All rows of finished parts; an empty table when nothing was written yet."""
    return stored_replies(spark, path, task, model).drop("bucket")


def _write_part(df: DataFrame, path: str, number: int) -> str:
    part = f"{path.rstrip('/')}/part_id={number:012d}-{uuid.uuid4().hex}"
    keyed = df.select(*REPLIES_SCHEMA.fieldNames()).withColumn("bucket", key_bucket(F.col("request_key")))
    # One file for each folder, not one from every task that called the model.
    keyed.repartition(*FOLDERS).write.partitionBy(*FOLDERS).parquet(part)
    return part


def append_cache(df: DataFrame, path: str, number: int | None = None) -> DataFrame:
    """Append rows as a part of their own and read that part back.

    Parallel runs do not see each other's unfinished parts.
    """
    spark = df.sparkSession
    part = _write_part(df, path, next_number(spark, path) if number is None else number)
    return _read_parts(spark, path, [part]).drop("bucket")


def compact_cache(spark: SparkSession, path: str) -> int:
    """Put all finished parts into one with the newest row of each task, model and key; how many there were.

    The parts go only when the new one is finished. Until then, and if the run dies in between,
    rows are found twice, which changes no lookup. Parts written meanwhile stay as they are.
    """
    parts = finished_parts(spark, path)
    if len(parts) > 1:
        newest = latest(_read_parts(spark, path, parts).drop("bucket"), ["task", "model", "request_key"])
        _write_part(newest, path, max(map(_number, parts)))
        for part in parts:
            delete_path(spark, part)
    return len(parts)


def lookup(requests: DataFrame, stored: DataFrame) -> DataFrame:
    """Usable replies to ``requests`` among ``stored`` rows (with their bucket).

    The stored rows are cut to the keys asked for before anything is aggregated: whole buckets
    by partition pruning, rows by the semi join, which Spark prepares with a bloom filter of the
    requests where that pays.
    """
    keys = requests.select(key_bucket(F.col("request_key")).alias("bucket"), "request_key")
    return usable(stored.join(keys, ["bucket", "request_key"], "left_semi").drop("bucket"))


def numbered_lines(lines: DataFrame) -> DataFrame:
    """``lines`` with ``line_no``, from 1 over all files in path order.

    Splits are numbered on their own; one row for each split carries the sums over.
    """
    sizes = lines.groupBy("file", "split").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("file", "split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("file", "split", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    in_split = F.row_number().over(Window.partitionBy("file", "split").orderBy("pos"))
    placed = lines.withColumn("in_split", in_split).join(offsets, ["file", "split"])
    return placed.withColumn("line_no", F.col("offset") + F.col("in_split")).drop("offset", "in_split")


def import_cache_jsonl(spark: SparkSession, path: str, task: str = "satisfaction_score") -> DataFrame:
    """Cache rows from JSON Lines with ``key``, ``model``, ``score`` and ``reason``.

    Every line with a key is a row. ``seq`` follows file and line order and ends at 0, so the
    last line of a key wins, and every reply of a run, which counts from 1, wins over it.
    """
    line = F.from_json("value", "key string, model string, score int, reason string")
    numbered = numbered_lines(read_lines(spark, path))
    total = F.broadcast(numbered.agg(F.max("line_no").alias("total")))  # one row
    parsed = numbered.crossJoin(total).withColumn("line", line).filter("line.key is not null")
    return parsed.select(
        F.col("line.key").alias("request_key"),
        F.lit(task).alias("task"),
        F.col("line.model").alias("model"),
        F.to_json(F.struct("line.score", "line.reason")).alias("response_json"),
        F.lit(None).cast("string").alias("error"),
        (F.col("line_no") - F.col("total")).cast("long").alias("seq"),
    )


def import_cache_folder(spark: SparkSession, path: str, task: str, model: str) -> DataFrame:
    """Cache rows from a folder of ``<sha256>.json`` files holding one reply each."""
    files = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True)
    return files.select(
        F.regexp_extract("_metadata.file_name", r"^(.*)\.json$", 1).alias("request_key"),
        F.lit(task).alias("task"),
        F.lit(model).alias("model"),
        F.col("value").alias("response_json"),
        F.lit(None).cast("string").alias("error"),
        F.lit(0).cast("long").alias("seq"),
    )


def latest(cache: DataFrame, key: list[str] = ["request_key"]) -> DataFrame:
    """The newest row per key (highest ``seq``), combined before the shuffle."""
    others = [c for c in REPLIES_SCHEMA.fieldNames() if c not in key]
    # Two runs at the same time may share a number: then a reply wins over an error, and the rest is by value.
    order = F.struct("seq", F.col("error").isNull(), "response_json")
    row = F.max_by(F.struct(*others), order).alias("row")
    return cache.groupBy(*key).agg(row).select(*key, "row.*").select(*REPLIES_SCHEMA.fieldNames())


def usable(cache: DataFrame) -> DataFrame:
    """Newest replies that parse and were not refused; anything else counts as never asked."""
    refused = F.col("error").eqNullSafe(INVALID_REPLY)
    return latest(cache).filter(parse_reply(F.col("response_json")).isNotNull() & ~refused)
