"""Parquet tables: read, write, reuse, and scratch tables that cut lineage."""

from __future__ import annotations

import contextlib
import functools
import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_CONF = "spark.checkpoint.dir"

#: Spark's setting that a query's shuffle files are deleted when the query ends.
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Folder inside a bucketed table that holds its layout.
LAYOUT_FOLDER = "_layout"

#: Tables up to this many rows may be broadcast (topic-sized tables).
SMALL_TABLE_ROWS = 10_000


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own;
    a machine-local folder would not survive the loss of an executor on a cluster.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    return _local_scratch()


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="turnlens-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the scratch folder; every call gives another one."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries run in here leave no shuffle files behind; without it they stay until the driver collects garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP_CONF)
        else:
            spark.conf.set(SHUFFLE_CLEANUP_CONF, before)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Overwrite a Parquet table (parent folders are created); a bucket layout of an earlier one goes."""
    if path_exists(df.sparkSession, f"{path.rstrip('/')}/{LAYOUT_FOLDER}"):
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, with its bucket layout if it was written with one."""
    noted = f"{path.rstrip('/')}/{LAYOUT_FOLDER}"
    if not table_exists(spark, noted):
        return spark.read.parquet(path)
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        layout = json.loads(spark.read.text(noted).first()[0])
        columns = T.StructType.fromJson(layout["schema"]).toDDL()
        keys = ", ".join(f"`{k}`" for k in layout["keys"])
        place = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) INTO {layout['buckets']} BUCKETS LOCATION '{place}'"
        )
    spark.catalog.refreshTable(name)
    return spark.table(name)


def pin(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the scratch folder and read it back.

    Used where work must happen once (a model call, an embedding) or is read several
    times. The table outlives lost executors.
    """
    spark = df.sparkSession
    with shuffles_dropped(spark):
        path = write_table(df, scratch_path(spark, name))
    return spark.read.schema(df.schema).parquet(path)


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when a finished write left its success marker at ``path``."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return _filesystem(spark, path).exists(marker)


def path_exists(spark: SparkSession, path: str) -> bool:
    return _filesystem(spark, path).exists(spark._jvm.org.apache.hadoop.fs.Path(path))


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Paths of the folders right below ``path``."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = _filesystem(spark, path).listStatus(hadoop_path)
    return [f"{path.rstrip('/')}/{x.getPath().getName()}" for x in found if x.isDirectory()]


def delete_path(spark: SparkSession, path: str) -> None:
    _filesystem(spark, path).delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)


def table_state(spark: SparkSession, path: str) -> str:
    """What a rewrite of a table changes: its size, number of files and the time it was finished."""
    fs, hadoop_path = _filesystem(spark, path), spark._jvm.org.apache.hadoop.fs.Path(path)
    summary = fs.getContentSummary(hadoop_path)
    marker = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return f"{summary.getLength()}/{summary.getFileCount()}/{fs.getFileStatus(marker).getModificationTime()}"


def write_note(spark: SparkSession, path: str, line: str) -> None:
    """Replace a one-line file."""
    stream = _filesystem(spark, path).create(spark._jvm.org.apache.hadoop.fs.Path(path), True)
    stream.writeBytes(line + "\n")
    stream.close()


def read_note(spark: SparkSession, path: str) -> str | None:
    if not path_exists(spark, path):
        return None
    stream = _filesystem(spark, path).open(spark._jvm.org.apache.hadoop.fs.Path(path))
    line = stream.readLine()
    stream.close()
    return line


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int | None = None) -> str:
    """Overwrite a Parquet table laid out by ``keys``, which :func:`read_table` recognises.

    Rows move once, here. Windows and aggregates on the keys, also in later sessions, then read
    their bucket and move nothing. The layout is noted last, so a half-written table has none.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if path_exists(spark, path):
        delete_path(spark, path)
    name = _table_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = df.repartition(n, *keys).write.bucketBy(n, *keys).format("parquet")
    writer.mode("overwrite").option("path", path).saveAsTable(name)
    layout = json.dumps({"keys": keys, "buckets": n, "schema": spark.table(name).schema.jsonValue()})
    spark.createDataFrame([(layout,)], "value string").coalesce(1).write.text(f"{path}/{LAYOUT_FOLDER}")
    return path


def _table_name(path: str) -> str:
    return "bucketed_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()


def materialize(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], skip_existing: bool = True
) -> DataFrame:
    """Reuse the finished table at ``path``, or build, write and read it back."""
    if not (skip_existing and table_exists(spark, path)):
        write_table(build(), path)
    return read_table(spark, path)


def require_table(spark: SparkSession, path: str, stage: str) -> DataFrame:
    """Read a stage input that an earlier stage must have produced."""
    if not table_exists(spark, path):
        raise FileNotFoundError(f"{stage} needs {path}, which does not exist; run the earlier stage first")
    return read_table(spark, path)


def broadcast_if_small(df: DataFrame, max_rows: int = SMALL_TABLE_ROWS) -> DataFrame:
    """Broadcast hint after a bounded count proves the table small; no hint otherwise."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
