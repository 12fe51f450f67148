"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnlens.sources.tables import scratch_path, shuffles_dropped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def with_row(docs: DataFrame, *columns: str, row_col: str | None = None) -> DataFrame:
    """Only the named columns, and a number that tells repeated rows apart: that of ``row_col``, or a new one."""
    row = F.monotonically_increasing_id() if row_col is None else F.col(row_col).cast("long")
    return docs.select(row.alias("row"), *columns)


def rows_in_place(docs: DataFrame, row_col: str) -> DataFrame | None:
    """``docs`` with numbers that are the same whenever they are read: the place of a row in its file.

    Only Parquet files that are read as they are, or some columns of them, have such numbers; None is returned for all else.
    """
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() == "Project" and plan.deterministic():
        plan = plan.child()
    if plan.nodeName() != "LogicalRelation" or "_metadata" in docs.columns:
        return None
    columns = [F.col(f"`{c}`") for c in docs.columns]
    try:
        placed = docs.select(*columns, F.col("_metadata.file_path").alias("file_"), F.col("_metadata.row_index").alias("at_"))
    except AnalysisException:  # no files, or of another format
        return None
    paths = sorted(r[0] for r in placed.select("file_").distinct().collect())
    files = docs.sparkSession.createDataFrame(list(enumerate(paths)), "number_ long, file_ string")
    row = F.col("number_") * F.lit(1 << 40) + F.col("at_")
    return placed.join(F.broadcast(files), "file_").select(row.alias(row_col), *columns)


class Scratch:
    """Intermediate tables in the shared folder, deleted together when their owner is done."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        self.tables: list[str] = []

    def pin(self, df: DataFrame, name: str) -> DataFrame:
        """Write and read back: cuts the lineage, and survives lost executors."""
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        with shuffles_dropped(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, key: str, name: str) -> DataFrame:
        """Like ``pin``, laid out by ``key``: later joins on it move the other side only."""
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        path = scratch_path(self.spark, name)
        table_name = path.rpartition("/")[2].replace("-", "_")
        self.paths.append(path)
        self.tables.append(table_name)
        writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        with shuffles_dropped(self.spark):
            writer.format("parquet").option("compression", "zstd").option("path", path).saveAsTable(table_name)
        return self.spark.table(table_name)

    def drop(self, keep: int = 0) -> None:
        """Delete all tables but the last ``keep`` pinned ones."""
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        for name in self.paths[: len(self.paths) - keep]:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.paths, self.tables = [], []
