"""Time the headline queries and print one JSON line.

Every query runs on ``$BENCH_SF_DIR`` (default sf0.1) with ``local[$BENCH_CPUS]``; the
core ones run again on the conversations repeated ``$BENCH_COPIES`` times (100 copies
of sf0.1 are about half a million turns), under names ending in ``@copies``.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

from queryset import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("BENCH_COPIES", "100"))

HEADLINE = (
    "parse_dialogue_sgd",
    "corpus_summary",
    "describe_text_length",
    "last_system_text",
    "conversation_transcripts",
    "sample_conversations",
    "satisfaction_lenient",
    "issues_lenient",
    "annotate_cached",
    "topic_summary",
    "dashboard_topics",
    "sandbox_cases",
    "centroid_assign",
    "silhouette_squared",
    "kmeans_topics",
    "embed_tfidf",
    "staged_run",
)
AT_SCALE = (
    "parse_dialogue_sgd",
    "corpus_summary",
    "last_system_text",
    "conversation_transcripts",
    "satisfaction_lenient",
    "annotate_cached",
    "topic_summary",
    "turns_topics",
    "sandbox_cases",
    "staged_run",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.speculation", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="turnlens-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(df_of, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    df: DataFrame = df_of(spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def repeated(spark: SparkSession, copies: int) -> str:
    """A folder like the test data, with every conversation repeated under new ids and texts."""
    folder = tempfile.mkdtemp(prefix="turnlens-bench-")
    for name in os.listdir(SF_DIR):
        if name != "conversations.parquet":
            os.symlink(os.path.join(SF_DIR, name), os.path.join(folder, name))
    source = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    width = source.agg(F.max("conv_id")).first()[0] + 1
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    source.repartition(int(CPUS) * 2).select("*", copy).select(
        (F.col("conv_id") + F.col("copy") * width).alias("conv_id"),
        "turn",
        "role",
        F.concat("text", F.lit(" #"), F.col("copy").cast("string")).alias("text"),
    ).write.parquet(f"{folder}/conversations.parquet")
    return folder


def main() -> None:
    spark = session()
    timed(QUERIES["corpus_summary"], spark, SF_DIR)  # warm up the JVM
    seconds = {name: timed(QUERIES[name], spark, SF_DIR) for name in HEADLINE}
    if COPIES > 1:
        folder = repeated(spark, COPIES)
        seconds.update({f"{name}@{COPIES}": timed(QUERIES[name], spark, folder) for name in AT_SCALE})
    result = {
        "metric": "total time of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "copies": COPIES,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
