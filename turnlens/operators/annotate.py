"""Model calls on Spark: one call per distinct request, kept in a cache table.

The only Python on executors is the call itself. The replies are always written
before they are used, so no re-planned branch of the query calls the model again.
A retried task can repeat its calls; switch speculation off for such jobs.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlens.sources.replies import INVALID_REPLY, append_cache, lookup, next_number, stored_replies, usable
from turnlens.sources.tables import pin, scratch_path

#: Takes a prompt (or the task's raw inputs), returns the reply as JSON text or as a dict.
ModelFn = Callable[..., "str | dict"]


@dataclass(frozen=True)
class CallPolicy:
    """How calls are made.

    A call that still fails after all retries is recorded with its error name, so that no
    other reply is lost. ``on_error``: ``"fail"`` then raises, after the replies are written;
    a second run asks for the rest only. ``"fallback"`` goes on. The wait before retry ``a`` is
    ``min(base_sleep * 2**(a - 1), max_sleep)`` seconds. ``parallelism`` is the number of
    tasks that call the model (default: one per core, at least the shuffle partitions), and
    ``concurrency`` the number of calls that each of them has under way at a time.
    ``commit_batches`` splits the calls over that many write jobs, so a lost job loses one
    batch only.
    """

    on_error: str = "fail"
    max_retries: int = 5
    base_sleep: float = 1.5
    max_sleep: float = 20.0
    parallelism: int | None = None
    commit_batches: int = 1
    concurrency: int = 1


#: Takes a parsed reply; false means that the model is to be asked again.
ValidFn = Callable[[object], bool]


def call_model(
    requests: DataFrame, fn: ModelFn, policy: CallPolicy = CallPolicy(), valid: ValidFn | None = None
) -> DataFrame:
    """``(request_key, prompt)`` -> ``(request_key, response_json, error)``, one call per row.

    A reply that is no JSON text, or that ``valid`` refuses, counts as a failed call and is
    retried. The last refused reply is kept next to the error.
    """
    if policy.on_error not in ("fail", "fallback"):
        raise ValueError(f"on_error must be 'fail' or 'fallback', not {policy.on_error!r}")
    attempts, concurrency = policy.max_retries, policy.concurrency
    base, longest = policy.base_sleep, policy.max_sleep

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def reply_to(prompt: str) -> tuple[str | None, str | None]:
            refused = None
            for attempt in range(1, attempts + 1):
                try:
                    reply = fn(prompt)
                    text = reply if isinstance(reply, str) else json.dumps(reply or {}, ensure_ascii=False)
                    parsed = json.loads(text)
                    if valid is None or valid(parsed):
                        return text, None
                    refused, name = text, INVALID_REPLY
                except Exception as error:
                    refused, name = None, type(error).__name__
                if attempt < attempts:
                    time.sleep(min(base * 2 ** (attempt - 1), longest))
            return refused, name

        with ThreadPoolExecutor(concurrency) as pool:
            for batch in batches:
                replies = list(pool.map(reply_to, batch["prompt"]))
                yield pd.DataFrame(
                    {
                        "request_key": batch["request_key"],
                        "response_json": pd.Series([r[0] for r in replies], dtype="object"),
                        "error": pd.Series([r[1] for r in replies], dtype="object"),
                    }
                )

    # Prompts are small and calls are slow: without a fixed number of partitions adaptive
    # execution would merge them into a few tasks.
    spark = requests.sparkSession
    default = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spread = requests.select("request_key", "prompt").repartition(policy.parallelism or default, "request_key")
    return spread.mapInPandas(run, "request_key string, response_json string, error string")


def takes_inputs(fn: ModelFn) -> ModelFn:
    """Model function on raw inputs -> one that reads them from a JSON array prompt."""

    def call(prompt: str):
        return fn(*json.loads(prompt))

    return call


def inputs_prompt(*texts: Column) -> Column:
    """The raw inputs as a JSON array, for :func:`takes_inputs`."""
    return F.to_json(F.array(*[F.coalesce(t, F.lit("")) for t in texts]))


def distinct_requests(requests: DataFrame) -> DataFrame:
    """One row per request key, combined before the shuffle."""
    return requests.groupBy("request_key").agg(F.min("prompt").alias("prompt"))


def cache_hits(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """Requests with a stored reply that parses."""
    return requests.join(usable(cache).drop("task", "model", "error", "seq"), "request_key")


def cache_misses(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """Requests without a usable stored reply."""
    return requests.join(usable(cache).select("request_key"), "request_key", "left_anti")


def fetch_replies(
    requests: DataFrame,
    fn: ModelFn,
    task: str,
    model: str,
    cache_path: str | None = None,
    policy: CallPolicy = CallPolicy(),
    valid: ValidFn | None = None,
) -> DataFrame:
    """Reply table ``(request_key, response_json, error, source)``, one row per request key.

    Keys found in the cache are not called again (``source`` is ``cache``); the others
    are called once per distinct key (``source`` is ``llm``) and appended. The result is
    the union of both tables, each read from storage.
    """
    spark = requests.sparkSession
    path = cache_path or scratch_path(spark, "replies")
    known, seq = distinct_requests(requests), 1
    if cache_path:
        seq = next_number(spark, path)
        before = lookup(known, stored_replies(spark, path, task, model))
        known = known.join(before.select("request_key", "response_json"), "request_key", "left")
    else:
        known = known.withColumn("response_json", F.lit(None).cast("string"))
    if cache_path or policy.commit_batches > 1:
        known = pin(known, "requests")
    misses = known.filter(F.col("response_json").isNull())
    replies = known.filter(F.col("response_json").isNotNull()).select(
        "request_key", "response_json", F.lit(None).cast("string").alias("error"), F.lit("cache").alias("source")
    )
    batch = F.pmod(F.xxhash64("request_key"), F.lit(policy.commit_batches))
    for i in range(policy.commit_batches):
        asked = misses.filter(batch == i) if policy.commit_batches > 1 else misses
        answered = call_model(asked, fn, policy, valid).withColumns(
            {"task": F.lit(task), "model": F.lit(model), "seq": F.lit(seq).cast("long")}
        )
        written = append_cache(answered, path, seq)
        if policy.on_error == "fail":
            failed = written.filter(F.col("error").isNotNull()).agg(F.count("error"), F.min("error")).first()
            if failed[0]:
                raise RuntimeError(f"{failed[0]} model calls failed, the first by name with {failed[1]}; the other replies are kept")
        fresh = written.select(
            "request_key",
            F.when(F.col("error").isNull() | (F.col("error") == INVALID_REPLY), F.col("response_json")).alias("response_json"),
            F.when(F.col("error") != INVALID_REPLY, F.col("error")).alias("error"),
            F.lit("llm").alias("source"),
        )
        replies = replies.unionByName(fresh) if cache_path or i else fresh
    return replies


def annotate(
    rows: DataFrame,
    fn: ModelFn,
    task: str,
    model: str,
    cache_path: str | None = None,
    policy: CallPolicy = CallPolicy(),
    asked: Column | None = None,
    valid: ValidFn | None = None,
) -> DataFrame:
    """Attach replies to a table with ``request_key`` and ``prompt`` (null where nothing is asked).

    Adds ``response_json``, ``error`` and ``source``. Only the rows with a request are
    shuffled to their replies; the others pass by. A request that very many rows share
    is one skewed key of that left join, which adaptive execution splits. ``asked``
    says which rows have a request, for a condition that filters better than the key.
    """
    asked = F.col("request_key").isNotNull() if asked is None else F.coalesce(asked, F.lit(False))
    requests = rows.filter(asked)
    replies = fetch_replies(requests.select("request_key", "prompt"), fn, task, model, cache_path, policy, valid)
    answered = requests.drop("prompt").join(replies, "request_key", "left")
    nothing = {c: F.lit(None).cast("string") for c in ("request_key", "response_json", "error", "source")}
    return answered.unionByName(rows.filter(~asked).drop("prompt").withColumns(nothing))
