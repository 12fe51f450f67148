"""Conversation context: the last bot message, and transcripts."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnlens.functions.text import transcript_line
from turnlens.schemas import CONV, require_columns
from turnlens.sources.tables import broadcast_if_small, pin, write_bucketed

#: Turns per window partition; longer conversations are split and the value carried over.
CHUNK_TURNS = 100_000

#: Column of stored turn tables: the chunk of a turn. With the conversation it is their layout.
TURN_BLOCK = "turn_block"

#: Types of the columns whose hash spreads rows without a group.
SPREAD_BY = ("string", "long", "integer")


def chunk_of(df: DataFrame, group: list[str], order: str, chunk: int = CHUNK_TURNS) -> Column:
    """Number of the chunk of a row; rows without a group, whose value is not looked at, are spread."""
    grouped = reduce(and_, [F.col(c).isNotNull() for c in group])
    names = [c for c in df.columns if df.schema[c].dataType.typeName() in SPREAD_BY]
    scattered = F.pmod(F.xxhash64(*names), F.lit(4096))
    return F.when(grouped, F.floor(F.col(order) / chunk)).otherwise(scattered)


def forward_fill(
    df: DataFrame, value: Column, out: str, group: list[str], order: str, chunk: int = CHUNK_TURNS
) -> DataFrame:
    """Last non-null ``value`` up to and including the current row, per group.

    Groups are filled in chunks of the integer ``order`` column. Almost every group
    fits the first chunk; for those that do not, the last value of earlier chunks
    is carried over, so a huge group is spread over many tasks. Rows with a null in
    ``group`` belong to no group: they are kept, unfilled.
    """
    grouped = reduce(and_, [F.col(c).isNotNull() for c in group])
    member_value = F.when(grouped, value)
    # A stored turn table is laid out by its chunks; then the window moves nothing.
    stored = chunk == CHUNK_TURNS and TURN_BLOCK in df.columns
    keyed = df.withColumn("_chunk", F.col(TURN_BLOCK) if stored else chunk_of(df, group, order, chunk))
    in_chunk = Window.partitionBy(*group, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = keyed.withColumn(out, F.last(member_value, ignorenulls=True).over(in_chunk))
    # Groups that leave the first chunk are looked for first: the filter reaches the scan, finds
    # none in most data, and then the rows are shuffled once, for the window above.
    outside = df.filter(grouped & ((F.col(order) >= chunk) | (F.col(order) < 0)))
    if outside.isEmpty():
        return filled.select(*df.columns, out)
    long_groups = broadcast_if_small(pin(outside.select(*group).distinct(), "long-groups"))
    ends = (
        keyed.join(long_groups, group, "left_semi")
        .groupBy(*group, "_chunk")
        .agg(F.max_by(member_value, F.when(member_value.isNotNull(), F.col(order))).alias("_end"))
    )
    earlier = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*group, "_chunk", F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
    return (
        filled.join(carried, [*group, "_chunk"], "left")
        .withColumn(out, F.coalesce(out, "_carried"))
        .select(*df.columns, out)
    )


def add_last_system_text(turns: DataFrame, chunk: int = CHUNK_TURNS) -> DataFrame:
    """Attach the latest SYSTEM text of the conversation to every turn (its own on a SYSTEM turn).

    A null SYSTEM text does not reset the value. Turns without dataset or
    conversation id belong to no conversation and get null.
    """
    require_columns(turns, [*CONV, "turn_id", "speaker", "text"], "turns")
    base = turns.drop("last_system_text")
    system_text = F.when(F.col("speaker") == "SYSTEM", F.col("text"))
    return forward_fill(base, system_text, "last_system_text", CONV, "turn_id", chunk)


def write_turns(turns: DataFrame, path: str, buckets: int | None = None) -> str:
    """A turn table laid out by conversation and chunk of turns, so that stages read it without a shuffle.

    A conversation with very many turns is spread over the buckets by its chunks.
    """
    blocks = turns.drop(TURN_BLOCK)
    return write_bucketed(
        blocks.withColumn(TURN_BLOCK, chunk_of(blocks, CONV, "turn_id")), path, [*CONV, TURN_BLOCK], buckets
    )


def ensure_last_system_text(turns: DataFrame) -> DataFrame:
    return turns if "last_system_text" in turns.columns else add_last_system_text(turns)


def written_context(turns: DataFrame) -> DataFrame:
    """Turns with their last system text as a table: both the model calls and the join back read it."""
    return pin(add_last_system_text(turns), "context")


def first_turns(turns: DataFrame, n: int) -> DataFrame:
    """The first ``n`` turns of every conversation, numbered in ``rank``.

    Spark cuts each group to ``n`` rows before the shuffle (window group limit).
    """
    by_turn = Window.partitionBy(*CONV).orderBy("turn_id")
    return turns.withColumn("rank", F.row_number().over(by_turn)).filter(F.col("rank") <= n)


def transcripts(turns: DataFrame, max_turns: int = 14) -> DataFrame:
    """One text per conversation: a line ``Role: text`` for each of its first turns."""
    line = transcript_line(F.col("speaker"), F.col("text"))
    ordered = F.array_sort(F.collect_list(F.struct("rank", line.alias("line"))))
    return (
        first_turns(turns.select(*CONV, "turn_id", "speaker", "text"), max_turns)
        .groupBy(*CONV)
        .agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("snippet"))
    )
