"""Dialogue text files: one utterance per line, blank lines between conversations.

The files are read in splits, in parallel, and cut further into blocks of lines.
Conversation and turn numbers come from counts inside each block plus offsets carried
over from the blocks before it, so neither a large file nor a long conversation ends
up in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnlens.functions.text import field, is_blank, is_overall_line, null_if_empty, tab_fields, ws_strip
from turnlens.functions.values import array_mean, parse_scores
from turnlens.schemas import require_columns

LINE_COLUMNS = ("file", "split", "pos", "value")
#: Lines per block, as a power of two.
BLOCK_BITS = 16
_BLOCK = ["file", "split", "block"]


@dataclass(frozen=True)
class DialogueFormat:
    """What a corpus keeps in its columns beyond speaker and text.

    ``tag``: name of the third column. ``scores``: a fourth column holds ratings.
    ``strip_scores``: the kept raw ratings are stripped. ``overall``: a ``USER``
    line ``OVERALL`` rates the whole conversation. ``overall_closes``: that line also
    ends the conversation.
    """

    tag: str = "dialog_act"
    scores: bool = True
    strip_scores: bool = False
    overall: bool = True
    overall_closes: bool = False


FORMATS = {
    "sgd": DialogueFormat(strip_scores=True),
    "mwoz": DialogueFormat(),
    "redial": DialogueFormat(overall=False),
    "ccpe": DialogueFormat(tag="entity_tag", strip_scores=True, overall_closes=True),
    "redial_action": DialogueFormat(scores=False, overall=False),
}


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with an order: file, split offset, position. Lines of a split keep file order."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value"),
    )


def segment_conversations(lines: DataFrame, closes: Column | None = None) -> DataFrame:
    """Non-blank lines with ``conv_id`` (from 0) and ``turn_id`` (from 1).

    A conversation starts at a non-blank line whose predecessor is blank, is a
    closing line (``closes``), or is missing (start of a file). Several files are
    numbered on, in path order.
    """
    require_columns(lines, LINE_COLUMNS, "lines")
    content = ~is_blank(F.col("value"))
    breaks = ~content if closes is None else ~content | closes
    in_block = Window.partitionBy(*_BLOCK).orderBy("pos")
    so_far = in_block.rowsBetween(Window.unboundedPreceding, 0)
    marked = lines.withColumns(
        {"block": F.shiftright("pos", BLOCK_BITS), "is_content": content, "breaks": breaks}
    )
    # Starts whose predecessor lies in the same block; the first line is settled below.
    marked = marked.withColumn(
        "starts", F.col("is_content") & F.coalesce(F.lag("breaks").over(in_block), F.lit(False))
    ).withColumn("content_no", F.count_if("is_content").over(so_far))
    last_start = F.last(F.when(F.col("starts"), F.col("content_no")), ignorenulls=True)
    counted = marked.withColumns(
        {"start_no": F.count_if("starts").over(so_far), "last_start": last_start.over(so_far)}
    )
    offsets = _block_offsets(counted)
    conv_id = F.col("start_offset") + F.col("start_no") + F.col("opens").cast("long") - 1
    started_at = F.coalesce(
        F.col("content_offset") + F.col("last_start"),
        F.when(F.col("opens"), F.col("content_offset") + 1),
        F.col("carried_start"),
    )
    turn_id = F.col("content_offset") + F.col("content_no") - started_at + 1
    return (
        counted.join(offsets, _BLOCK)
        .filter("is_content")
        .select(conv_id.cast("long").alias("conv_id"), turn_id.cast("long").alias("turn_id"), "value")
    )


def _block_offsets(counted: DataFrame) -> DataFrame:
    """One row per block: how many starts and lines precede it, and where the open conversation began."""
    per_block = counted.groupBy(*_BLOCK).agg(
        F.min_by("is_content", "pos").alias("first_is_content"),
        F.max_by("breaks", "pos").alias("last_breaks"),
        F.max("content_no").alias("n_content"),
        F.max("start_no").alias("n_starts"),
        F.max("last_start").alias("last_start"),
    )
    # Sums run in three levels: over the blocks of a split, the splits of a file, and the files.
    in_split = Window.partitionBy("file", "split").orderBy("block")
    inside = per_block.withColumn("open_before", ~F.lag("last_breaks").over(in_split)).withColumns(
        {
            "at_start": F.row_number().over(in_split) == 1,
            # Whether the first block of a split opens a conversation depends on the split before.
            "opens_inside": F.col("first_is_content") & ~F.coalesce("open_before", F.lit(True)),
        }
    )
    before = in_split.rowsBetween(Window.unboundedPreceding, -1)
    starts = F.col("n_starts") + F.col("opens_inside").cast("long")
    summed = inside.withColumns(
        {
            "starts": starts,
            "starts_before": F.coalesce(F.sum(starts).over(before), F.lit(0)),
            "content_before": F.coalesce(F.sum("n_content").over(before), F.lit(0)),
        }
    )
    latest = F.coalesce(
        F.col("content_before") + F.col("last_start"),
        F.when(F.col("opens_inside"), F.col("content_before") + 1),
    )
    summed = summed.withColumns({"latest": latest, "carried_inside": F.last(latest, ignorenulls=True).over(before)})
    splits = _split_offsets(summed)
    opens = F.col("opens_inside") | (F.col("at_start") & F.col("split_opens"))
    # What the first block of a split opens counts for the blocks after it.
    opened = F.when(~F.col("at_start") & F.col("split_opens"), 1).otherwise(0)
    carried = F.coalesce(
        F.col("content_offset") + F.col("carried_inside"),
        F.when(~F.col("at_start") & F.col("split_opens"), F.col("content_offset") + 1),
        F.col("carried_start"),
    )
    return summed.join(splits, ["file", "split"]).select(
        *_BLOCK,
        opens.alias("opens"),
        (F.col("start_offset") + F.col("starts_before") + opened).alias("start_offset"),
        (F.col("content_offset") + F.col("content_before")).alias("content_offset"),
        carried.alias("carried_start"),
    )


def _split_offsets(blocks: DataFrame) -> DataFrame:
    """One row per split: whether it opens a conversation, and what precedes it in its file and the files before."""
    per_split = blocks.groupBy("file", "split").agg(
        F.min_by("first_is_content", "block").alias("first_is_content"),
        F.max_by("last_breaks", "block").alias("last_breaks"),
        F.sum("n_content").alias("n_content"),
        F.sum("starts").alias("n_starts"),
        F.max("latest").alias("latest"),
    )
    ordered = Window.partitionBy("file").orderBy("split")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    continues = ~F.coalesce(F.lag("last_breaks").over(ordered), F.lit(True))
    opened = per_split.withColumn("split_opens", F.col("first_is_content") & ~continues)
    starts = F.col("n_starts") + F.col("split_opens").cast("long")
    placed = opened.withColumns(
        {
            "start_offset": F.coalesce(F.sum(starts).over(before), F.lit(0)),
            "content_offset": F.coalesce(F.sum("n_content").over(before), F.lit(0)),
        }
    )
    latest = F.coalesce(
        F.col("content_offset") + F.col("latest"), F.when(F.col("split_opens"), F.col("content_offset") + 1)
    )
    # No conversation spans two files.
    placed = placed.withColumn("carried_start", F.last(latest, ignorenulls=True).over(before))
    totals = placed.groupBy("file").agg(F.sum(starts).alias("n"))
    files_before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = totals.select("file", F.coalesce(F.sum("n").over(files_before), F.lit(0)).alias("file_offset"))
    return placed.join(files, "file").select(
        "file",
        "split",
        "split_opens",
        (F.col("start_offset") + F.col("file_offset")).alias("start_offset"),
        "content_offset",
        "carried_start",
    )


def parse_dialogue(lines: DataFrame, fmt: str) -> DataFrame:
    """Turn table of one corpus from ordered lines."""
    spec = FORMATS[fmt]
    line = tab_fields(F.col("value"))
    closes = is_overall_line(field(line, 0), field(line, 1)) if spec.overall_closes else None
    numbered = segment_conversations(lines, closes).withColumn("fields", line)
    speaker, text, tag, raw = (field(F.col("fields"), i) for i in range(4))
    if not spec.scores:
        raw = F.lit(None).cast("string")
    return numbered.select(
        "conv_id",
        "turn_id",
        speaker.alias("speaker"),
        text.alias("text"),
        null_if_empty(tag).alias(spec.tag),
        null_if_empty(ws_strip(raw) if spec.strip_scores else raw).alias("scores_raw"),
        parse_scores(raw).alias("scores"),
        (is_overall_line(speaker, text) if spec.overall else F.lit(False)).alias("is_overall"),
    )


def load_dialogue(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """Read a dialogue file or folder in one of :data:`FORMATS`."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown dialogue format {fmt!r}; known: {sorted(FORMATS)}")
    return parse_dialogue(read_lines(spark, path), fmt)


def enrich(turns: DataFrame, dataset: str) -> DataFrame:
    """Add dataset name, mean rating and the label copy of the tag column."""
    tag = "entity_tag" if "entity_tag" in turns.columns else "dialog_act"
    return turns.select(
        F.lit(dataset).alias("dataset"),
        "*",
        array_mean(F.col("scores")).alias("satisfaction_mean"),
        F.col(tag).alias("label"),
    )


def ingest(spark: SparkSession, path: str, fmt: str, dataset: str) -> DataFrame:
    return enrich(load_dialogue(spark, path, fmt), dataset)
