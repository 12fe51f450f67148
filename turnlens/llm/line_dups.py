"""Fuzzy line deduplication by the rarest word pairs of a line.

A line is normalised to its lower-case words, and its grams are the pairs of words that follow
each other, each labelled with how often it has occurred before in the line. One edit takes at
most two grams away, so similar lines share a number of grams that follows from their lengths.
Grams have one order everywhere, and of each line as many of the first are keys as make sure
that similar lines have one of them in common (prefix filtering, the pigeonhole principle on
grams). Lines that share a key are verified by edit similarity on words, and connected into
groups. One occurrence of each group stays.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnlens.llm.alignment import similar
from turnlens.llm.common import Scratch, rows_in_place
from turnlens.llm.hashing import WordHashes, characters, cut, mix, parities, word_hash
from turnlens.llm.linking import may_be_similar, verified_groups
from turnlens.llm.near_dups import bag, bags_fit
from turnlens.llm.shared_keys import Keys


@dataclass(frozen=True)
class LineRule:
    """Lines of fewer than ``min_words`` words are left alone."""

    min_words: int = 5
    similarity: float = 0.8


#: Longs of the sketch of a line, which says how far apart two lines are at least.
SKETCH = 3

#: A line occurrence: its place, a hash of its words, which is its id, their number, sketch and tokens.
LINE_SQL = "line int, id bigint, n int, " + ", ".join(f"s{i} bigint" for i in range(SKETCH)) + ", tokens binary"

#: Lines of which a task remembers that their tokens were given.
LINES_KNOWN = 1 << 20


def gram_size(rule: LineRule) -> int:
    """Two words where similar lines of any length share such a gram, else one word."""
    lengths = np.arange(rule.min_words, rule.min_words + 1000)
    return 2 if (1 - rule.similarity) * 2 < 0.9 and (shared(lengths, 2, rule) >= 1).all() else 1


def shared(lengths: np.ndarray, size: int, rule: LineRule) -> np.ndarray:
    """How many grams similar lines have in common at least, the longer of which has so many words."""
    return lengths - size + 1 - size * ((1.0 - rule.similarity) * lengths + 1e-9).astype(np.int64)


@functools.lru_cache(100_000)
def keys_needed(length: int, size: int, rule: LineRule) -> int:
    """How many of its first grams a line needs as keys, whatever length a similar line has."""
    longest = max(length, int(length / rule.similarity + 1e-6))
    return length - size + 1 - int(shared(np.arange(length, longest + 1), size, rule).min()) + 1


#: Grams kept as common ones, and the places of the table that says how common a gram is.
COMMON, PLACES = 1 << 18, 1 << 22

#: Words, and lines, whose keys are computed at once.
WORDS_AT_ONCE, LINES_AT_ONCE = 1 << 16, 1 << 13

#: Grams that are counted at once.
GRAMS_AT_ONCE = 1 << 22


def grams(tokens: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Line, hash and characters of each gram, by line."""
    line = np.repeat(np.arange(len(lengths)), lengths)
    if size == 1:
        return line, mix(tokens, 41), sizes
    gram = mix(mix(tokens[:-1], 41) * np.uint64(0x100000001B3) + mix(tokens[1:], 43), 47)
    inside = line[1:] == line[:-1]
    return line[1:][inside], gram[inside], (sizes[:-1] + sizes[1:])[inside]


def earlier_ones(line: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """How often the gram has occurred before in its line."""
    earlier = np.zeros(len(gram), np.uint64)
    marked = np.sort((line.astype(np.uint64) << np.uint64(51)) | (gram >> np.uint64(13)))
    again = marked[1:] == marked[:-1]
    if again.any():
        several = np.zeros(int(line[-1]) + 1, bool)
        several[(marked[1:][again] >> np.uint64(51)).astype(np.int64)] = True
        some = np.flatnonzero(several[line])
        some = some[np.lexsort((gram[some], line[some]))]
        new = np.concatenate(([True], (gram[some][1:] != gram[some][:-1]) | (line[some][1:] != line[some][:-1])))
        earlier[some] = np.arange(len(some)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    return earlier


def line_keys(
    tokens: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, rule: LineRule, common: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(line number, key), by line, for up to LINES_AT_ONCE lines.

    ``tokens`` holds the words of all lines, one line after the other, and ``sizes`` their
    characters. Grams that ``common`` has as less common come first, then those of long words;
    any order is a right one, as long as it is the same for all lines.
    """
    size = gram_size(rule)
    line, gram, weight = grams(tokens, sizes, lengths, size)
    if not len(gram):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    level = np.uint64(0) if common is None else common[gram & np.uint64(PLACES - 1)].astype(np.uint64)
    key = mix(gram + earlier_ones(line, gram) * np.uint64(0x9FB21C651E98DF25), 53) >> np.uint64(23)
    rank = (level << np.uint64(5)) | (31 - np.minimum(weight, 31)).astype(np.uint64)
    ordered = np.sort((line.astype(np.uint64) << np.uint64(51)) | (rank << np.uint64(41)) | key)
    held = np.maximum(lengths - size + 1, 0)
    different, which = np.unique(lengths, return_inverse=True)
    needed = np.array([keys_needed(n, size, rule) for n in different.tolist()])[which]
    kept = np.arange(len(line)) - np.repeat(np.cumsum(held) - held, held) < needed[line]
    return line[kept], (ordered[kept] & np.uint64((1 << 51) - 1)).view(np.int64)


def some_lines(lengths: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """First and last line, and first and last word, of each few lines."""
    ends, first = np.cumsum(lengths), 0
    while first < len(lengths):
        begun = int(ends[first] - lengths[first])
        last = max(first + 1, min(int(np.searchsorted(ends, begun + WORDS_AT_ONCE, "right")), first + LINES_AT_ONCE))
        yield first, last, begun, int(ends[last - 1])
        first = last


def keys_of(parts: list[np.ndarray], sizes: list[np.ndarray], rule: LineRule, common: np.ndarray | None = None) -> list[np.ndarray]:
    """The keys of each line."""
    made: list[np.ndarray] = []
    for first, last, _, _ in some_lines(np.array([len(p) for p in parts])):
        lengths = np.array([len(p) for p in parts[first:last]])
        numbers, keys = line_keys(np.concatenate(parts[first:last]), np.concatenate(sizes[first:last]), lengths, rule, common)
        made.extend(np.split(keys, np.searchsorted(numbers, np.arange(1, len(lengths)))))
    return made


def token_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words of a column of tokens, their characters, up to 15, and the words of each line."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    if not len(column) or ends[-1] == ends[0]:
        return np.empty(0, np.uint32), np.empty(0, np.int64), np.zeros(len(column), np.int64)
    tokens = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(np.uint32)
    return tokens, (tokens >> np.uint32(28)).astype(np.int64), np.diff(ends).astype(np.int64) // 4


def most_counted(gram: np.ndarray, n: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams with their counts added up, those of most if there are more."""
    order = np.argsort(gram, kind="stable")
    gram, n = gram[order], n[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(gram)), bool), gram[1:] != gram[:-1])))
    gram, n = gram[first], np.add.reduceat(n, first) if len(first) else n
    if len(gram) > most:
        best = np.argpartition(n, len(n) - most)[len(n) - most :]
        gram, n = gram[best], n[best]
    return gram, n


def common_grams(lines: DataFrame, rule: LineRule) -> np.ndarray:
    """How common grams are, by the low bits of their hash: the logarithm of about how often they occur.

    It only sets the order of grams. In that order a passage that many lines hold comes last, so
    that lines meet for it only if it is much of each. Tasks count all grams, but
    pass on those only that occur more than once among some millions, and of these the most frequent.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        held: list[np.ndarray] = []

        def counted() -> tuple[np.ndarray, np.ndarray]:
            all_of = np.sort(np.concatenate(held)) if held else np.empty(0, np.uint64)
            first = np.flatnonzero(np.concatenate((np.ones(min(1, len(all_of)), bool), all_of[1:] != all_of[:-1])))
            times = np.diff(np.append(first, len(all_of)))
            held.clear()
            new, n = all_of[first][times > 1], times[times > 1]
            return most_counted(np.concatenate((found, new)), np.concatenate((counts, n)), 2 * COMMON)

        for batch in batches:
            tokens, sizes, lengths = token_words(batch.column(0))
            for first, last, begun, ended in some_lines(lengths):
                held.append(grams(tokens[begun:ended], sizes[begun:ended], lengths[first:last], gram_size(rule))[1])
                if sum(map(len, held)) >= GRAMS_AT_ONCE:
                    found, counts = counted()
        found, counts = counted()
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], ["gram", "n"])

    some = lines.select("tokens").mapInArrow(run, "gram long, n long")
    most = some.groupBy("gram").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "gram").limit(COMMON).toArrow()
    levels = np.zeros(PLACES, np.uint8)
    gram, n = most.column(0).to_numpy().view(np.uint64), most.column(1).to_numpy()
    np.maximum.at(levels, (gram & np.uint64(PLACES - 1)).astype(np.int64), np.minimum(np.log2(np.maximum(n, 2)), 31).astype(np.uint8))
    return levels


def token_of(word: str) -> int:
    """32 bits that stand for a word: its length, up to 15, above 28 bits of its hash."""
    return (min(len(word), 15) << 28) | (word_hash(word) & 0xFFFFFFF)


def hashed_lines(rows: DataFrame, rule: LineRule) -> DataFrame:
    """row, rank and LINE_SQL of the lines long enough, from (row, rank, text).

    Tokens are null where the task has given them for an equal line before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for whole in batches:
            for first in range(0, len(whole), 100):
                batch = whole.slice(first, 100)
                chars = [characters(text) for text in batch.column(2).to_pylist()]
                for kind in (np.uint8, np.uint32):
                    if numbers := [i for i, c in enumerate(chars) if c.dtype == kind]:
                        if made := lines_of([chars[i] for i in numbers], rule, known):
                            taken = pa.array(np.array(numbers)[made[0]])
                            columns = [batch.column(0).take(taken), batch.column(1).take(taken), *made[1:]]
                            yield pa.RecordBatch.from_arrays(columns, ["row", "rank", *[c.split()[0] for c in LINE_SQL.split(", ")]])

    return rows.mapInArrow(run, f"row long, rank {rows.schema['rank'].dataType.simpleString()}, {LINE_SQL}")


def lines_of(texts: list[np.ndarray], rule: LineRule, known: set[int]) -> list | None:
    """The text number and the columns LINE_SQL of the lines long enough of texts in ``characters`` of one kind."""
    breaks = np.array([10], texts[0].dtype)
    hashed, sizes, line = cut(np.concatenate([x for text in texts for x in (text, breaks)]))
    begun = np.cumsum([0, *[int((text == 10).sum()) + 1 for text in texts]])
    named = np.bincount(line, minlength=begun[-1])
    long_enough = named >= rule.min_words
    places = np.flatnonzero(long_enough)
    if not len(places):
        return None
    inside = long_enough[line]
    hashed, sizes, lengths = hashed[inside], sizes[inside], named[places]
    starts = np.cumsum(lengths) - lengths
    placed = hashed + (np.arange(len(hashed)) - np.repeat(starts, lengths)).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)
    ids = mix(np.add.reduceat(mix(placed, 71), starts), 73).view(np.int64)
    tokens = (np.minimum(sizes, 15).astype(np.uint32) << np.uint32(28)) | (hashed & np.uint64(0xFFFFFFF)).astype(np.uint32)
    sketch = np.concatenate(
        [parities(tokens[a:b], lengths[i:j], SKETCH) for i, j, a, b in some_lines(lengths)]
    )
    given = np.ones(len(places), bool)
    for i, line_id in enumerate(ids.tolist()):
        if line_id in known:
            given[i] = False
        else:
            if len(known) >= LINES_KNOWN:
                known.clear()
            known.add(line_id)
    ends = np.cumsum(np.concatenate(([0], np.where(given, 4 * lengths, 0)))).astype(np.int32)
    held = [pa.py_buffer(x) for x in (np.packbits(given, bitorder="little"), ends, tokens[np.repeat(given, lengths)])]
    text = np.searchsorted(begun, places, "right") - 1
    return [
        text,
        pa.array((places - begun[text]).astype(np.int32)),
        pa.array(ids),
        pa.array(lengths.astype(np.int32)),
        *[pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(SKETCH)],
        pa.Array.from_buffers(pa.binary(), len(places), held),
    ]


class Tokens(WordHashes):
    """Like WordHashes, but with ``token_of`` each word."""

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = token_of(word)
        if len(word) <= 64:
            self[word] = value
        return value


def keys_by_line(rule: LineRule, common: Broadcast) -> Callable[[pa.RecordBatch], Keys]:
    """The keys of lines (id, tokens)."""

    def keyed(batch: pa.RecordBatch) -> Keys:
        tokens, sizes, lengths = token_words(batch.column(1))
        ids, keys = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        own = batch.column(0).to_numpy()
        for first, last, begun, ended in some_lines(lengths):
            numbers, made = line_keys(tokens[begun:ended], sizes[begun:ended], lengths[first:last], rule, common.value)
            ids.append(own[first:last][numbers])
            keys.append(made)
        return np.concatenate(ids), np.concatenate(keys)

    return keyed


def aligned_lines(pairs: DataFrame, lines: DataFrame, threshold: float) -> DataFrame:
    """Those pairs (a, b) of lines (id, tokens) that have an edit similarity of ``threshold``."""

    @F.pandas_udf("boolean")
    def match(left: pd.Series, right: pd.Series) -> pd.Series:
        found = np.zeros(len(left), bool)
        x, y = left.tolist(), right.tolist()
        for first in range(0, len(x), 1000):
            xs, ys = x[first : first + 1000], y[first : first + 1000]
            most = np.array([int((1.0 - threshold) * (max(len(i), len(j)) // 4) + 1e-6) for i, j in zip(xs, ys)])
            for i in np.flatnonzero(bags_fit([bag(t) for t in xs], [bag(t) for t in ys], most)):
                found[first + i] = similar(np.frombuffer(xs[i], np.uint32), np.frombuffer(ys[i], np.uint32), threshold)
        return pd.Series(found)

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    tokens = lines.join(wanted, "id", "left_semi").groupBy("id").agg(F.first("tokens").alias("tokens"))
    both = pairs.join(tokens.toDF("b", "y"), "b").join(tokens.toDF("a", "x"), "a")
    return both.filter(match("x", "y"))


def line_groups(lines: DataFrame, rule: LineRule, scratch: Scratch) -> DataFrame:
    """id, group, first: each distinct line with its group and the group's first occurrence.

    ``lines`` has (row, rank) and LINE_SQL, where rank orders the texts.
    """
    marks = ["n", *[f"s{i}" for i in range(SKETCH)]]
    # Equal lines have equal marks.
    distinct = lines.groupBy("id").agg(F.min(F.struct("rank", "row", "line")).alias("first"), *[F.first(m).alias(m) for m in marks])
    distinct = scratch.pin(distinct, "lines")
    given = lines.filter(F.col("tokens").isNotNull()).select("id", "tokens")
    verify = lambda pairs: aligned_lines(pairs, given, rule.similarity)
    common = lines.sparkSession.sparkContext.broadcast(common_grams(given, rule))
    marked = distinct.select("id", *marks)
    roots = verified_groups(given, verify, may_be_similar(rule.similarity, SKETCH), marked, keyed=keys_by_line(rule, common))
    common.destroy()
    grouped = distinct.join(roots, "id", "left").select("id", F.coalesce("root", "id").alias("group"), "first")
    firsts = grouped.groupBy("group").agg(F.min("first").alias("first"))
    return grouped.drop("first").join(firsts, "group")


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: LineRule = LineRule()
) -> DataFrame:
    """``docs`` with repeated and near-repeated lines taken out, and lines_removed.

    Of each group of lines that edit similarity connects, the occurrence in the row with the
    smallest id stays (null ids last, then rows and lines in order). Lines end at \\n. Lines of
    fewer than five words, blank ones among them, are left alone. Null texts stay null and empty
    ones empty; very long texts are read whole; of repeated rows the first keeps its lines. Rows
    stay even if no line is left. An empty table gives an empty result. Other columns are
    returned as they are; a column of ``docs`` named lines_removed is replaced.
    """
    columns = [c for c in docs.columns if c != "lines_removed"]
    scratch, spark = Scratch(docs.sparkSession), docs.sparkSession
    numbered = rows_in_place(docs, "row_")
    copied = numbered is None
    if copied:
        numbered = docs.withColumn("row_", F.monotonically_increasing_id())
    source = numbered.select("row_", F.struct(*[F.col(f"`{c}`") for c in columns]).alias("d_"))
    if copied:
        # The result reads this table, so it stays.
        source = Scratch(spark).pin(source, "texts")
    text = F.coalesce(F.col("d_").getField(text_col).cast("string"), F.lit(""))
    rank = F.struct(F.col("d_").getField(id_col).isNull().alias("no_id"), F.col("d_").getField(id_col).alias("id"))
    found = hashed_lines(source.select(F.col("row_").alias("row"), rank.alias("rank"), text.alias("text")), rule)
    lines = scratch.pin(found, "found")
    groups = line_groups(lines, rule, scratch)
    gone = (
        lines.select("row", "line", "id")
        .join(groups, "id")
        .filter(~((F.col("row") == F.col("first.row")) & (F.col("line") == F.col("first.line"))))
        .groupBy("row")
        .agg(F.collect_set("line").alias("gone"))
        .withColumnRenamed("row", "row_")
    )
    gone = Scratch(spark).pin(gone, "gone")
    scratch.drop()
    kept = F.filter(F.split("text_", "\n"), lambda _, i: ~F.array_contains("gone", i))
    shortened = source.join(gone, "row_", "left").withColumn("text_", F.col("d_").getField(text_col).cast("string"))
    new_text = F.when(F.col("gone").isNull(), F.col("text_")).otherwise(F.array_join(kept, "\n"))
    return shortened.select(
        *[(new_text.alias(c) if c == text_col else F.col("d_").getField(c).alias(c)) for c in columns],
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).alias("lines_removed"),
    )
