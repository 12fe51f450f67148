"""Packing documents into fixed-length sequences: bounded-space online best fit.

Each partition keeps a fixed number of open windows. A document goes whole into the open
window that it fills best; if none has room, a new window is opened while the bound allows,
else the fullest window is topped up with a cut of the document and emitted. A document longer
than a window first fills windows of its own. What is still open at the end of a partition is
merged across partitions in a tree, a bounded number of windows at a time, until one is left.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnlens.llm.common import text_or_empty
from turnlens.sources.tables import pin

PIECE_SCHEMA = (
    "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, open boolean"
)
ARROW_SCHEMA = pa.schema(
    [("id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
     ("sequence_id", pa.int64()), ("offset", pa.int64()), ("open", pa.bool_())]
)
#: Bytes of a token id: unsigned, little-endian.
WIDTH = 4
#: Sequence ids: tree level, then partition or group, then number, in 8, 28 and 27 bits.
LEVEL_BITS, GROUP_BITS = 55, 27
#: Characters that Python's split() takes for white space but the tokenizer does not.
ODD_SPACE = "\x1c\x1d\x1e\x1f"
#: Marks that the tokenizer parts from the letters before them.
MARKS = ".,;:!?"
#: Of each line its word and closing mark, if it is a Latin-1 word of letters and at most one mark.
WORD_AND_MARK = re.compile(f"(?m)^(?:([A-Za-zªµºÀ-ÖØ-öø-ÿ]+)([{MARKS}]?)|.+)$")

#: Memory of one cached chunk besides its characters: two objects and their place in the table.
ENTRY_BYTES = 250


class WordTokens:
    """Token ids of texts, as bytes, with a bounded cache per white-space-separated chunk.

    For lower-casing tokenizers with word ends that drop white space and part letters from
    marks, the ids of a text are those of its chunks, one after the other, and those of a chunk
    are those of its word and its closing mark.
    """

    def __init__(
        self, path: str, end_id: int, cache_bytes: int = 1 << 28, chunk_chars: int = 40, word_end: str = "</w>"
    ):
        from tokenizers import Tokenizer

        # A task has one core; threads of the tokenizer's own would only wait for each other.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.end = end_id.to_bytes(WIDTH, "little")
        self.cache: dict[str, bytes] = {}
        self.limit, self.chunk_chars, self.held = cache_bytes, chunk_chars, 0
        self.marks = {"": b""} | {mark: self.ids(mark) for mark in MARKS}

        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(word_end)]] = True

    def ids(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn_words(self, found: list[str]) -> None:
        """Lower-case words of letters, joined into a few texts and told apart by word ends."""
        parts = [found[i : i + 500] for i in range(0, len(found), 500)]
        coded = self.tokenizer.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)
        for part, code in zip(parts, coded):
            ids = np.asarray(code.ids, "<u4")
            stops = (np.flatnonzero(self.ends[ids]) + 1) * WIDTH
            if len(stops) != len(part):
                self.cache.update((w, self.ids(w)) for w in part)
                continue
            raw, stops = ids.tobytes(), stops.tolist()
            self.cache.update(zip(part, [raw[a:b] for a, b in zip([0, *stops], stops)]))

    def learn(self, chunks: list[str]) -> None:
        before = len(self.cache)
        parts = WORD_AND_MARK.findall("\n".join(chunks)) if chunks else []
        lower = [word.lower() for word, _ in parts]
        self.learn_words(list({w for w in lower if w}.difference(self.cache)))
        odd = [c for c, w in zip(chunks, lower) if not w]
        coded = self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)
        self.cache.update((c, np.asarray(code.ids, "<u4").tobytes()) for c, code in zip(odd, coded))
        cache, marks = self.cache, self.marks
        cache.update([(c, cache[w] + marks[mark]) for c, w, (_, mark) in zip(chunks, lower, parts) if w])
        self.held += (len(self.cache) - before) * ENTRY_BYTES + sum(map(len, chunks))

    @staticmethod
    def folded(text: str) -> str:
        """The text in lower case, where that changes no id: its chunks are fewer. Tokens such as <|endoftext|> are told by case."""
        if "<" in text:
            return text
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return text
        return text.lower()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text and the end id; new chunks of all texts are learned together."""
        split = [None if any(c in t for c in ODD_SPACE) else self.folded(t).split() for t in texts]
        if self.held > self.limit:
            self.cache.clear()
            self.held = 0
        new = list(set().union(*filter(None, split)).difference(self.cache))
        self.learn(new)
        ids = self.cache.__getitem__
        made = [
            (self.ids(text) if chunks is None else b"".join(map(ids, chunks))) + self.end
            for text, chunks in zip(texts, split)
        ]
        for chunk in new:
            if len(chunk) > self.chunk_chars:
                del self.cache[chunk]
        return made


@functools.lru_cache(maxsize=1)
def word_tokens(path: str, end_id: int) -> WordTokens:
    """One for all tasks that a Python worker runs, with what it has learned."""
    return WordTokens(path, end_id)


def text_groups(texts: list[str], rows: int, chars: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """(start, end) of neighbouring texts to encode together: bounded in number and in characters."""
    start = size = 0
    for at, text in enumerate(texts):
        if at > start and (at - start >= rows or size + len(text) > chars):
            yield start, at
            start, size = at, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


class Packer:
    """Open windows of one partition or one merge group."""

    def __init__(self, length: int, windows: int, level: int, group: int):
        self.length, self.windows = length, windows
        self.base = (level << LEVEL_BITS) | (group << GROUP_BITS)
        self.used: list[int] = []
        self.rows: list[list[tuple]] = []
        self.made = 0

    def close(self, at: int, still_open: bool = False) -> list[tuple]:
        number = self.base | self.made
        self.made += 1
        rows = [(*row[:5], number, row[5], still_open) for row in self.rows[at]]
        self.used[at], self.rows[at] = self.used[-1], self.rows[-1]
        self.used.pop(), self.rows.pop()
        return rows

    def put(self, at: int, piece: tuple) -> None:
        self.rows[at].append((*piece, self.used[at]))
        self.used[at] += piece[2]

    def open_window(self) -> int:
        self.used.append(0)
        self.rows.append([])
        return len(self.used) - 1

    def add(self, ident, start: int, ids: bytes, doc_tokens: int) -> Iterator[tuple]:
        """Place one run of ids; yields the rows of the windows that this fills."""
        size = self.length
        while ids:
            n = len(ids) // WIDTH
            room = [(size - u, i) for i, u in enumerate(self.used) if size - u >= n]
            if room:
                at, take = min(room)[1], n
            elif len(self.used) < self.windows or n >= size:
                at, take = self.open_window(), min(n, size)
            else:
                at = max(range(len(self.used)), key=self.used.__getitem__)
                take = size - self.used[at]
            self.put(at, (ident, start, take, ids[: take * WIDTH], doc_tokens))
            start, ids = start + take, ids[take * WIDTH :]
            if self.used[at] == size:
                yield from self.close(at)

    def finish(self) -> Iterator[tuple]:
        while self.used:
            yield from self.close(len(self.used) - 1, still_open=True)


def batches(rows: Iterator[tuple], tokens: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += row[2]
        if size >= tokens:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, type=f.type) for c, f in zip(zip(*rows), ARROW_SCHEMA)]
    return pa.RecordBatch.from_arrays(columns, schema=ARROW_SCHEMA)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 2048,
    windows: int = 64,
    end_id: int = 1,
    merge: int = 32,
    together: int = 500,
) -> DataFrame:
    """One row per piece: id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` holds unsigned little-endian 32-bit ids. A document is its ids and then ``end_id``,
    so a null or empty text is one id; very long texts are cut over many windows. Pieces of a
    sequence lie gapless from offset 0. A sequence is padded to ``length`` unless its own length
    is a power of two; see ``padded_length``. Ids are whole numbers, or texts of such. Of windows
    that a text fills equally well, the one opened first or moved to its place is taken. Repeated rows are packed once each. An empty table
    gives an empty result; other columns are not read.
    """

    def fill(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens = word_tokens(tokenizer_path, end_id)
        packer = Packer(length, windows, 0, TaskContext.get().partitionId())

        def rows() -> Iterator[tuple]:
            for batch in arrow:
                idents, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                for start, end in text_groups(texts, together):
                    for ident, ids in zip(idents[start:end], tokens.encode(texts[start:end])):
                        yield from packer.add(ident, 0, ids, len(ids) // WIDTH)
            yield from packer.finish()

        yield from batches(rows())

    source = docs.select(F.col(id_col).cast("long"), text_or_empty(text_col))
    pieces = pin(source.mapInArrow(fill, PIECE_SCHEMA), "pieces")
    done = [pieces.filter(~F.col("open"))]
    still_open = pieces.filter("open")
    groups = (still_open.agg(F.max(_group("sequence_id"))).first()[0] or 0) + 1
    level = 0
    while True:
        level += 1
        groups = -(-groups // merge)
        merged = pin(_merged(still_open, length, level, merge), "pieces")
        done.append(merged.filter(~F.col("open")) if groups > 1 else merged)
        still_open = merged.filter("open")
        if groups == 1:
            break
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    return every.drop("open").withColumnRenamed("id", id_col)


def _group(column: str):
    return F.shiftright(F.col(column), GROUP_BITS).bitwiseAND(F.lit((1 << (LEVEL_BITS - GROUP_BITS)) - 1))


def _merged(still_open: DataFrame, length: int, level: int, merge: int) -> DataFrame:
    """Leftovers of ``merge`` partitions put one after the other; at most one stays open."""

    def concatenate(key: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
        packer = Packer(length, 1, level, key[0].as_py())
        ordered = found.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        rows: list[tuple] = []
        for row in ordered.select(["id", "start", "ids", "doc_tokens"]).to_pylist():
            rows.extend(packer.add(row["id"], row["start"], row["ids"], row["doc_tokens"]))
        rows.extend(packer.finish())
        return pa.Table.from_batches([_batch(rows)] if rows else [], schema=ARROW_SCHEMA)

    grouped = still_open.withColumn("merge_group", F.floor(_group("sequence_id") / merge).cast("long"))
    return grouped.groupBy("merge_group").applyInArrow(concatenate, PIECE_SCHEMA)


def padded_length(sequences: DataFrame, length: int = 2048) -> DataFrame:
    """sequence_id, used and padded: ``used`` itself at a power of two, else ``length``."""
    used = sequences.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    power = F.col("used").bitwiseAND(F.col("used") - 1) == 0
    return used.withColumn("padded", F.when(power, F.col("used")).otherwise(F.lit(length)))
