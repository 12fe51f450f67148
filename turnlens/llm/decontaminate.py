"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into passages; their TF-IDF matrix over hashed words gets a distributed
randomised SVD. Benchmark items and windows of every text, as long as the items, are folded
into that space, and windows whose cosine with an item is high enough are candidates. A
candidate counts when most of the item's words stand there in order (longest common
subsequence), or fewer of them for a paraphrase that still holds the item's answer, which is
taken to be its last words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnlens.llm.common import text_or_empty
from turnlens.llm.hashing import WordHashes, words
from turnlens.llm.latent import idf_of, random_basis, right_singular, sum_arrays
from turnlens.sources.tables import pin

COLUMNS = 1 << 14
#: Words of an item are looked up by so many low values of their hashes before they are compared.
SLOTS = 1 << 12


@dataclass(frozen=True)
class Retrieval:
    """``item_block`` and ``item_bytes`` bound the benchmark items that are held at once; more come in turns."""

    rank: int = 96
    extra: int = 8
    idf_power: float = 3.0
    passage: int = 32
    cosine: float = 0.4
    copied: float = 0.8
    paraphrased: float = 0.6
    answer_words: int = 5
    step: int = 4
    growth: float = 1.5
    shortest: int = 5
    item_block: int = 2000
    item_bytes: int = 1 << 23


RESULT = "id long, item_id long, start_word long, n_words long, common double, answer boolean, cosine double"
ARROW_RESULT = pa.schema(
    [("id", pa.int64()), ("item_id", pa.int64()), ("start_word", pa.int64()), ("n_words", pa.int64()),
     ("common", pa.float64()), ("answer", pa.bool_()), ("cosine", pa.float64())]
)


def columns_of(tokens: np.ndarray) -> np.ndarray:
    """The leading bits of the words' 32-bit hashes."""
    return (tokens >> np.uint32(32 - 14)).astype(np.uint16)


def tokenised(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id and the words of each text as 32-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            tokens = [hashes.of(words(t.as_py())).astype(np.uint32).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens, pa.binary())], ["id", "tokens"])

    return docs.select(F.col(id_col).cast("long"), text_or_empty(text_col)).mapInArrow(run, "id long, tokens binary")


def _each(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[np.ndarray]:
    for batch in batches:
        for value in batch.column(column):
            yield np.frombuffer(value.as_buffer(), np.uint32)


def few(tokens: DataFrame) -> DataFrame:
    """The words in as many partitions as tasks run at a time, twice over: each of them gives one sum."""
    return tokens.select("tokens").coalesce(2 * tokens.sparkSession.sparkContext.defaultParallelism)


def frequencies(tokens: DataFrame) -> tuple[np.ndarray, float]:
    """In how many texts each column occurs, and how many texts there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COLUMNS + 1)
        for text in _each(batches):
            seen = np.zeros(COLUMNS + 1)
            seen[columns_of(text)] = 1
            seen[COLUMNS] = 1
            total += seen
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    total = sum_arrays(few(tokens).mapInArrow(count, "part binary"), COLUMNS + 1)
    return total[:COLUMNS], total[COLUMNS]


def _passages(texts: Iterator[np.ndarray], length: int, size: int = 1 << 17) -> Iterator[np.ndarray]:
    """Columns of all passages of many texts.

    The last passage of a text is filled up with COLUMNS.
    """
    held, count = [], 0
    for text in texts:
        for start in range(0, len(text), size):
            part = text[start : start + size]
            columns = np.append(columns_of(part), np.full(-len(part) % length, COLUMNS, np.uint16))
            held.append(columns)
            count += columns.size
            if count >= size:
                yield np.concatenate(held)
                held, count = [], 0
    if count:
        yield np.concatenate(held)


def fit_axes(tokens: DataFrame, weight: np.ndarray, how: Retrieval) -> np.ndarray:
    """columns x rank: turns word counts into latent coordinates of equal spread."""
    basis = random_basis(COLUMNS, how.rank + how.extra)
    projection = np.zeros((COLUMNS + 1, basis.shape[1]), np.float32)
    projection[:COLUMNS] = weight[:, None] * basis

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        product = np.zeros((basis.shape[1], COLUMNS + 1))
        for columns in _passages(_each(batches), how.passage):
            places = columns.astype(np.intp)
            passages = projection.take(places, axis=0).reshape(-1, how.passage, basis.shape[1]).sum(axis=1)
            for total, axis in zip(product, np.ascontiguousarray(passages.T, np.float64)):
                total += np.bincount(places, np.repeat(axis, how.passage), COLUMNS + 1)
        yield pa.RecordBatch.from_arrays([pa.array([product[:, :COLUMNS].T.tobytes()], pa.binary())], ["part"])

    total = sum_arrays(few(tokens).mapInArrow(sketch, "part binary"), basis.size).reshape(basis.shape)
    axes, singular = right_singular(weight[:, None] * total, basis, how.rank)
    return (weight[:, None] * axes / np.maximum(singular, 1e-12)).astype(np.float32)


def common_words(item: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence; bit-parallel over the item."""
    where: dict[int, int] = {}
    for i, x in enumerate(item.tolist()):
        where[x] = where.get(x, 0) | (1 << i)
    full = (1 << len(item)) - 1
    row = full
    for x in text.tolist():
        hit = where.get(x)
        if hit is not None:
            match = row & hit
            row = ((row + match) | (row - match)) & full
    return len(item) - bin(row).count("1")


def running_sums(table: np.ndarray, rows: np.ndarray, block: int = 32) -> np.ndarray:
    """Row i: the sum of the first i of ``rows`` of a table. Blocks are summed up by one product, then their totals."""
    count, width = len(rows), table.shape[1]
    padded = np.empty((-(-count // block) * block, width), np.float32)
    table.take(rows, axis=0, out=padded[:count], mode="clip")
    padded[count:] = 0
    sums = np.empty((len(padded) + 1, width), np.float32)
    sums[0] = 0
    blocks = sums[1:].reshape(-1, block, width)
    np.matmul(np.tri(block, dtype=np.float32), padded.reshape(-1, block, width), out=blocks)
    blocks[1:] += np.cumsum(blocks[:-1, -1], axis=0)[:, None]
    return sums[: count + 1]


class Items:
    """Benchmark items, in classes of like length, with their latent vectors."""

    def __init__(self, rows: list[tuple[int, str]], axes: np.ndarray, how: Retrieval):
        hashes = WordHashes()
        self.how, self.axes = how, axes
        self.ids: list[int] = []
        self.tokens: list[np.ndarray] = []
        for ident, text in rows:
            tokens = hashes.of(words(text or "")).astype(np.uint32)
            if len(tokens):
                self.ids.append(ident)
                self.tokens.append(tokens)
        self.sets = [set(t.tolist()) for t in self.tokens]
        self.repeats = [len(t) - len(own) for t, own in zip(self.tokens, self.sets)]
        classes: dict[int, list[int]] = {}
        for i, tokens in enumerate(self.tokens):
            step = round(math.log(len(tokens)) / math.log(how.growth))
            classes.setdefault(max(1, round(how.growth**step)), []).append(i)
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)
        self.classes = [
            (length, np.array(own), self.vectors(own), self.slots(own)) for length, own in sorted(classes.items())
        ]

    def vectors(self, own: list[int]) -> np.ndarray:
        made = np.array([self.axes[columns_of(self.tokens[i])].sum(axis=0) for i in own], np.float32)
        return made / np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-12)

    def slots(self, own: list[int]) -> np.ndarray:
        """item x slot: whether one of the item's words falls there."""
        made = np.zeros((len(own), SLOTS), bool)
        for row, i in enumerate(own):
            made[row, self.tokens[i] % SLOTS] = True
        return made

    def enough(self, items, present, which, slots, firsts, begins, lengths, at_once: int = 1 << 20) -> np.ndarray:
        """Whether as many words near each window may be words of its item as a match needs at least.

        Slots that several words share only let more through; the rest is left to ``verified``.
        """
        out = np.zeros(len(items), bool)
        if not len(items):
            return out
        sizes = self.sizes[items]
        reach = np.maximum(2, sizes // 2)
        low = firsts + np.maximum(0, begins - reach)
        high = np.minimum(firsts + lengths, firsts + begins + sizes + reach)
        width = int((high - low).max())
        step, flat = max(1, at_once // max(1, width)), present.reshape(-1)
        following = np.lib.stride_tricks.sliding_window_view(np.append(slots, np.zeros(width, slots.dtype)), width)
        row = (which * SLOTS).astype(np.int32)
        for start in range(0, len(items), step):
            part = slice(start, start + step)
            hits = flat.take(following[low[part]] + row[part, None])
            hits &= np.arange(width) < (high - low)[part, None]
            out[part] = np.count_nonzero(hits, axis=1) >= self.how.paraphrased * sizes[part]
        return out

    def matches(self, texts: list[np.ndarray]) -> Iterator[tuple]:
        """(text number, item_id, start_word, n_words, common, answer, cosine): the best place of
        each item in each of some texts. Windows are laid over the texts one after the other."""
        lengths = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(lengths)
        joined = np.concatenate(texts) if texts else np.empty(0, np.uint32)
        if not len(joined):
            return
        sums = running_sums(self.axes, columns_of(joined))
        slots = (joined % SLOTS).astype(np.int32)
        best: dict[tuple[int, int], tuple] = {}
        for length, own, vectors, present in self.classes:
            size = min(length, len(joined))
            last, step = len(joined) - size, max(1, length // self.how.step)
            starts = np.append(np.arange(0, last, step), last)
            windows = np.empty((len(starts), sums.shape[1]), np.float32)
            np.subtract(sums[size : size + last : step], sums[0:last:step], out=windows[:-1])
            np.subtract(sums[last + size], sums[last], out=windows[-1])
            scale = np.sqrt(np.einsum("ij,ij->i", windows, windows))
            cosines = windows @ vectors.T
            at, which = np.nonzero(cosines >= self.how.cosine * np.maximum(scale, 1e-12)[:, None])
            found_in = np.searchsorted(ends, starts[at] + size // 2, side="right")
            firsts = ends[found_in] - lengths[found_in]
            begins = np.maximum(0, starts[at] - firsts)
            enough = self.enough(own[which], present, which, slots, firsts, begins, lengths[found_in])
            for a, w, number, begin in zip(at[enough].tolist(), which[enough].tolist(), found_in[enough].tolist(), begins[enough].tolist()):
                found = self.verified(int(own[w]), texts[number], begin, float(cosines[a, w] / scale[a]))
                place = (number, int(own[w]))
                if found and (place not in best or found[3] > best[place][3]):
                    best[place] = found
        for (number, _), found in sorted(best.items()):
            yield number, *found

    def verified(self, i: int, text: np.ndarray, start: int, cosine: float) -> tuple | None:
        item, how = self.tokens[i], self.how
        reach = max(2, len(item) // 2)
        low = max(0, start - reach)
        near = text[low : start + len(item) + reach]
        needed = how.paraphrased * len(item)
        if len(self.sets[i].intersection(near.tolist())) < needed - self.repeats[i]:
            return None
        common = common_words(item, near)
        if common < needed:
            return None
        tail = item[-how.answer_words :]
        answer = common_words(tail, near) >= how.copied * len(tail)
        if common < how.copied * len(item) - 1e-9 and not answer:
            return None
        if len(item) < how.shortest and common < len(item):
            return None
        return self.ids[i], low, len(near), common / len(item), bool(answer), cosine


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    how: Retrieval = Retrieval(),
) -> DataFrame:
    """A row for each text and benchmark item found in it: id, item_id, start_word, n_words,
    common (share of the item's words there in order), answer, cosine.

    Every window of every text is searched, with the words of very long texts too. Null and
    empty texts and items hold nothing. Items of fewer than five words must be there whole.
    Ids are whole numbers, or texts of such. Repeated rows give repeated results; equal items are found each. Empty tables give an empty
    result. Columns other than those named are not read. Of several places of an item in one
    text the one with the most common words is given, the first of equal ones.
    """
    spark = docs.sparkSession
    tokens = pin(tokenised(docs, id_col, text_col), "tokens")
    counted, rows = frequencies(tokens)
    axes = spark.sparkContext.broadcast(fit_axes(tokens, idf_of(counted, rows) ** how.idf_power, how))
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), text_or_empty(item_text_col).alias("text"))
    count, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    turns = max(1, -(-count // how.item_block), -(-size // how.item_bytes))
    turn_of = F.pmod(F.xxhash64("item", "text"), F.lit(turns))
    found = None
    for turn in range(turns):
        rows_now = [tuple(r) for r in items.filter(turn_of == turn).collect()]  # about as much as the bounds allow
        part = tokens.mapInArrow(_search(spark.sparkContext.broadcast(rows_now), axes, how), RESULT)
        found = part if found is None else found.unionByName(part)
    return found.withColumnRenamed("id", id_col).withColumnRenamed("item_id", item_col)


def _search(items, axes, how: Retrieval, words_at_once: int = 1 << 16):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Items(items.value, axes.value, how)

        def found(ids: list, texts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            rows = [(ids[number], *rest) for number, *rest in known.matches(texts)]
            if rows:
                columns = [pa.array(c, type=f.type) for c, f in zip(zip(*rows), ARROW_RESULT)]
                yield pa.RecordBatch.from_arrays(columns, schema=ARROW_RESULT)

        ids, texts, held = [], [], 0
        for batch in batches:
            for ident, text in zip(batch.column(0).to_pylist(), _each(iter([batch]), 1)):
                ids.append(ident)
                texts.append(text)
                held += len(text)
                if held >= words_at_once:
                    yield from found(ids, texts)
                    ids, texts, held = [], [], 0
        yield from found(ids, texts)

    return run
