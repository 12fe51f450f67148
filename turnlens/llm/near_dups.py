"""Near duplicates by order MinHash, verified by banded alignment.

A text is a sequence of words. Its k-mers are runs of two words, each labelled with how often
it has occurred before in the text. Of each of several ranges of hash functions the few smallest
labelled k-mers are taken and put in text order; their hash is one key. Two texts share a key
with a probability that falls with their edit distance, as order counts. No key is a single
k-mer, so that a passage alone seldom gives two texts a common key; long texts have more
keys. Texts that share a key are aligned within a band, and linked from an edit similarity of 0.8 words on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnlens.llm.alignment import similar
from turnlens.llm.common import Scratch, text_or_empty, with_row
from turnlens.llm.hashing import WordHashes, mix, offset, parities, rolling, scramble, words
from turnlens.llm.linking import may_be_similar, verified_groups
from turnlens.sources.tables import pin


@dataclass(frozen=True)
class OrderMinHash:
    """``keys`` sketches or more of ``sampled`` k-mers of ``k`` words each, of very short texts one k-mer less.

    Each hash function gives up to ``ranges`` of them.
    Texts of ``long_words`` or more, which hold a popular passage more often than not, have
    ``long_keys`` sketches of ``long_sampled`` k-mers of ``long_k`` words instead.
    """

    k: int = 2
    sampled: int = 3
    keys: int = 80
    ranges: int = 64
    similarity: float = 0.8
    long_words: int = 1200
    long_k: int = 3
    long_sampled: int = 3
    long_keys: int = 256


def labelled(kmers: np.ndarray) -> np.ndarray:
    """Each k-mer with the number of its earlier occurrences mixed in."""
    ordered = np.sort(kmers)
    if (ordered[1:] != ordered[:-1]).all():
        return mix(kmers, 17)
    order = np.argsort(kmers, kind="stable")
    ordered = kmers[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    counts = np.diff(np.append(first, len(ordered)))
    earlier = np.empty(len(kmers), np.uint64)
    earlier[order] = (np.arange(len(ordered)) - np.repeat(first, counts)).astype(np.uint64)
    return mix(kmers + earlier * np.uint64(0x9FB21C651E98DF25), 17)


def bin_keys(marked: np.ndarray, bins: int, take: int, seed: int, functions: int = 1) -> np.ndarray:
    """A key for each of ``bins`` ranges of hashes, of each function: its ``take`` smallest k-mers, in text order.

    Ranges of one hash function stand for as many functions, at the cost of one. Ranges of too few
    k-mers have no key if others have one.
    """
    hashed = scramble((marked + offset(seed))[None, :] + np.arange(functions).astype(np.uint64)[:, None] * offset(seed + 1)).ravel()
    bin_of = ((hashed >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    bin_of += np.repeat(np.arange(functions).astype(np.uint64) * np.uint64(bins), len(marked))
    order = np.argsort(bin_of << np.uint64(48) | hashed & np.uint64((1 << 48) - 1))
    of = bin_of[order]
    first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    at = first[:, None] + np.arange(take)
    inside = at < np.append(first[1:], len(order))[:, None]
    whole = inside.all(axis=1)
    if whole.any():
        at, inside, first = at[whole], inside[whole], first[whole]
    places = np.sort(np.where(inside, order.take(at, mode="clip") % len(marked), len(marked)), axis=1)
    values, key = np.append(marked, np.uint64(0)), of[first] + np.uint64(seed)
    for place in places.T:
        key = mix(key ^ values[place], 31)
    return key


def length_class(words: int, omh: OrderMinHash) -> int:
    """The logarithm of the number of ranges that leaves about twice as many k-mers to each as are taken."""
    return max(1, min(omh.ranges, words // (2 * omh.sampled))).bit_length() - 1


def order_keys(tokens: np.ndarray, omh: OrderMinHash) -> np.ndarray:
    """The distinct keys of one text; a text shorter than k words is one k-mer.

    Short texts have fewer ranges of more functions, so that a key is never a single k-mer. Lengths
    around a bound have the keys of both sides, so that similar texts share one.
    """
    if not len(tokens):
        return np.empty(0, np.int64)
    keys = []
    least = int(len(tokens) * omh.similarity)
    if len(tokens) * omh.similarity < omh.long_words:
        marked = labelled(rolling(tokens, min(omh.k, len(tokens))))
        for c in {length_class(least, omh), length_class(len(tokens), omh)}:
            take = omh.sampled if c > 1 else omh.sampled - 1
            keys.append(bin_keys(marked, 1 << c, take, 1000 + 10 * c, -(-omh.keys >> c)))
    if len(tokens) >= omh.long_words:
        marked = labelled(rolling(tokens, omh.long_k))
        keys.append(bin_keys(marked, omh.long_keys, omh.long_sampled, 102))
    return np.unique(np.concatenate(keys).view(np.int64))


def token_match(threshold: float):
    """Scalar function: do two binary columns of 32-bit tokens align well enough?"""

    @F.pandas_udf("boolean")
    def match(left: pd.Series, right: pd.Series) -> pd.Series:
        def one(x: bytes, y: bytes) -> bool:
            return similar(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32), threshold)

        return pd.Series([one(x, y) for x, y in zip(left, right)], dtype=bool)

    return match


#: Counts that a text's words are reduced to.
BAG = 256


def bag(tokens: bytes) -> bytes:
    """How many words fall to each of a few numbers, up to 255."""
    counts = np.bincount(np.frombuffer(tokens, np.uint32) % BAG, minlength=BAG)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def with_bags(content: DataFrame) -> DataFrame:
    """``content`` (id, tokens) with n, the bytes of tokens, and bag."""

    @F.pandas_udf("binary")
    def bags(tokens: pd.Series) -> pd.Series:
        return tokens.map(bag)

    return content.select("id", "tokens", F.octet_length("tokens").alias("n"), bags("tokens").alias("bag"))


def bags_fit(left: list[bytes], right: list[bytes], most: np.ndarray) -> np.ndarray:
    """Whether bags differ by no more than so many edits: each edit adds and takes away one word at most."""
    if not len(left):
        return np.empty(0, bool)
    x, y = (np.frombuffer(b"".join(side), np.uint8).reshape(-1, BAG).astype(np.int16) for side in (left, right))
    differ = x - y
    return np.maximum(differ.clip(min=0).sum(axis=1), (-differ).clip(min=0).sum(axis=1)) <= most


def aligned(pairs: DataFrame, content: DataFrame, threshold: float) -> DataFrame:
    """Those pairs (a, b) whose content (id, tokens) has an edit similarity of ``threshold``.

    ``content``, made by ``with_bags``, is laid out by id, so that only pairs move to it. Pairs
    whose lengths or bags of words already rule a match out go before any text is read.
    """
    match = token_match(threshold)

    @F.pandas_udf("boolean")
    def may_match(left: pd.Series, right: pd.Series, n: pd.Series) -> pd.Series:
        most = ((1.0 - threshold) * (n.to_numpy() // 4) + 1e-6).astype(np.int64)
        return pd.Series(bags_fit(left.tolist(), right.tolist(), most), dtype=bool)

    small = content.select("id", "n", "bag")
    both = pairs.join(small.toDF("b", "n", "y"), "b").join(small.toDF("a", "m", "x"), "a")
    both = both.filter(F.least("m", "n") >= F.greatest("m", "n") * threshold - 0.001)
    fitting = both.filter(may_match("x", "y", F.greatest("m", "n"))).select("a", "b")
    left, right = content.select(F.col("id").alias("a"), F.col("tokens").alias("x")), content.select(F.col("id").alias("b"), F.col("tokens").alias("y"))
    named = fitting.join(right, "b").join(left, "a")
    return named.filter(match("x", "y"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    omh: OrderMinHash = OrderMinHash(),
    row_col: str | None = None,
) -> DataFrame:
    """One row per input row: row, id, class_id, class_size, kept.

    Texts of equal words are one class, and so are those that links connect. class_id is the
    smallest id of a class; the row with it (of repeated rows one) is kept. A null id comes
    after all others. Texts without any word, null and empty among them, are in a class only
    with identical texts. Very long texts are read whole. An empty table gives an empty result;
    other columns are not read. Rows are told apart by ``row``, so repeated rows stay apart; it is
    a new number, or ``row_col``, whole numbers that differ from row to row.
    """
    source = with_row(docs, F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), row_col=row_col)
    scratch = Scratch(docs.sparkSession)
    made = scratch.pin(sketches(source.select("row", "text", "id"), omh), "sketches")
    found = classes(made, made.select("row", "digest", "id"), omh)
    scratch.drop()
    return found.select("row", F.col("id").alias(id_col), "class_id", "class_size", "kept")


#: Longs of the sketch of a text, which says how far apart two texts are at least.
SKETCH = 16
MARKS = [f"s{i}" for i in range(SKETCH)]


def sketches(source: DataFrame, omh: OrderMinHash) -> DataFrame:
    """row, id, digest of the words, their 32-bit hashes, the keys, the number of words and MARKS, from (row, text, id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            made, marks = [], []
            for text in batch.column(1):
                words_in = hashes.of(words(text.as_py()))
                # Without any word only the text itself can be equal to another.
                content = words_in.tobytes() if len(words_in) else b"\0" + text.as_py().encode("utf-8", "surrogatepass")
                made.append((xxhash.xxh3_128_digest(content), words_in.astype(np.uint32).tobytes(), order_keys(words_in, omh), len(words_in)))
                marks.append(parities(words_in, np.array([len(words_in)]), SKETCH))
            if made:
                digest, tokens, keys, n = zip(*made)
                columns = [batch.column(0), batch.column(2), pa.array(digest), pa.array(tokens), pa.array(keys, pa.list_(pa.int64()))]
                columns += [pa.array(n, pa.int32()), *map(pa.array, np.ascontiguousarray(np.concatenate(marks).T))]
                yield pa.RecordBatch.from_arrays(columns, ["row", "id", "digest", "tokens", "keys", "n", *MARKS])

    schema = f"row long, id {source.schema['id'].dataType.simpleString()}, digest binary, tokens binary, keys array<long>, n int, "
    schema += ", ".join(f"{m} long" for m in MARKS)
    return source.mapInArrow(run, schema)


def classes(made: DataFrame, members: DataFrame, omh: OrderMinHash) -> DataFrame:
    """members with class_id, class_size and kept, from their sketches."""
    scratch = Scratch(made.sparkSession)
    firsts = scratch.pin(made.groupBy("digest").agg(F.min("row").alias("first")), "firsts")
    distinct = made.join(firsts.select(F.col("first").alias("row")), "row", "left_semi")
    content = scratch.bucketed(with_bags(distinct.select(F.col("row").alias("id"), "tokens")), "id", "content")
    keys = distinct.select(F.col("row").alias("id"), "keys")
    marked = distinct.select(F.col("row").alias("id"), "n", *MARKS)
    fits = may_be_similar(omh.similarity, SKETCH)
    roots = verified_groups(keys, lambda pairs: aligned(pairs, content, omh.similarity), fits, marked)
    group = F.coalesce("root", "first").alias("group")
    placed = members.join(firsts, "digest").join(roots.withColumnRenamed("id", "first"), "first", "left")
    # The result reads this table, so it stays.
    placed = pin(placed.select(*members.columns, group), "placed")
    scratch.drop()
    best = placed.groupBy("group").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("best"), F.count(F.lit(1)).alias("class_size")
    )
    return placed.join(best, "group").select(
        *members.columns,
        F.col("best.id").alias("class_id"),
        "class_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
    )
