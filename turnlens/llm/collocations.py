"""Phrases of a corpus, counted over a prefix-free parse.

Texts fall into pieces at punctuation, and pieces into words. A piece is cut wherever the hash
of two neighbouring words is a trigger, so equal passages are cut alike wherever they stand.
Chunks overlap by the two words of the trigger. The distinct chunks, with how often each occurs,
form the dictionary of the parse; n-grams are counted inside distinct chunks only and weighted
with that number. An n-gram belongs to the chunk in which it starts before the overlap with the
next one, so none is counted twice and none is lost. Words and pairs are counted first; runs of
three words are looked at only where both of their pairs are frequent enough.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import NGram
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnlens.llm.common import Scratch, text_or_empty
from turnlens.llm.hashing import WordHashes, mix

#: Stands between pieces in a list of words; no word holds it.
BREAK = "\n"
#: UTF-8 bytes in lower case, with BREAK for those that end a piece and a space for those that end a word. Fixed by the contract.
BYTES = bytes(10 if b in b".,;:!?\n\v\f\r" else 32 if b == 9 else ord(chr(b).lower()) if b < 128 else b for b in range(256))
#: Words that a chunk shares with the next one: all but one word of the longest phrase.
OVERLAP = 2


@dataclass(frozen=True)
class Mining:
    """``every``: about one in so many word pairs ends a chunk. ``shares`` spreads the first
    ranking of a group over so many tasks. ``filter_bytes``, a power of two, is the size of the
    filter by which runs of three words with a rare pair are left out before they are shuffled."""

    least: int = 10
    keep: int = 2000
    covered: int = 50
    every: int = 12
    shares: int = 64
    filter_bytes: int = 1 << 23
    no_lang: str = "und"


def words_and_breaks(raw: bytes) -> list[str]:
    """The words of a text, with a break between its pieces."""
    return list(filter(None, raw.translate(BYTES).replace(b"\n", b" \n ").decode("utf-8").split(" ")))


class WordsAndBreaks(WordHashes):
    """Like WordHashes, with -1 for a break; hashes of words are not negative."""

    def __missing__(self, word: str) -> int:
        return -1 if word == BREAK else super().__missing__(word)


def chunk_bounds(hashes: np.ndarray, breaks: np.ndarray, every: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, last) of the chunks of a list of words; ``breaks`` says where pieces end."""
    n = len(hashes)
    at = np.flatnonzero(breaks)
    begins, ends = np.concatenate(([0], at + 1)), np.append(at, n)
    filled = ends > begins
    begins, ends = begins[filled], ends[filled]
    if not len(begins):
        return (np.empty(0, np.int64),) * 3
    pair = mix(hashes[:-1].astype(np.uint64) * np.uint64(0x100000001B3) + mix(hashes[1:], 61), 67)
    trigger = np.flatnonzero(pair % np.uint64(every) == 0)
    piece = np.searchsorted(begins, trigger, side="right") - 1
    # A cut at the start of a piece, or one that leaves nothing but the overlap, changes nothing.
    inside = (piece >= 0) & (trigger > begins[np.maximum(piece, 0)]) & (trigger + OVERLAP < ends[np.maximum(piece, 0)])
    starts = np.sort(np.concatenate((begins, trigger[inside])))
    end = ends[np.searchsorted(begins, starts, side="right") - 1]
    following = np.append(starts[1:], n + OVERLAP)
    last = following >= end
    return starts, np.where(last, end, following + OVERLAP), last


def parse(texts: DataFrame, every: int, held: int = 100_000) -> DataFrame:
    """lang, chunk, last and n: the chunks of (lang, text); n is the sum over a bounded number of them.

    Rows with an empty chunk carry the number of words instead.
    """
    schema = pa.schema([("lang", pa.string()), ("chunk", pa.string()), ("last", pa.bool_()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordsAndBreaks(200_000)
        counts: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, found in counts.items():
                keys = list(found)
                last = [not k.endswith(BREAK) for k in keys]
                chunks = [k if whole else k[:-1] for k, whole in zip(keys, last)]
                columns = [pa.array([lang] * len(keys), pa.string()), pa.array(chunks, pa.string()),
                           pa.array(last, pa.bool_()), pa.array(found.values(), pa.int64())]
                yield from pa.Table.from_arrays(columns, schema=schema).to_batches(max_chunksize=20_000)
            counts.clear()

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lang, value in zip(langs, batch.column(1)):
                named = words_and_breaks(value.as_buffer().to_pybytes())
                if not named:
                    continue
                hashed = hashes.of(named)
                breaks = hashed == -1
                starts, ends, last = chunk_bounds(hashed, breaks, every)
                found = counts.setdefault(lang, Counter())
                found.update([" ".join(named[a:b]) if z else " ".join(named[a:b]) + BREAK for a, b, z in zip(starts.tolist(), ends.tolist(), last.tolist())])
                found[""] += len(named) - int(breaks.sum())
                if sum(map(len, counts.values())) >= held:
                    yield from flush()
        yield from flush()

    return texts.mapInArrow(run, "lang string, chunk string, last boolean, n long")


def short_runs(dictionary: DataFrame) -> DataFrame:
    """lang, phrase, f of single words and pairs of them; the empty phrase has the number of all words."""
    words = F.when(F.col("chunk") == "", F.array(F.lit(""))).otherwise(F.split("chunk", " "))
    rows = NGram(n=2, inputCol="w1", outputCol="w2").transform(dictionary.select("lang", "n", "last", words.alias("w1")))
    own = F.size("w1") - F.when(F.col("last"), 0).otherwise(OVERLAP)
    grams = F.concat(*[F.slice(w, F.lit(1), own) for w in ("w1", "w2")])
    exploded = rows.select("lang", "n", F.explode(grams).alias("phrase"))
    return exploded.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def pair_hashes(hashes: np.ndarray, langs: np.ndarray) -> np.ndarray:
    """A hash of each word with the next one, in its language."""
    first = mix(hashes[:-1], 71) * np.uint64(0x100000001B3)
    return mix(first + mix(hashes[1:], 73) + langs[:-1], 79)


def _lang_hashes(hashes: WordHashes, langs: list[str]) -> np.ndarray:
    return mix(hashes.of([f"\n{lang}" for lang in langs]), 83)


class PairFilter:
    """Bloom filter of word pairs. Of fixed size: when very full it lets more through, and loses nothing."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 8 - 1)

    def places(self, pairs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for seed in (0, 1, 2):
            at = mix(pairs, 89 + seed) & self.mask
            yield (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)

    def add(self, pairs: np.ndarray) -> None:
        for byte, bit in self.places(pairs):
            np.bitwise_or.at(self.bits, byte, bit)

    def has(self, pairs: np.ndarray) -> np.ndarray:
        found = np.ones(len(pairs), bool)
        for byte, bit in self.places(pairs):
            found &= (self.bits[byte] & bit) != 0
        return found


def frequent_pairs(phrases: DataFrame, size: int) -> bytes:
    """The bits of a filter, of ``size`` bytes, that holds all phrases of two words in (lang, phrase)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, made = WordHashes(), PairFilter(np.zeros(size, np.uint8))
        for batch in batches:
            named = " ".join(batch.column(1).to_pylist()).split(" ") if len(batch) else []
            langs = np.repeat(_lang_hashes(hashes, batch.column(0).to_pylist()), 2)
            made.add(pair_hashes(hashes.of(named), langs)[::2] if named else np.empty(0, np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array([made.bits.tobytes()], pa.binary())], ["bits"])

    def either(a: bytes, b: bytes) -> bytes:
        if not a or not b:
            return a or b
        return (np.frombuffer(a, np.uint8) | np.frombuffer(b, np.uint8)).tobytes()

    pairs = phrases.filter(size_of(F.col("phrase")) == 2).select("lang", "phrase")
    parts = pairs.coalesce(64).mapInArrow(build, "bits binary").rdd.map(lambda row: bytes(row[0]))
    return parts.treeReduce(either, 3)


def long_runs(dictionary: DataFrame, bits: bytes) -> DataFrame:
    """lang, phrase, f of three words; those with a pair that is not among the frequent ones are left out.

    No run of words is more frequent than its parts, so none that is wanted goes.
    """
    kept = dictionary.sparkSession.sparkContext.broadcast(bits)
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, known = WordHashes(), PairFilter(np.frombuffer(kept.value, np.uint8))
        for batch in batches:
            langs = batch.column(0).to_pylist()
            sizes = pc.count_substring(batch.column(1), " ").to_numpy() + 1
            named = " ".join(batch.column(1).to_pylist()).split(" ")
            if len(named) < 3:
                continue
            chunk = np.repeat(np.arange(len(sizes)), sizes)
            frequent = known.has(pair_hashes(hashes.of(named), _lang_hashes(hashes, langs)[chunk]))
            # Every chunk holds its last three words whole, so no start needs to be left out but those at its end.
            whole = chunk[:-2] == chunk[2:]
            starts = np.flatnonzero(frequent[:-1] & frequent[1:] & whole)
            phrases = [" ".join(named[i : i + 3]) for i in starts.tolist()]
            of = pa.array(chunk[starts])
            columns = [batch.column(0).take(of), pa.array(phrases, pa.string()), batch.column(2).take(of)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = dictionary.filter("chunk <> ''").select("lang", "chunk", "n").mapInArrow(run, "lang string, phrase string, n long")
    return rows.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def size_of(phrase: Column) -> Column:
    """Words of a phrase."""
    return F.length(phrase) - F.length(F.replace(phrase, F.lit(" "), F.lit(""))) + 1


def _head(phrase: Column, words: int) -> Column:
    return F.substring_index(phrase, " ", words)


def scored(counts: DataFrame, how: Mining) -> DataFrame:
    """lang, phrase, size, a, l, r, score of every candidate, at its lowest-scoring cut."""
    phrase, size = F.col("phrase"), F.col("size")
    candidates = counts.withColumn("size", size_of(phrase)).filter((size > 1) & (F.col("f") >= how.least))
    cut = F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    parts = candidates.select("lang", "phrase", "size", F.col("f").alias("a"), cut)
    first = F.when(F.col("k") == 1, _head(phrase, 1)).otherwise(_head(phrase, 2))
    rest = F.when(F.col("k") == size - 1, _head(phrase, -1)).otherwise(_head(phrase, -2))
    parts = parts.withColumns({"first": first, "rest": rest})
    # Every part of a candidate is as frequent as it is, and so among the counts.
    parts = parts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    parts = parts.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    wide = {c: F.col(c).cast("decimal(16,0)") for c in ("a", "l", "r")}
    exact = parts.select("lang", "phrase", "size", "k", "a", "l", "r", *[v.alias(f"{c}_") for c, v in wide.items()])
    exact = exact.withColumn("score", F.expr("(CAST(1000000 AS DECIMAL(7,0)) * (a_ * a_)) div (l_ * r_)"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    best = exact.groupBy("lang", "phrase", "size", "a").agg(lowest)
    return best.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")


def maximal(candidates: DataFrame, how: Mining) -> DataFrame:
    """Those candidates that no longer one, which holds their words, occurs in often enough."""
    long = candidates.filter(F.col("size") == OVERLAP + 1)
    inner = F.explode(F.array(_head(F.col("phrase"), OVERLAP), _head(F.col("phrase"), -OVERLAP))).alias("phrase")
    around = long.select("lang", inner, "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    both = candidates.join(around, ["lang", "phrase"], "left")
    covered = F.coalesce(F.col("longer") * 100 >= F.col("a") * how.covered, F.lit(False))
    return both.filter(~covered).drop("longer")


def best_of(candidates: DataFrame, how: Mining) -> DataFrame:
    """The first of each language; shares of it are cut first, so that no task ranks a whole language."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = candidates.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(how.shares)))
    place = F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))
    few = share.withColumn("place", place).filter(F.col("place") <= how.keep).drop("share", "place")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= how.keep)


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", how: Mining = Mining()
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first phrases of every language.

    Null texts are empty and hold no phrase, a null language counts as ``und``. Very long texts
    are read whole, repeated rows count each. Ties in score are ranked by frequency, then by the
    bytes of the phrase. An empty table gives an empty result; columns other than those named
    are not read, whatever their names.
    """
    scratch = Scratch(docs.sparkSession)
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(how.no_lang)).alias("lang")
    parsed = parse(docs.select(lang, text_or_empty(text_col).alias("text")), how.every)
    dictionary = scratch.pin(parsed.groupBy("lang", "chunk", "last").agg(F.sum("n").alias("n")), "dictionary")
    frequent = F.col("f") >= how.least
    short = scratch.pin(short_runs(dictionary).filter(frequent | (F.col("phrase") == "")), "short-runs")
    long = long_runs(dictionary, frequent_pairs(short, how.filter_bytes)).filter(frequent)
    counts = Scratch(docs.sparkSession).pin(short.unionByName(long), "phrases")
    scratch.drop()
    phrases = counts.filter(frequent & (F.col("phrase") != ""))
    best = best_of(maximal(scored(phrases, how), how), how)
    total = counts.filter(F.col("phrase") == "").select("lang", F.col("f").alias("n"))
    return best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
