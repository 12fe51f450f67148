"""Licence scan by a positional index of rare tokens, in DataFrame functions only.

Each template is indexed by the two rarest words (highest IDF over the scanned files) of its
mandatory key phrase and their places in it. A file looks up its occurrences of those words,
turns each into the place where the template would start, and intersects the two lists of
starts. Only the starts that remain are verified: the key phrase must stand there word by
word, and enough of the template's other words must be in place. The intersection never
misses a true place, because a key phrase that is there has both words there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlens.llm.common import text_or_empty

#: A word: a run of anything but ASCII other than digits and lower-case letters.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    """Words of a licence text; words[key_at:key_at + key_len] is the mandatory phrase."""

    label: str
    words: tuple[str, ...]
    key_at: int
    key_len: int
    base: bool = False

    @property
    def key(self) -> tuple[str, ...]:
        return self.words[self.key_at : self.key_at + self.key_len]


def template(label: str, text: str, key: str | None = None, base: bool = False) -> Template:
    words, phrase = tuple(text.split()), tuple((key or text).split())
    at = next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)
    return Template(label, words, at, len(phrase), base)


# Phrases and labels of the base set.
BASE = (
    template("gpl", "gnu general public license", base=True),
    template("apache", "apache license", base=True),
    template("cc-by", "cc by", base=True),
    template("mit", "mit license", base=True),
)

# Opening words of further licence texts and notices, and the phrase each must have.
MORE = (
    template("gpl-3", "licensed under the gnu general public license version 3", "public license version 3"),
    template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    template("mit-release", "released under the mit license", "under the mit license"),
    template("lgpl", "gnu lesser general public license"),
    template("agpl", "gnu affero general public license"),
    template("mpl", "mozilla public license"),
    template("cc-attribution", "creative commons attribution"),
    template(
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        "hereby granted free of charge",
    ),
    template(
        "bsd-text",
        "redistribution and use in source and binary forms with or without modification are permitted",
        "source and binary forms",
    ),
    template(
        "isc-text",
        "permission to use copy modify and or distribute this software for any purpose with or without fee",
        "for any purpose with or without fee",
    ),
    template("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software"),
)

TEMPLATES = BASE + MORE

#: Share of a template's words that must be in place besides the key phrase.
IN_PLACE = 0.8


def words_of(column: str = "text") -> Column:
    """Every word of the whole text, A-Z lower-cased and no other letter changed."""
    return F.regexp_extract_all(F.translate(text_or_empty(column), UPPER, LOWER), F.lit(f"({WORD})"), 1)


def _strings(values) -> Column:
    return F.array(*map(F.lit, values))


def word_idf(words: DataFrame, vocabulary: tuple[str, ...]) -> dict[str, float]:
    """ln((1 + files) / (1 + files with the word)) for every template word, over all files."""
    found = words.select(F.explode(F.concat(F.array_intersect("words", _strings(vocabulary)), F.array(F.lit("")))).alias("word"))
    counts = dict(found.groupBy("word").count().collect())  # a row per template word at most
    files = counts.pop("", 0)
    ratio = {w: (1 + files) / (1 + counts.get(w, 0)) for w in vocabulary}
    from math import log

    return {w: log(r) for w, r in ratio.items()}


def rare_pair(item: Template, idf: dict[str, float]) -> list[int]:
    """Places in the template of the two rarest words of its key phrase."""
    places = range(item.key_at, item.key_at + item.key_len)
    return sorted(places, key=lambda i: (-idf[item.words[i]], i))[:2]


def _starts(item: Template, at: list[int]) -> Column:
    """Starts on which both rare words agree, from the file's occurrences (word, pos)."""

    def of(place: int) -> Column:
        hits = F.filter("rare", lambda x: x["word"] == item.words[place])
        return F.transform(hits, lambda x: x["pos"] - F.lit(place))

    first, *rest = [of(place) for place in at]
    return F.array_intersect(first, rest[0]) if rest else first


def _share(item: Template, start: Column) -> Column:
    same = [
        F.when(F.get("words", start + i) == word, 1).otherwise(0) for i, word in enumerate(item.words)
    ]
    return sum(same[1:], same[0]) / F.lit(float(len(same)))


def _verified(item: Template, at: list[int], in_place: float) -> Column:
    """(start of the key phrase, share of words in place) wherever the template is confirmed."""

    def holds(start: Column) -> Column:
        key_start = start + item.key_at
        return (key_start >= 0) & (F.slice("words", key_start + 1, item.key_len) == _strings(item.key))

    confirmed = F.filter(_starts(item, at), holds)
    scored = F.transform(confirmed, lambda s: F.struct((s + item.key_at).alias("pos"), _share(item, s).alias("share")))
    return F.filter(scored, lambda x: x["share"] >= in_place)


def _labelled(item: Template, places: Column) -> Column:
    label, base = F.lit(item.label).alias("label"), F.lit(item.base).alias("base")
    return F.transform(places, lambda x: F.struct(label, base, x["pos"].alias("pos"), x["share"].alias("share")))


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: tuple[Template, ...] = TEMPLATES,
    in_place: float = IN_PLACE,
) -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts all places of the base phrases, first_word and last_word are the smallest
    and largest start (words from 0, null without one). labels adds those of the further
    templates; both lists are distinct, sorted and comma-joined, empty without a match. score
    is the largest share of a confirmed template's words in place, 0 without one. Null text
    counts as empty; texts of any length are scanned whole; equal rows give equal rows;
    an empty table gives an empty result; other columns are not read.
    """
    words = docs.select(F.col(id_col).alias("id"), words_of(text_col).alias("words"))
    idf = word_idf(words, tuple(sorted({w for t in templates for w in t.words})))
    pairs = {t: rare_pair(t, idf) for t in templates}
    anchors = sorted({t.words[i] for t, at in pairs.items() for i in at})
    leading = sorted({t.words[at[0]] for t, at in pairs.items()})
    occurrences = F.filter(
        F.transform("words", lambda w, i: F.struct(F.when(w.isin(anchors), w).alias("word"), i.alias("pos"))),
        lambda x: x["word"].isNotNull(),
    )
    none = F.array().cast("array<struct<word:string,pos:int>>")
    rare = words.withColumn("rare", F.when(F.arrays_overlap("words", _strings(leading)), occurrences).otherwise(none))
    matches = F.concat(*[_labelled(t, _verified(t, pairs[t], in_place)) for t in templates])
    no_match = F.array().cast("array<struct<label:string,base:boolean,pos:int,share:double>>")
    found = rare.select(
        "id", F.size("words").cast("long").alias("n_words"), F.when(F.size("rare") > 0, matches).otherwise(no_match).alias("found")
    )
    base = F.filter("found", lambda x: x["base"])

    def joined(items: Column) -> Column:
        return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(items, lambda x: x["label"]))))

    return found.select(
        F.col("id").alias(id_col),
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda x: x["pos"])).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda x: x["pos"])).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.lit(0.0)).alias("score"),
    )
