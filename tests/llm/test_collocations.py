import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from turnlens.llm.collocations import BREAK, OVERLAP, Mining, WordsAndBreaks, chunk_bounds, collocations, words_and_breaks
from turnlens.llm.hashing import WordHashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces_of(text):
    for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
        if words := re.findall(r"[^ \t]+", piece):
            yield words


def brute_force(rows, least=10, keep=2000):
    """The contract with counters and Python's integers."""
    f = {}
    for lang, text in rows:
        counts = f.setdefault(lang or "und", Counter())
        for words in pieces_of(text):
            for size in (1, 2, 3):
                counts.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        n = sum(c for p, c in counts.items() if len(p) == 1)
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in found.items():
            if any(len(q) > len(p) and p in (q[:2], q[1:]) and 100 * b >= 50 * a for q, b in found.items()):
                continue
            cuts = [(1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:keep], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.fixture(scope="module")
def corpus():
    """Skewed words, shared passages, odd separators, words in other scripts."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "日本", "a-b", "x y", "Ünder", "AND"]
    passage = " ".join(rng.choice(vocabulary) for _ in range(80)) + ". again, and again; and AGAIN and again"
    rows = []
    for i in range(150):
        words = [vocabulary[min(int(rng.expovariate(0.1)), 65)] for _ in range(rng.randint(0, 60))]
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "!?"]) for w in words)
        rows.append((rng.choice(["en", "de", None, "und"]), text + (passage if i % 3 == 0 else "")))
    return rows + [("en", None), ("en", ""), ("xx", "   ...  "), ("yy", "only once here"), ("en", "the the " * 3000)]


@pytest.mark.parametrize("every", [1, 2, 12, 10**6])
def test_against_counters(spark, corpus, every):
    docs = spark.createDataFrame(corpus, "lang string, text string")
    got = result(collocations(docs, how=Mining(every=every, keep=40)))
    assert got == brute_force(corpus, keep=40) and len(got) > 60


def test_small_bounds_change_nothing(spark, corpus):
    docs = spark.createDataFrame(corpus, "lang string, text string")
    how = Mining(every=3, least=4, shares=2, keep=15)
    assert result(collocations(docs, how=how)) == brute_force(corpus, 4, 15)


def test_products_beyond_64_bits(spark):
    from turnlens.llm.collocations import scored

    big = 3_000_000_007
    counts = [("en", "a", big), ("en", "b", big + 2), ("en", "a b", big - 5)]
    row = scored(spark.createDataFrame(counts, "lang string, phrase string, f long"), Mining()).first()
    assert row.score == 1000000 * (big - 5) ** 2 // (big * (big + 2))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcde|"), max_size=40), st.integers(1, 5))
def test_every_run_of_words_is_in_one_chunk(words, every):
    words = ["\n" if w == "|" else w for w in words]
    hashes = WordHashes().of(words)
    breaks = np.array([w == "\n" for w in words], bool)
    want, got = Counter(), Counter()
    for piece in " ".join(words).split("\n"):
        p = piece.split()
        want.update(tuple(p[i : i + s]) for s in (1, 2, 3) for i in range(len(p) - s + 1))
    for a, b, last in zip(*(x.tolist() for x in chunk_bounds(hashes, breaks, every))):
        p = words[a:b]
        assert "\n" not in p
        own = len(p) if last else len(p) - OVERLAP
        got.update(tuple(p[i : i + s]) for s in (1, 2, 3) for i in range(own) if i + s <= len(p))
    assert got == want


def test_equal_passages_share_chunks():
    rng = random.Random(1)
    passage = [f"w{rng.randint(0, 500)}" for _ in range(400)]
    chunks = []
    for before in (["x"] * 7, ["y", "z"] * 11):
        words = before + passage
        starts, ends, _ = chunk_bounds(WordHashes().of(words), np.zeros(len(words), bool), 8)
        chunks.append({tuple(words[a:b]) for a, b in zip(starts, ends)})
    assert len(chunks[0] & chunks[1]) >= 0.9 * len(chunks[0])


def test_words_end_at_spaces_and_tabs_only():
    assert words_and_breaks("A B\tc\x1cd.e".encode()) == ["a b", "c\x1cd", "\n", "e"]


def test_odd_rows(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows, extra=True).withColumnRenamed("label", "lang").withColumnRenamed("words", "phrase")
    assert result(collocations(docs)) == brute_force([("x", t) for _, t in odd_rows])
    assert collocations(docs.limit(0)).count() == 0


def test_words_and_breaks_by_a_table_are_those_of_the_pattern():
    text = "".join(map(chr, range(0x250))) + " A.B,;c\t\tD E  f\n\nİg\r\n\x0b\x0c!? \U0001f600X"
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    pieces = [[w for w in re.split("[ \t]+", piece) if w] for piece in re.split("[.,;:!?\n-\r]", lowered)]
    named = words_and_breaks(text.encode())
    got = [[]]
    for word, hashed in zip(named, WordsAndBreaks(10).of(named).tolist()):
        assert (hashed == -1) == (word == BREAK) and hashed >= -1
        if hashed == -1:
            got.append([])
        else:
            got[-1].append(word)
    assert [p for p in got if p] == [p for p in pieces if p]
