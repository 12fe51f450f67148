import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from turnlens.llm import hashing
from turnlens.llm.alignment import edit_distance, similar
from turnlens.llm.decontaminate import common_words

short = st.lists(st.integers(0, 3), max_size=18)


def table(a, b, edit):
    row = list(range(len(b) + 1)) if edit else [0] * (len(b) + 1)
    for i, x in enumerate(a):
        new = [i + 1 if edit else 0]
        for j, y in enumerate(b):
            if edit:
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            else:
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(short, short, st.integers(0, 12))
def test_edit_distance_within_the_band(a, b, most):
    got = edit_distance(np.array(a, np.int64), np.array(b, np.int64), most)
    want = table(a, b, True)
    assert got == want if want <= most else got > most


@settings(max_examples=200, deadline=None)
@given(short, short)
def test_longest_common_subsequence(a, b):
    assert common_words(np.array(a, np.uint32), np.array(b, np.uint32)) == table(a, b, False)


def test_similar_at_the_threshold():
    a = np.arange(10)
    assert similar(a, np.append(a[:8], [90, 91]), 0.8)
    assert not similar(a, np.append(a[:7], [90, 91, 92]), 0.8)
    assert similar(a[:0], a[:0], 0.8) and not similar(a[:0], a, 0.8)


def test_words_of_latin_texts_need_no_pattern(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(chr(rng.randrange(high)) for _ in range(200)) for high in (128, 256, 0x250, 0x2200) for _ in range(200)]
    texts += ["", "İstanbul ΣΑΣ K", "".join(map(chr, range(256))), "a_b ²x ½ ªº µM ÀÉ×÷ß\x85\xa0\x1c", "\ud800 lone"]
    assert all(hashing.words(t) == re.findall(r"\w+", t.lower()) for t in texts)
    monkeypatch.setattr(hashing, "WORD", None)
    assert hashing.words("Élan, VITAL: 2nd_try!") == ["élan", "vital", "2nd_try"]
