import random

import numpy as np
import pytest

from turnlens.llm import decontaminate
from turnlens.llm.decontaminate import COLUMNS, SLOTS, Items, Retrieval, contaminated, running_sums


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, doc_id string")


def test_finds_copies_and_paraphrases_and_leaves_clean_texts(spark, make_docs, odd_rows, prose):
    items = [(i, prose(15 + i, 500 + i), "x") for i in range(40)] + [(90, None, "x"), (91, "", "x"), (92, "hi", "x")]
    rng = random.Random(2)
    rows, want = list(odd_rows), set()
    for i in range(40):
        words = items[i][1].split()
        if i % 2:
            words = [w if rng.random() > 0.1 else "other" for w in words[:-5]] + words[-5:]
        rows.append((1000 + i, f"{prose(50 + 3 * i, i)} {' '.join(words)} {prose(40, 70 + i)}"))
        want.add((1000 + i, i))
    rows += [(2000 + i, prose(200, 900 + i)) for i in range(60)]
    got = contaminated(make_docs(rows, extra=True).repartition(3), bench(spark, items)).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert found <= want and len(found) >= 0.95 * len(want)
    assert {(1000 + i, i) for i in range(0, 40, 2)} <= found  # verbatim copies
    assert len(got) == len(found) and all(0.6 <= r.common <= 1.0 for r in got)


def test_empty_tables(spark, make_docs):
    assert contaminated(make_docs([]), bench(spark, [(1, "a b c d e f", "x")])).collect() == []
    assert contaminated(make_docs([(1, "a b c d e f")]), bench(spark, [])).collect() == []


def test_axes_are_fitted_on_every_passage():
    # More words than fitted the former bound of 2^20 passages, of which only a share was taken.
    texts = (np.full(1 << 20, i, np.uint32) for i in range(34))
    assert sum(len(columns) for columns in decontaminate._passages(texts, 32)) == 34 << 20


@pytest.mark.parametrize("count", [1, 31, 32, 33, 1000])
def test_running_sums(count):
    rows = np.random.default_rng(count).standard_normal((count, 5)).astype(np.float32)
    want = np.concatenate((np.zeros((1, 5)), np.cumsum(rows.astype(np.float64), axis=0)))
    assert running_sums(rows[::-1], np.arange(count)[::-1]) == pytest.approx(want, abs=1e-4)


def test_enough_counts_words_near_a_window():
    """Against a count by hand, with windows at both ends of the texts."""
    rng, how = np.random.default_rng(2), Retrieval()
    axes = rng.standard_normal((COLUMNS, 4)).astype(np.float32)
    known = Items([(i, " ".join(f"w{x}" for x in rng.integers(0, 40, 12))) for i in range(3)], axes, how)
    own, present = known.classes[0][1], known.classes[0][3]
    text = rng.choice(np.concatenate(known.tokens + [np.arange(60, dtype=np.uint32)]), 300)
    slots, texts = (text % SLOTS).astype(np.int32), [(0, 120), (120, 180)]
    cases = [(w, first, begin, n) for w in range(len(own)) for first, n in texts for begin in (0, 3, 50, n - 12, n - 1)]
    which, firsts, begins, lengths = (np.array(c, np.int64) for c in zip(*cases))
    got = known.enough(own[which], present, which, slots, firsts, begins, lengths, at_once=64)
    for (w, first, begin, n), found in zip(cases, got):
        size = len(known.tokens[own[w]])
        near = slots[first + max(0, begin - size // 2) : min(first + n, first + begin + size + size // 2)]
        assert found == (sum(bool(present[w, x]) for x in near) >= how.paraphrased * size)
