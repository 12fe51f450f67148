import random

import numpy as np
import pytest

from turnlens.llm.alignment import edit_distance
from turnlens.llm.near_dups import OrderMinHash, bag, bags_fit, near_duplicates, order_keys


def edited(text, share, seed):
    rng = random.Random(seed)
    return " ".join(f"changed{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())


def test_copies_are_one_class_and_others_stay_apart(make_docs, odd_rows, prose):
    rows = list(odd_rows)
    for g in range(12):
        base = prose(120 + 20 * g, 100 + g)
        rows += [(1000 + 10 * g + c, edited(base, 0.0 if c == 0 else 0.04, 10 * g + c)) for c in range(5)]
        rows.append((1000 + 10 * g + 5, base.upper().replace(" ", ",  ")))
    passage = prose(60, 7)
    rows += [(3000 + i, f"{prose(60, 300 + i)} {passage} {prose(60, 400 + i)}") for i in range(25)]
    got = near_duplicates(make_docs(rows, extra=True).repartition(5)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for g in range(12):
        group = [by_id[1000 + 10 * g + c] for c in range(6)]
        assert {(r.class_id, r.class_size) for r in group} == {(1000 + 10 * g, 6)}
        assert [r.kept for r in group] == [True] + [False] * 5
    assert all(by_id[3000 + i].class_size == 1 for i in range(25))
    # Odd rows: equal words are one class; texts without words only with identical ones.
    assert by_id[7].class_id == 1 and by_id[6].class_id == 5 and by_id[2].class_id == by_id[3].class_id == 2
    assert by_id[4].class_size == by_id[9].class_size == by_id[None].class_size == 1
    assert sorted(r.kept for r in got if r.doc_id == 8) == [False, True]
    assert sum(r.kept for r in got) == len({(r.class_id, r.class_size) for r in got})


@pytest.mark.parametrize("length", [50, 100, 200, 1000])
@pytest.mark.parametrize("similarity", [0.8, 0.82, 0.85])
def test_texts_near_the_threshold_share_a_key(length, similarity):
    rng, found = np.random.default_rng(length), 0
    for _ in range(100):
        text = rng.integers(0, 1 << 40, length)
        other = text.copy()
        at = rng.choice(length, int((1 - similarity) * length + 1e-9), replace=False)
        other[at] = rng.integers(0, 1 << 40, len(at))
        found += len(np.intersect1d(order_keys(text, OrderMinHash()), order_keys(other, OrderMinHash()))) > 0
    assert found >= 99


@pytest.mark.parametrize("length", [1250, 1400, 1500, 1600, 3000])
@pytest.mark.parametrize("similarity", [0.8, 0.85])
def test_long_texts_near_the_threshold_share_a_key(length, similarity):
    rng, found = np.random.default_rng(length), 0
    for _ in range(60):
        text = rng.integers(0, 1 << 40, length)
        other = np.delete(text, rng.choice(length, int((1 - similarity) * length + 1e-9), replace=False))
        found += len(np.intersect1d(order_keys(text, OrderMinHash()), order_keys(other, OrderMinHash()))) > 0
    assert found == 60


def test_long_texts_seldom_share_a_key_for_one_passage():
    rng, found = np.random.default_rng(2), 0
    passage = rng.integers(0, 1 << 40, 60)
    keys = [order_keys(np.concatenate((rng.integers(0, 1 << 40, 1500), passage, rng.integers(0, 1 << 40, 1500))), OrderMinHash()) for _ in range(40)]
    found = sum(len(np.intersect1d(x, y)) > 0 for i, x in enumerate(keys) for y in keys[:i])
    assert found < 0.05 * 780


def test_bags_rule_out_no_pair_of_few_edits():
    rng = np.random.default_rng(3)
    for _ in range(200):
        text = rng.integers(0, rng.choice([3, 400, 1 << 32]), rng.integers(1, 900)).astype(np.uint32)
        places = np.sort(rng.choice(len(text), rng.integers(0, len(text) // 4 + 1), replace=False))
        other = np.delete(text, places[::2])
        other = np.insert(other, rng.integers(0, len(other) + 1, len(places[1::2])), 7).astype(np.uint32)
        distance = edit_distance(text, other, len(text) + len(other))
        assert bags_fit([bag(text.tobytes())], [bag(other.tobytes())], np.array([distance])).all()
    unlike = [bag(rng.integers(0, 1 << 32, 200).astype(np.uint32).tobytes()) for _ in range(2)]
    assert not bags_fit(unlike[:1], unlike[1:], np.array([40])).any()


def test_empty_table(make_docs):
    assert near_duplicates(make_docs([])).collect() == []


@pytest.mark.parametrize("length", [20, 50, 100, 200, 400, 1000])
def test_texts_with_every_fifth_word_changed_share_a_key(length):
    rng, found = np.random.default_rng(length), 0
    for _ in range(100):
        text = rng.integers(0, 1 << 40, length)
        other = text.copy()
        other[2::5] = rng.integers(0, 1 << 40, len(other[2::5]))
        found += len(np.intersect1d(order_keys(text, OrderMinHash()), order_keys(other, OrderMinHash()))) > 0
    assert found >= 97


@pytest.mark.parametrize("length", [100, 250, 600])
def test_texts_seldom_share_a_key_for_one_passage(length):
    rng = np.random.default_rng(4)
    passage = rng.integers(0, 1 << 40, 10)
    keys = [order_keys(np.concatenate((rng.integers(0, 1 << 40, length), passage, rng.integers(0, 1 << 40, 20))), OrderMinHash()) for _ in range(60)]
    found = sum(len(np.intersect1d(x, y)) > 0 for i, x in enumerate(keys) for y in keys[:i])
    assert found < 0.05 * 1770
