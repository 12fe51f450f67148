import random

import numpy as np
import pytest

from turnlens.llm.alignment import similar
from turnlens.llm.common import Scratch
from turnlens.llm.hashing import WordHashes, characters, cut, parities, word_hash, words
from turnlens.llm.line_dups import PLACES, LineRule, Tokens, dedup_lines, gram_size, grams, keys_of


def with_edits(line, edits, rng):
    named = line.split()
    for place in sorted(rng.sample(range(len(named)), edits), reverse=True):
        new = f"new{rng.randrange(10**6)}"
        named[place : place + 1] = rng.choice([[new], [new], [], [named[place], new]])
    return " ".join(named)


@pytest.mark.parametrize("similarity", [0.8, 0.9])
def test_every_pair_of_similar_lines_shares_a_key(prose, similarity):
    rng, hashes, pairs = random.Random(4), Tokens(), []
    for length in [*range(5, 41), 60, 79, 100, 101, 150, 199, 200]:
        for _ in range(20):
            line = prose(length, rng.randrange(10**6))
            most = int((1 - similarity) * length + 1e-9)
            edited = [with_edits(line, rng.randint(0, most), rng)]
            step = -(-length // max(1, most))  # evenly changed words touch the most grams
            edited.append(" ".join(f"x{i}" if i % step == step // 2 else w for i, w in enumerate(line.split())))
            pairs += [(line, e) for e in edited if len(words(e)) >= 5]
    tokens = [[hashes.of(words(x)) for x in pair] for pair in pairs]
    alike = [x for x in tokens if similar(*x, similarity)]
    assert len(alike) > 1000
    flat = [x for pair in alike for x in pair]
    sizes = [np.array([len(w) for w in words(x)]) for pair, t in zip(pairs, tokens) if similar(*t, similarity) for x in pair]
    keys = keys_of(flat, sizes, LineRule(similarity=similarity))
    assert all(set(a.tolist()) & set(b.tolist()) for a, b in zip(keys[::2], keys[1::2]))


def test_sketches_rule_out_no_similar_lines(prose):
    rng, hashes = random.Random(9), Tokens()
    for length in [*range(5, 60, 3), 100, 199]:
        for edits in range(0, length // 5 + 1):
            line = prose(length, rng.randrange(10**6))
            both = [hashes.of(words(x)) for x in (line, with_edits(line, edits, rng))]
            one, other = parities(np.concatenate(both), np.array([len(x) for x in both]), 3)
            assert sum(((a ^ b) & ((1 << 64) - 1)).bit_count() for a, b in zip(one.tolist(), other.tolist())) <= 2 * edits


def test_the_bound_on_sketches_counts_added_words_once(spark):
    from pyspark.sql import functions as F

    from turnlens.llm.linking import may_be_similar

    # 100 and 80 words: 20 added ones are all the edits there may be, so no more than 20 bits differ.
    rows = spark.createDataFrame([(80, 100, (1 << 20) - 1, 0), (80, 100, (1 << 21) - 1, 0), (100, 100, (1 << 40) - 1, 0)], "n int, rep_n int, s0 long, rep_s0 long")
    assert [r[0] for r in rows.select(may_be_similar(0.8, 1)).collect()] == [True, False, True]


def test_short_lines_and_long_passages_with_a_fifth_changed(make_docs, prose):
    rng, rows = random.Random(6), []
    for number, length in enumerate((5, 6, 10, 15, 20, 60, 100, 200)):
        line = prose(length, 900 + number)
        rows += [(10 * number, line)] + [(10 * number + i, with_edits(line, length // 5, rng)) for i in (1, 2, 3)]
    tokens = {i: WordHashes().of(words(t)) for i, t in rows}
    gone = {r.doc_id for r in dedup_lines(make_docs(rows)).collect() if r.lines_removed}
    want = {i for i, t in rows if i % 10 and len(words(t)) >= 5 and similar(tokens[i - i % 10], tokens[i], 0.8)}
    assert gone >= want and len(want) > 20 and not any(i % 10 == 0 for i in gone)


def test_keeps_one_occurrence_of_each_group(make_docs, odd_rows, prose):
    line = prose(40, 1)
    near = " ".join(["other", *line.split()[1:20], "word", *line.split()[21:]])
    single = [prose(30, 50 + i) for i in range(20)]
    rows = odd_rows + [(100, f"{single[0]}\n{line}\nshort line\n\n{single[1]}"), (101, f"{near}\n{single[2]}\nshort line\n"),
                       (102, f"{line.upper()}!!\n{single[3]}\n{single[3]}"), (103, line), (104, "\n".join(single[4:]))]
    got = dedup_lines(make_docs(rows, extra=True).repartition(4)).collect()
    assert len(got) == len(rows)
    text = {r.doc_id: r.text for r in got}
    assert text[100] == dict(rows)[100] and text[104] == dict(rows)[104]
    assert text[101] == f"{single[2]}\nshort line\n" and text[102] == single[3] and text[103] == ""
    assert text[2] is None and text[3] == "" and text[4] == " \t\n " and text[9] == "!!! ---" and text[5] and text[6] == ""
    assert text[1] == dict(rows)[1] and text[7] == "" and text[None] == dict(rows)[None]
    assert sorted(r.text for r in got if r.doc_id == 8) == ["", "twice the same row is given"]
    assert {r.doc_id: r.lines_removed for r in got if r.doc_id in (100, 101, 102, 103)} == {100: 0, 101: 1, 102: 2, 103: 1}
    assert all(r.row == "x" and r.key == "x" for r in got)


def test_passages_of_many_words_in_two_documents(make_docs, prose):
    passage = prose(60, 3)
    rows = [(i, f"{prose(50, 10 + i)}\n{passage}\n{prose(50, 30 + i)}") for i in range(6)]
    got = {r.doc_id: r.text for r in dedup_lines(make_docs(rows)).collect()}
    assert [passage in got[i] for i in range(6)] == [True] + [False] * 5
    assert all(prose(50, 10 + i) in got[i] and prose(50, 30 + i) in got[i] for i in range(6))


def test_empty_table(make_docs):
    assert dedup_lines(make_docs([])).collect() == []


def test_words_cut_at_once_are_those_of_the_pattern(prose):
    rng = random.Random(12)
    texts = ["".join(chr(rng.choice([10, 32, rng.randrange(high)])) for _ in range(300)) for high in (128, 256, 0x250, 0x2200) for _ in range(60)]
    texts += ["", "\n", "a\n\nb", "İstanbul ΣΑΣ\nΣ K", "\ud800 lone", "x" * (1 << 21), prose(300_000, 1)]
    for text in texts:
        hashed, sizes, line = cut(characters(text))
        want = [(word_hash(w), len(w), i) for i, content in enumerate(text.split("\n")) for w in words(content)]
        assert list(zip(hashed.tolist(), sizes.tolist(), line.tolist())) == want


def test_lines_of_a_popular_passage_do_not_meet_for_it(prose):
    rng = random.Random(13)
    passage = " ".join("".join(rng.choice("aeioulmnrst") for _ in range(12)) for _ in range(8))  # long words come first
    lines = [words(f"{prose(15, 2 * i)} {passage} {prose(15, 2 * i + 1)}") for i in range(300)]
    tokens, sizes = [Tokens().of(x).astype(np.uint32) for x in lines], [np.array([len(w) for w in x]) for x in lines]
    size = gram_size(LineRule())
    all_of = [grams(t, s, np.array([len(t)]), size)[1] for t, s in zip(tokens, sizes)]
    gram, n = np.unique(np.concatenate(all_of), return_counts=True)
    common = np.zeros(PLACES, np.uint8)
    common[(gram & np.uint64(PLACES - 1)).astype(np.int64)] = np.log2(n)
    met = lambda keys: sum(n * (n - 1) // 2 for n in np.unique(np.concatenate(keys), return_counts=True)[1])
    assert met(keys_of(tokens, sizes, LineRule())) > 300_000
    assert met(keys_of(tokens, sizes, LineRule(), common)) < 1000


def test_similar_lines_share_a_key_in_any_order_of_grams(prose):
    rng, common = random.Random(14), np.random.default_rng(14).integers(0, 31, PLACES).astype(np.uint8)
    for length in [*range(5, 41), 60, 101]:
        line = prose(length, rng.randrange(10**6))
        pair = [words(x) for x in (line, with_edits(line, int(0.2 * length + 1e-9), rng))]
        tokens, sizes = [Tokens().of(x) for x in pair], [np.array([len(w) for w in x]) for x in pair]
        if min(map(len, pair)) >= 5 and similar(*tokens, 0.8):
            one, other = keys_of(tokens, sizes, LineRule(), common)
            assert set(one.tolist()) & set(other.tolist())


def test_files_are_read_in_place(spark, make_docs, odd_rows, prose, tmp_path, monkeypatch):
    line = prose(40, 1)
    rows = odd_rows + [(20 + i, f"{line}\n{prose(20, 70 + i)}") for i in range(6)] + [(20, f"{line}\n{prose(20, 70)}")]
    make_docs(rows).repartition(3).write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    want = sorted(map(str, dedup_lines(docs.filter("true or rand() < 2")).collect()))
    pinned, pin = [], Scratch.pin
    monkeypatch.setattr(Scratch, "pin", lambda self, df, name: pinned.append(name) or pin(self, df, name))
    assert sorted(r.text or "" for r in dedup_lines(docs.select("doc_id", "text")).collect()) == sorted(r.text or "" for r in dedup_lines(docs).collect())
    got = dedup_lines(docs)
    assert sorted(map(str, got.collect())) == want and "texts" not in pinned and "found" in pinned
    assert sum(r.lines_removed for r in got.collect()) >= 7
