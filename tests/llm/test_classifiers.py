import random

from pyspark.sql import functions as F

from turnlens.llm.quality import in_fold, score_quality
from turnlens.llm.toxicity import score_toxicity


def corpus(prose, bad):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(240):
        text, label = prose(40 + i % 50, i), i % 4 == 0
        rows.append((i, bad(text, rng) if label else text))
        labels.append((i, int(not label), int(label)))
    return rows, labels


def held_out_errors(scored, labels, column, label):
    truth = {x[0]: x[label] for x in labels}
    rows = scored.filter(in_fold("doc_id", 5, 0) & (F.col("doc_id") < 240)).collect()
    assert len(rows) > 20
    return sum((r[column] >= 0.3) != truth[r.doc_id] for r in rows) / len(rows)


def test_quality_on_held_out_texts(make_docs, make_labels, odd_rows, prose):
    rows, labels = corpus(prose, lambda t, rng: " ".join(w + rng.choice(["%%%", "$$$", "###"]) for w in t.split()))
    odd = [(None if i is None else 1000 + i, t) for i, t in odd_rows]
    marks = make_labels(labels + [(None, 1, 1), (1002, None, None), (1003, 7, 7), (0, 1, 0), (9999, 1, 0)])
    scored = score_quality(make_docs(rows + odd, extra=True), marks, ~in_fold("doc_id", 5, 0))
    assert scored.count() == len(rows) + len(odd)
    assert held_out_errors(scored, labels, "quality_score", 1) <= 0.05
    got = {r.doc_id: r.quality_score for r in scored.collect()}
    assert all(0.0 <= s <= 1.0 for s in got.values()) and got[1002] == got[1003] and got[1001] == got[1007]
    assert {"row", "label", "key"} <= set(scored.columns)


def test_toxicity_on_held_out_texts(make_docs, make_labels, odd_rows, prose):
    insults = ["idiot", "moron", "scum", "trash"]

    def worse(text, rng):
        words = text.split()
        for _ in range(4):
            words.insert(rng.randrange(len(words)), rng.choice(insults))
        return " ".join(words)

    rows, labels = corpus(prose, worse)
    odd = [(None if i is None else 1000 + i, t) for i, t in odd_rows]
    scored = score_toxicity(make_docs(rows + odd, extra=True), make_labels(labels), ~in_fold("doc_id", 5, 0))
    assert held_out_errors(scored, labels, "toxicity_score", 2) <= 0.05
    got = {r.doc_id: r.toxicity_score for r in scored.collect()}
    assert all(0.0 <= s <= 1.0 for s in got.values()) and got[1002] == got[1003] and got[1001] == got[1007]


def test_without_labels_and_without_texts(make_docs, make_labels):
    for score, column in ((score_quality, "quality_score"), (score_toxicity, "toxicity_score")):
        scored = score(make_docs([(1, "some text"), (2, None)]), make_labels([]), F.lit(True))
        assert [r[column] for r in scored.collect()] == [0.5, 0.5]
        assert score(make_docs([]), make_labels([(1, 1, 0)]), F.lit(True)).collect() == []
