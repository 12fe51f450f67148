import re

from turnlens.llm.licenses import BASE, TEMPLATES, scan_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    base, labels = [], set()
    for t in TEMPLATES:
        for s in range(len(words)):
            if tuple(words[s : s + t.key_len]) == t.key:
                start = s - t.key_at
                same = sum(0 <= start + i < len(words) and words[start + i] == w for i, w in enumerate(t.words))
                if same / len(t.words) >= 0.8:
                    labels.add(t.label)
                    if t in BASE:
                        base.append((s, t.label))
    places = [s for s, _ in base]
    return (len(words), len(base), min(places, default=None), max(places, default=None),
            ",".join(sorted({b for _, b in base})), ",".join(sorted(labels)))


TEXTS = [
    "Licensed under the Apache License, Version 2.0.", "mit license MIT License cc by Cc-By", "GNU general public-license",
    "gnu gnu general public license license", "ﬀ MİT License KIT mité license", "cc", "by cc", "the mit",
    "Permission is hereby granted, free of charge, to any person obtaining copies of this software",
    "x " * 5000 + "apache license " + "y " * 5000 + "cc by",
]


def test_agrees_with_brute_force(make_docs, odd_rows):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(TEXTS)]
    got = scan_licenses(make_docs(rows, extra=True)).collect()
    have = sorted(repr((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels)) for r in got)
    assert have == sorted(repr((i, *brute(t))) for i, t in rows)
    assert all(0.0 <= r.score <= 1.0 and (r.score > 0) == (r.labels != "") for r in got)


def test_empty_table(make_docs):
    assert scan_licenses(make_docs([])).collect() == []


def test_no_python_in_the_plan(make_docs):
    plan = scan_licenses(make_docs([(1, "mit license")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
