import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from turnlens.llm.fill_in_middle import ByteIndex, Infill, fill_in_middle, restored, transformed

TEXTS = st.text(st.characters(codec="utf-8"), max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_index_agrees_with_decoding(text):
    index = ByteIndex(np.frombuffer(text.encode(), np.uint8))
    assert index.chars == len(text)
    cuts = np.arange(len(text) + 1)
    places = [len(text[:i].encode()) for i in cuts]
    assert index.to_bytes(cuts).tolist() == places
    assert index.to_chars(np.array(places)).tolist() == cuts.tolist()


def test_ascii_has_no_exceptions():
    assert len(ByteIndex(np.frombuffer(b"plain text\n" * 1000, np.uint8)).at) == 0


def by_hand(ident, text, unit="line", rate=100, spm=50):
    """The contract, on Python strings."""
    text = text or ""
    digest = hashlib.sha256(f"7:{'' if ident is None else ident}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


CASES = [
    (11, "a\n\nb\nc"), (12, "no line end"), (13, "\n"), (14, "\n\n\n"), (15, "héllo\nwörld\n𝔘nicode\n日本\n"), (16, "has <P> in it\nx"),
    (17, "has <M> in it"), (18, "<S>"), (19, "< P>\n<P\n>S>\n<"), (20, "a<\nS>b\nM>"), (21, "\r\nwin\r\n\x0b\x85 x"), (-5, "neg\native\n"),
    (22, "".join(f"line {i} é\n" for i in range(500))), (22, "".join(f"line {i} é\n" for i in range(500))),
]


@pytest.mark.parametrize("how", [Infill(), Infill(unit="char"), Infill(rate=40, spm_rate=10)], ids=str)
def test_against_contract(make_docs, odd_rows, how):
    rows = odd_rows + CASES
    cut = fill_in_middle(make_docs(rows, extra=True), how=how)
    got = cut.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows)
    want = sorted(repr((i, *by_hand(i, t, how.unit, how.rate, how.spm_rate), t or "")) for i, t in rows)
    assert sorted(repr((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back)) for r in got) == want
    assert {r.run for r in got} == {"x"}  # other columns pass


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("<>PSM\nab é日𝔘"), max_size=30), st.integers(0, 10**9))
def test_any_text_comes_back(text, ident):
    digest = hashlib.sha256(f"7:{ident}".encode()).hexdigest()
    draws = tuple(int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    for unit in ("line", "char"):
        n, form, prefix, middle, output = transformed(text.encode(), draws, Infill(unit=unit))
        want = by_hand(ident, text, unit)
        assert (n, form, prefix, middle, output.decode()) == want


def test_output_names_are_replaced_and_empty_tables_stay_empty(spark, make_docs):
    docs = make_docs([(1, "a\nb")]).withColumn("n", F.lit("old")).withColumn("form", F.lit("old"))
    row = fill_in_middle(docs).first()
    assert row.n == 2 and row.form != "old"
    assert fill_in_middle(make_docs([])).count() == 0
