import hashlib
import re

from pyspark.sql import functions as F

from turnlens.llm.exact_dups import digest_rows, exact_duplicates, merge_runs


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for (ident, _), text in zip(rows, norm):
        group = [i for (i, _), t in zip(rows, norm) if t == text]
        keep = min((i for i in group if i is not None), default=None)
        out.append((ident, keep, len(group), hashlib.sha256(text.encode()).hexdigest()))
    return out


def test_agrees_with_brute_force_on_odd_rows(make_docs, odd_rows):
    rows = odd_rows + [(20, "a  b"), (10, "a\tb"), (11, "a\x0bb "), (12, "a b ")]
    got = exact_duplicates(make_docs(rows, extra=True).repartition(7)).collect()
    assert sorted(map(repr, brute(rows))) == sorted(repr((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in got)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_tree_of_many_runs_gives_one_row_per_text(spark, make_docs):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 37).alias("text")).repartition(23)
    rows = digest_rows(docs).cache()
    for fan_in in (2, 8):
        root = merge_runs(rows, fan_in).collect()
        assert len(root) == 37
        assert sorted(r.keep.id for r in root) == list(range(37))
        assert sum(r.group_size for r in root) == 4000


def test_empty_table(make_docs):
    assert exact_duplicates(make_docs([])).collect() == []


def test_no_python_in_the_plan(make_docs):
    plan = exact_duplicates(make_docs([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
