import corpus_pipeline
import numpy as np
import pytest

from turnlens.llm.hashing import WordHashes, words
from turnlens.llm.alignment import similar

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Name, input and output rows of every stage."""
    from turnlens.sources.tables import pin

    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = pin(stage(spark, docs, SF), name)
        out[name] = (docs, made)
        docs = made
    return out


def test_columns(stages):
    for name, (before, after) in stages.items():
        assert after.columns == before.columns or name == "pack"


def test_quality_rejects_junk_only(spark, stages):
    before, after = stages["quality"]
    kept = {r.doc_id for r in after.select("doc_id").collect()}
    labels = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    known = {r.doc_id for r in before.select("doc_id").collect()}
    wrong = [r.doc_id for r in labels if r.doc_id in known and (r.doc_id in kept) != bool(r.quality)]
    assert len(wrong) <= 0.05 * len(labels)


def test_lines_keep_every_document(stages):
    before, after = stages["line_dedup"]
    assert sorted(r.doc_id for r in before.collect()) == sorted(r.doc_id for r in after.collect())


def test_near_dedup_against_all_pairs(stages):
    before, after = stages["near_dedup"]
    hashes = WordHashes()
    texts = {r.doc_id: hashes.of(words(r.text or "")) for r in before.collect()}
    kept = sorted(r.doc_id for r in after.collect())
    for i in set(texts) - set(kept):  # what goes is like something, and has its class in what stays
        assert any(similar(texts[i], texts[j], 0.8) for j in texts if j != i)
    alive = [i for i in kept if len(texts[i])]
    assert not [(i, j) for i in alive for j in alive if i < j and abs(len(texts[i]) - len(texts[j])) <= 0.2 * len(texts[j])
                and np.isin(texts[i], texts[j]).mean() > 0.7 and similar(texts[i], texts[j], 0.8)]


def test_decontamination_against_search(spark, stages):
    before, after = stages["decontaminate"]
    items = [" ".join(words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    has = {r.doc_id for r in before.collect() if any(f" {x} " in f" {' '.join(words(r.text or ''))} " for x in items)}
    kept = {r.doc_id for r in after.collect()}
    assert not has & kept
    assert len({r.doc_id for r in before.collect()} - kept - has) <= 1


def test_every_kept_document_is_packed(stages):
    before, after = stages["pack"]
    assert {r.doc_id for r in before.collect()} == {r.doc_id for r in after.select("doc_id").distinct().collect()}


@pytest.fixture
def odd_documents(spark, prose):
    """Null, shared and repeated ids; near copies, benchmark passages and unique texts among them."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    base = prose(150, 901)
    near = " ".join(["changed", *base.split()[1:]])
    rows = [
        (1, base), (2, near), (2, prose(120, 902)), (3, prose(130, 903)), (3, prose(130, 903)), (None, prose(140, 904)), (None, prose(140, 904)),
        (None, f"{prose(60, 905)} {item} {prose(60, 906)}"), (4, f"{prose(60, 907)} {item}"), (4, prose(110, 908)), (5, None), (6, ""), (7, prose(9000, 909)),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, pipeline string"
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "r", "p") for i, t in rows], schema).repartition(3)


def texts_of(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in df.collect())


def test_near_dedup_decides_by_row(spark, odd_documents):
    before = odd_documents.collect()
    kept = corpus_pipeline.near_dedup(spark, odd_documents, SF)
    assert kept.columns == odd_documents.columns
    tokens = [WordHashes().of(words(r.text or "")) for r in before]
    order = sorted(range(len(before)), key=lambda i: (before[i].doc_id is None, before[i].doc_id or 0))
    want, seen = [], []
    for i in order:  # by brute force: the first row by id of everything that is alike
        if not any(similar(tokens[i], tokens[j], 0.8) and (len(tokens[i]) > 0 or (before[i].text or "") == (before[j].text or "")) for j in seen):
            want.append((before[i].doc_id is None, before[i].doc_id or 0, before[i].text or ""))
        seen.append(i)
    assert texts_of(kept) == sorted(want)


def test_decontamination_decides_by_row(spark, odd_documents):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    kept = corpus_pipeline.decontaminate(spark, odd_documents, SF)
    want = [(r.doc_id is None, r.doc_id or 0, r.text or "") for r in odd_documents.collect() if item not in (r.text or "")]
    assert texts_of(kept) == sorted(want) and kept.columns == odd_documents.columns


def test_other_stages_take_odd_rows(spark, odd_documents):
    for stage in (corpus_pipeline.quality, corpus_pipeline.line_dedup):
        kept = stage(spark, odd_documents, SF)
        assert kept.columns == odd_documents.columns and kept.count() <= odd_documents.count()
    assert corpus_pipeline.line_dedup(spark, odd_documents, SF).count() == odd_documents.count()
    pieces = corpus_pipeline.packed(spark, odd_documents, SF)
    assert pieces.agg({"length": "sum"}).first()[0] > 0
    empty = odd_documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
