"""The operators as registered queries, with DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnlens.llm.collocations import collocations
from turnlens.llm.common import table
from turnlens.llm.decontaminate import contaminated
from turnlens.llm.exact_dups import exact_duplicates
from turnlens.llm.fill_in_middle import fill_in_middle, restored
from turnlens.llm.html import extract_main_text
from turnlens.llm.licenses import IN_PLACE, TEMPLATES, WORD, scan_licenses
from turnlens.llm.line_dups import dedup_lines
from turnlens.llm.near_dups import near_duplicates
from turnlens.llm.packing import pack
from turnlens.llm.pii import replace_entities
from turnlens.llm.quality import Voting, in_fold, score_quality
from turnlens.llm.secrets import KINDS, scan_secrets, span_text
from turnlens.llm.toxicity import Ftrl, score_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def _license_sql() -> str:
    def words(values) -> str:
        return "[" + ", ".join(f"'{w}'" for w in values) + "]"

    found = []
    for t in TEMPLATES:
        key_places = f"list_filter(range(0, len(words) - {t.key_len - 1}), lambda s: words[s + 1 : s + {t.key_len}] = {words(t.key)})"
        same = " + ".join(f"(CASE WHEN words[s - {t.key_at - i - 1}] = '{w}' AND s - {t.key_at - i} >= 0 THEN 1 ELSE 0 END)" for i, w in enumerate(t.words))
        share = f"({same}) / {len(t.words)}.0::DOUBLE"
        found.append(
            f"list_filter(list_transform({key_places}, lambda s: {{'label': '{t.label}', 'base': {str(t.base).lower()}, "
            f"'pos': s, 'share': CAST({share} AS DOUBLE)}}), lambda x: x.share >= {IN_PLACE})"
        )
    matches = found[0]
    for more in found[1:]:
        matches = f"list_concat({matches}, {more})"
    return f"""
WITH w AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS words FROM documents),
m AS MATERIALIZED (SELECT doc_id, len(words) AS n_words, {matches} AS found FROM w),
b AS (SELECT *, list_filter(found, lambda x: x.base) AS base FROM m)
SELECT doc_id, n_words, CAST(len(base) AS BIGINT) AS n_base,
    CAST(list_min(list_transform(base, lambda x: x.pos)) AS BIGINT) AS first_word,
    CAST(list_max(list_transform(base, lambda x: x.pos)) AS BIGINT) AS last_word,
    array_to_string(list_sort(list_distinct(list_transform(base, lambda x: x.label))), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list_transform(found, lambda x: x.label))), ',') AS labels,
    coalesce(list_max(list_transform(found, lambda x: x.share)), 0.0) AS score
FROM b"""


ORACLES["op3_license_scan"] = _license_sql()


@query
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op9_exact_dedup"] = r"""
WITH n AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
    doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)"""


@query
def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def predicted(score: str, threshold: float):
    return (F.col(score) >= threshold).cast("int").alias("predicted")


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = in_fold("doc_id", 5, 0)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, table(spark, sf_dir, "labels"), ~held_out)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("quality_score").alias("score"),
        predicted("quality_score", Voting().threshold),
    )


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = in_fold("doc_id", 4, 2)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"), ~held_out)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("toxicity_score").alias("score"),
        predicted("toxicity_score", Ftrl().threshold),
    )


@query
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("row")


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLES["op11_fill_in_middle"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
l AS (
    SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS lines,
        ('0x' || substr(h, 1, 8))::UBIGINT AS h1, ('0x' || substr(h, 9, 8))::UBIGINT AS h2,
        ('0x' || substr(h, 17, 8))::UBIGINT AS h3, ('0x' || substr(h, 25, 8))::UBIGINT AS h4 FROM d),
c AS (
    SELECT *, len(lines) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1))::BIGINT AS a,
        greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1))::BIGINT AS b FROM l),
p AS (
    SELECT *, array_to_string(lines[1:a], '') AS prefix, array_to_string(lines[a + 1:b], '') AS middle,
        array_to_string(lines[b + 1:n], '') AS suffix,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
            WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM p"""


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLES["op12_collocations"] = r"""
WITH p AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
g AS (
    SELECT lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) AS phrase
    FROM w, (SELECT unnest([1, 2, 3]) AS k)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cuts AS (
    SELECT lang, phrase, k, f AS a, unnest(range(1, k)) AS cut, string_split(phrase, ' ') AS words FROM f WHERE k > 1 AND f >= 10),
parts AS (
    SELECT c.*, x.f AS l, y.f AS r, 1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f) AS score FROM cuts c
    JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(words[1:cut], ' ') AND x.k = cut
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(words[cut + 1:], ' ') AND y.k = c.k - cut),
best AS (
    SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_of AS (
    SELECT lang, array_to_string(words[i:i + 1], ' ') AS phrase, max(a) AS longer
    FROM best, (SELECT unnest([1, 2]) AS i) WHERE k = 3 GROUP BY 1, 2),
kept AS (
    SELECT b.* FROM best b LEFT JOIN inner_of i ON i.lang = b.lang AND i.phrase = b.phrase AND b.k = 2
    WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a)
SELECT kept.lang, row_number() OVER w AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN total USING (lang)
WINDOW w AS (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase)
QUALIFY rank <= 2000"""


@query
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda x: x["layers"] == "")

    def count(kind: str):
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("secrets")).alias("spans")
    )
