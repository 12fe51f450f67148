"""Context, sampling, topics, profiles, vectors, dashboard, staged run."""

import collections
import hashlib
import json
import math
import random
import re
import statistics

import numpy as np
import pytest
from plan_text import executed_plan
from pyspark.sql import functions as F

from turnlens.operators import sweep as sweep_module
from turnlens.operators import dashboard, profile, vectors
from turnlens.operators.annotate import CallPolicy
from turnlens.operators.context import add_last_system_text, first_turns, forward_fill, transcripts, write_turns
from turnlens.operators.ranks import brackets, quantile_points, values_at_ranks
from turnlens.operators.repairs import describe_topics, rank_topics, repair_topics
from turnlens.operators.sampling import sample_conversations, sample_rows
from turnlens.operators.topics import attach_topics, cluster_topics, label_topics, summarize_topics
from turnlens.plans.corpus import build_corpus, ingest_corpus
from turnlens.plans.diagnosis import Models, dashboard_from, diagnose
from turnlens.schemas import KEY, TURNS_SCHEMA
from turnlens.sources import exports, tables

QUICK = CallPolicy(max_retries=1, base_sleep=0.0)
TURNS = "dataset string, conv_id long, turn_id long, speaker string, text string"


def conversation(n, conv=1, every=3):
    return [("D", conv, i, "SYSTEM" if i % every == 0 else "USER", f"t{i}") for i in range(1, n + 1)]


def fill_in_python(rows):
    last, out = {}, {}
    for dataset, conv, turn, speaker, text in sorted(rows, key=lambda r: (str(r[0]), str(r[1]), r[2])):
        if speaker == "SYSTEM" and text is not None:
            last[dataset, conv] = text
        out[conv, turn] = last.get((dataset, conv))
    return out


@pytest.mark.parametrize("chunk", [1, 2, 7, 1000])
def test_last_system_text_over_chunks(spark, chunk):
    """One conversation much longer than the rest, with stretches without SYSTEM turns."""
    rows = conversation(200, every=23) + conversation(5, conv=2, every=2) + [("D", 3, 1, "SYSTEM", None)]
    got = add_last_system_text(spark.createDataFrame(rows, TURNS), chunk)
    assert {(r["conv_id"], r["turn_id"]): r["last_system_text"] for r in got.collect()} == fill_in_python(rows)
    assert got.columns == [*TURNS.replace(" string", "").replace(" long", "").split(", "), "last_system_text"]


def test_turns_without_conversation_are_kept_unfilled(spark):
    rows = [("D", None, 1, "SYSTEM", "s"), ("D", None, 2, "USER", "u"), (None, 4, 1, "SYSTEM", "x"), ("D", 1, 1, "SYSTEM", "y")]
    got = add_last_system_text(spark.createDataFrame(rows, TURNS)).collect()
    assert len(got) == 4
    assert [r["last_system_text"] for r in got if r["text"] != "y"] == [None] * 3


def test_context_plan_has_one_shuffle_when_no_conversation_is_long(spark, tmp_path):
    path = tables.write_table(spark.createDataFrame(conversation(50), TURNS), str(tmp_path / "t"))
    plan = executed_plan(add_last_system_text(tables.read_table(spark, path))).split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_long_group_is_spread_over_partitions(spark):
    df = spark.range(10_000).select(F.lit("g").alias("g"), "id", F.when(F.col("id") % 997 == 0, F.col("id")).alias("v"))
    filled = forward_fill(df, F.col("v"), "last", ["g"], "id", chunk=500)
    assert filled.filter(F.col("last") != F.floor(F.col("id") / 997) * 997).count() == 0


def test_transcripts(spark):
    rows = [("D", 1, i, s, None if i == 3 else f"t{i}") for i, s in enumerate(["SYSTEM", "USER", "OTHER"] * 6, 1)]
    snippet = transcripts(spark.createDataFrame(rows, TURNS)).first()["snippet"].split("\n")
    assert snippet[:3] == ["System: t1", "User: t2", "Bot: "] and len(snippet) == 14


def test_first_turns_are_cut_before_the_shuffle(spark, tmp_path):
    path = tables.write_table(spark.createDataFrame(conversation(100), TURNS), str(tmp_path / "t"))
    assert "WindowGroupLimit" in executed_plan(first_turns(tables.read_table(spark, path), 3))


def test_samples_do_not_depend_on_partitioning(spark):
    turns = spark.createDataFrame([r for c in range(30) for r in conversation(4, conv=c)], TURNS)
    picked = {r["conv_id"] for r in sample_conversations(turns, 7).collect()}
    again = {r["conv_id"] for r in sample_conversations(turns.repartition(5), 7).collect()}
    assert picked == again and len(picked) == 7
    assert sample_conversations(turns, 7).count() == 28
    assert sample_conversations(turns, 100).count() == turns.count()
    assert picked != {r["conv_id"] for r in sample_conversations(turns, 7, seed=1).collect()}
    assert sample_rows(turns, 10, 1, KEY).count() == 10


ROWS = "topic_id int, dataset string, conv_id long, turn_id long, text string, issues array<string>, severity string, reason string"


@pytest.fixture
def rows(spark):
    data = [
        (0, "D", 1, 1, "a", ["X", "Y"], "LOW", "nan"),
        (0, "D", 1, 3, "b", ["Y", "Z"], "LOW", ""),
        (0, "D", 2, 1, "c", ["Z", "Q"], "LOW", "first"),
        (0, "D", 2, 3, "d", ["W"], "LOW", "second"),
        (1, "D", 3, 1, "e", [], "LOW", "NaN"),
    ]
    return spark.createDataFrame(data, ROWS).repartition(3)


def test_topic_summary(rows):
    got = {r["topic_id"]: r for r in summarize_topics(rows).collect()}
    assert got[0]["top_issues"] == ["Y", "Z", "X"]  # ties by first appearance
    assert got[0]["topic_label"] == "Topic 0: Y / Z"
    assert got[0]["example_texts"] == ["a", "b", "c"] and got[0]["n_examples"] == 4
    assert got[0]["example_reason"] == "first"
    assert (got[1]["topic_label"], got[1]["top_issues"], got[1]["example_reason"]) == ("Topic 1: General", [], "")
    strict = {r["topic_id"]: r for r in summarize_topics(rows, 5, 5, strict=True).collect()}
    assert strict[0]["top_issues"] == ["Y", "Z", "X", "Q", "W"] and strict[1]["example_reason"] == "NaN"


def test_attach_topics_keeps_every_turn(spark, rows):
    turns = spark.createDataFrame(conversation(4), TURNS)
    got = {r["turn_id"]: (r["topic_id"], r["topic_label"]) for r in attach_topics(turns, rows, label_topics(rows)).collect()}
    assert got == {
        1: (0, "Topic 0: Y / Z"),
        2: (-1, "UNCLUSTERED"),
        3: (0, "Topic 0: Y / Z"),
        4: (-1, "UNCLUSTERED"),
    }


def test_topic_description_uses_extras_and_can_dedupe(spark, rows):
    summary = summarize_topics(rows)
    turns = rows.select("topic_id", *KEY, "text", F.lit("USER").alias("speaker"))
    plain = {r["topic_id"]: r["topic_description"] for r in describe_topics(summary, turns).collect()}
    assert "3) c\n4) a\n5) b" in plain[0]
    unique = {r["topic_id"]: r["topic_description"] for r in describe_topics(summary, turns, dedupe_examples=True).collect()}
    assert "3) c\n\nRepresentative" in unique[0]


def tagged(spark, n=60):
    text = F.concat(F.element_at(F.array(F.lit("refund my order"), F.lit("reset the password")), (F.col("id") % 2 + 1).cast("int")), F.lit(" "), F.col("id"))
    return spark.range(n).select(
        F.lit("D").alias("dataset"),
        F.col("id").alias("conv_id"),
        F.lit(1).cast("long").alias("turn_id"),
        F.when(F.col("id") % 5 == 4, "SYSTEM").otherwise("USER").alias("speaker"),
        text.alias("text"),
        F.lit(True).alias("low_satisfaction"),
        F.array(F.when(F.col("id") % 7 == 0, "SUCCESS_BEST_PRACTICE").otherwise("LOOP")).alias("issues"),
        F.lit("LOW").alias("severity"),
        F.lit("r").alias("reason"),
    )


def two_way_embed():
    def embed(texts):
        return [[1.0, 0.0, 0.1] if "refund" in t else [0.0, 1.0, 0.1] for t in texts]

    return embed


def test_clustering_invariants(spark):
    df = tagged(spark)
    topics = cluster_topics(df, two_way_embed(), k=2)
    chosen = {i for i in range(60) if i % 5 != 4 and i % 7 != 0}
    got = {r["conv_id"]: r["topic_id"] for r in topics.rows.collect()}
    assert set(got) == chosen and set(got.values()) == {0, 1}
    assert len({t for i, t in got.items() if i % 2 == 0}) == 1
    assert got == {r["conv_id"]: r["topic_id"] for r in cluster_topics(df, two_way_embed(), k=2).rows.collect()}
    turns = topics.turns
    assert turns.count() == 60
    assert turns.filter("topic_id = -1 and topic_label = 'UNCLUSTERED'").count() == 60 - len(chosen)
    assert sum(r["n_examples"] for r in topics.summary.collect()) == len(chosen)


def test_clustering_of_text_lists_and_chosen_k(spark):
    """Issue lists stored as text, and k from the silhouette scan."""
    as_text = tagged(spark).withColumn("issues", F.concat(F.lit("['"), F.array_join("issues", "', '"), F.lit("']")))
    want = {r["conv_id"]: r["topic_id"] for r in cluster_topics(tagged(spark), two_way_embed(), k=2).rows.collect()}
    assert {r["conv_id"]: r["topic_id"] for r in cluster_topics(as_text, two_way_embed(), k=2).rows.collect()} == want
    scanned = cluster_topics(as_text, two_way_embed(), k=None, k_range=(2, 3))
    assert {r["conv_id"] for r in scanned.rows.collect()} == set(want)


def test_clustering_of_empty_input(spark):
    with pytest.raises(ValueError, match="no rows to cluster"):
        cluster_topics(tagged(spark).withColumn("low_satisfaction", F.lit(False)), two_way_embed(), k=2)


def test_strict_clustering_takes_any_issue_list(spark):
    df = tagged(spark).withColumn("low_satisfaction_llm", F.col("conv_id") < 30)
    topics = cluster_topics(df, two_way_embed(), k=2, strict=True)
    assert topics.rows.count() == sum(1 for i in range(30) if i % 5 != 4)
    assert topics.rows.columns == [*KEY, "topic_id", "topic_label", "issues", "severity", "reason", "cluster_text"]


def test_default_embedding_has_unit_length(spark):
    embedded = vectors.embed_texts(tagged(spark), features=64)
    norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    assert embedded.select(F.max(F.abs(norm - 1))).first()[0] < 1e-5


@pytest.fixture
def points(spark):
    rng = np.random.default_rng(0)
    data = [(i, int(i % 3), (rng.normal(size=4) + i % 3).tolist()) for i in range(60)] + [(60, 9, [9.0] * 4)]
    return spark.createDataFrame(data, "id int, topic_id int, embedding array<float>")


def silhouettes_by_hand(rows, power):
    x = np.array([r["embedding"] for r in rows], dtype="float64")
    topics = np.array([r["topic_id"] for r in rows])
    d = np.linalg.norm(x[:, None] - x[None], axis=2) ** power
    out = {}
    for i, r in enumerate(rows):
        own = topics == topics[i]
        if own.sum() == 1:
            out[r["id"]] = 0.0
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, topics == t].mean() for t in set(topics) - {topics[i]})
        out[r["id"]] = (b - a) / max(a, b)
    return out


def test_silhouettes_against_brute_force(points, monkeypatch):
    want = silhouettes_by_hand(points.collect(), 2)
    for block in (10_000, 1):  # all topics at once, and one at a time
        whole = vectors._topic_blocks
        monkeypatch.setattr(vectors, "_topic_blocks", lambda df, whole=whole, block=block: whole(df, block))
        got = {r["id"]: r["silhouette"] for r in vectors.silhouettes(points).collect()}
        assert got == pytest.approx(want, abs=1e-6)
        assert vectors.mean_silhouette(points) == pytest.approx(statistics.mean(want.values()), abs=1e-6)
        monkeypatch.undo()


def test_nearest_centroid(points):
    placed = vectors.nearest_centroid(points, vectors.mean_vectors(points, "topic_id"), out="near").collect()
    means = {t: np.mean([r["embedding"] for r in placed if r["topic_id"] == t], axis=0) for t in (0, 1, 2, 9)}
    for r in placed:
        assert r["near"] == min(means, key=lambda t: np.linalg.norm(means[t] - np.array(r["embedding"])))


def lloyd(x, centers):
    """Textbook k-means from given centres, until nothing moves."""
    for _ in range(20):
        topic = ((x[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        means = np.array([x[topic == t].mean(axis=0) if (topic == t).any() else c for t, c in enumerate(centers)])
        if ((means - centers) ** 2).sum(axis=1).max() <= 1e-8:
            return means
        centers = means
    return centers


def test_sweep_of_k_against_single_models(points):
    """All models of one sweep are those of a run of their own; silhouettes are those of all pairs."""
    df = points.drop("topic_id")
    x = np.array([r["embedding"] for r in df.collect()], dtype="float64")
    seeds = sweep_module._seeds(df.select("embedding"), 4, 42)
    assert len(np.unique(seeds, axis=0)) == 4 and all((np.abs(x - s).max(axis=1) < 1e-6).any() for s in seeds)
    models = sweep_module.sweep(df, range(2, 5))
    for k in (2, 3, 4):
        assert models.centers[k] == pytest.approx(lloyd(x, seeds[:k]), abs=1e-6)
        rows = models.assign(df, k).collect()
        want = statistics.mean(silhouettes_by_hand(rows, 2).values())
        assert models.silhouettes[k] == pytest.approx(want, abs=1e-6)
    assert models.silhouettes[models.best] == max(models.silhouettes.values())
    again = sweep_module.sweep(df.repartition(3), range(2, 5))
    assert all(again.centers[k] == pytest.approx(models.centers[k], abs=1e-9) for k in (2, 3, 4))
    scores = [tuple(r) for r in sweep_module.select_k(df, 2, 4).collect()]
    assert [s for _, s in scores] == sorted((s for _, s in scores), reverse=True) and scores[0][0] == models.best


def test_sweep_of_few_distinct_vectors(spark):
    same = spark.createDataFrame([([1.0, 0.0],)] * 5, "embedding array<float>")
    with pytest.raises(ValueError, match="at least two topics"):
        sweep_module.sweep(same, range(2, 4))
    with pytest.raises(ValueError, match="no rows"):
        sweep_module.sweep(same.limit(0), range(2, 4))
    two = same.union(spark.createDataFrame([([0.0, 1.0],)] * 3, "embedding array<float>"))
    assert sweep_module.sweep(two, range(2, 4)).silhouettes == {2: 1.0, 3: 1.0}


def test_l2_normalize_keeps_zero_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    assert [r[0] for r in df.select(vectors.l2_normalize(F.col("v"))).collect()] == [[0.6, 0.8], [0.0, 0.0]]


@pytest.mark.parametrize("data", [[1.0], [2.0, 2.0, 2.0], [5.0, None, 1.0, float("nan")], [i * i % 101 / 7 for i in range(500)]])
def test_describe_against_numpy(spark, data):
    df = spark.createDataFrame([(x,) for x in data], "v double")
    row = profile.describe(df, F.col("v"), buckets=20).first()
    clean = [x for x in data if x is not None and x == x]
    assert row["count"] == len(clean) and row["mean"] == pytest.approx(np.mean(clean))
    for q, name in ((25, "q25"), (50, "q50"), (75, "q75")):
        assert row[name] == pytest.approx(np.percentile(clean, q))


def test_describe_of_nothing(spark):
    assert tuple(profile.describe(spark.createDataFrame([], "v double"), F.col("v")).first()) == (0,) + (None,) * 7


def test_profiles(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, 2)], "k string, v int")
    assert [tuple(r) for r in profile.value_counts(df, ["k"]).collect()] == [("a", 2), ("b", 1)]
    assert profile.value_counts(df, ["k"], dropna=False).count() == 3
    assert {r["k"]: r["share"] for r in profile.value_shares(df, ["k"]).collect()} == pytest.approx({"a": 2 / 3, "b": 1 / 3})
    assert {r["column_name"]: r["n_null"] for r in profile.null_profile(df).collect()} == {"k": 1, "v": 1}
    assert profile.duplicate_keys(df, ["k"]).first()[0] == 1
    assert [tuple(r) for r in profile.preview(df, 1, [F.desc("v")]).collect()] == [(None, 2)]
    first = profile.first_per_key(df, ["k"], ["v"]).collect()
    assert len(first) == 3


def test_pick_flag_prefers_the_model_flag(spark):
    df = spark.createDataFrame([(True, False)], "low_satisfaction boolean, low_satisfaction_llm boolean")
    assert df.select(profile.pick_flag(df)).first()[0] is False
    assert df.select(profile.pick_flag(df.drop("low_satisfaction_llm"))).first()[0] is True
    assert spark.range(1).select(profile.pick_flag(spark.range(1))).first()[0] is None


def test_resolve_score_is_chosen_per_table(spark):
    df = spark.createDataFrame([(None, 2.5), ("x", 1.0), ("4", 1.0)], "llm_score string, satisfaction_mean double")
    got = [tuple(r) for r in dashboard.resolve_score(df).select("satisfaction_score", "satisfaction_source").collect()]
    assert got == [(None, "llm"), (None, "llm"), (4.0, "llm")]
    dataset = dashboard.resolve_score(df.drop("llm_score")).first()
    assert (dataset["satisfaction_score"], dataset["satisfaction_source"]) == (2.5, "dataset")
    missing = dashboard.resolve_score(spark.range(1)).first()
    assert (missing["satisfaction_score"], missing["satisfaction_source"]) == (None, "missing")


def test_rank_topics(spark):
    df = spark.createDataFrame([(0, 5, 1), (1, 9, 0), (2, 5, 3)], "topic_id int, n_examples long, n_user_turns long")
    assert {r["topic_id"]: r["priority_rank"] for r in rank_topics(df).collect()} == {1: 1, 2: 2, 0: 3}


def test_json_exports(spark, tmp_path):
    df = spark.createDataFrame([(2, None, ["é", "b"]), (1, "x", [])], "topic_id int, note string, tags array<string>")
    lines = exports.export_jsonl(df.coalesce(1), str(tmp_path / "lines"))
    texts = [r["value"] for r in spark.read.text(lines).collect()]
    assert json.loads(texts[0]) == {"topic_id": 2, "note": None, "tags": ["é", "b"]} and "é" in texts[0]
    path = exports.export_json_array(df, str(tmp_path / "array"), ["topic_id"])
    text = "\n".join(r["value"] for r in spark.read.text(path).collect())
    assert [r["topic_id"] for r in json.loads(text)] == [1, 2] and "\n" in text
    assert exports.read_json_array(spark, path, df.schema).count() == 2
    empty = exports.export_json_array(df.limit(0), str(tmp_path / "empty"), ["topic_id"])
    assert spark.read.text(empty).first()["value"].split() in (["[", "]"], ["[]"])
    assert {r["topic_id"]: r["tags"] for r in exports.flatten_lists(df).collect()} == {1: "", 2: "é | b"}


def test_materialize_reuses_and_rebuilds(spark, tmp_path):
    path, builds = str(tmp_path / "t"), []

    def build():
        builds.append(1)
        return spark.range(3)

    assert tables.materialize(spark, path, build).count() == 3
    tables.materialize(spark, path, build)
    assert len(builds) == 1
    tables.materialize(spark, path, build, skip_existing=False)
    assert len(builds) == 2
    with pytest.raises(FileNotFoundError, match="run the earlier stage"):
        tables.require_table(spark, str(tmp_path / "none"), "stage 2")


def test_broadcast_only_below_the_bound(spark):
    assert "broadcast" in tables.broadcast_if_small(spark.range(5))._jdf.queryExecution().logical().toString()
    assert "broadcast" not in tables.broadcast_if_small(spark.range(5), 4)._jdf.queryExecution().logical().toString()


class Session:
    """Stands in for a session: settings only."""

    def __init__(self, **settings):
        self.conf = {key.replace("_", "."): value for key, value in settings.items()}


def test_scratch_folder_comes_from_the_session():
    cluster = Session(spark_checkpoint_dir="hdfs://shared/folder/", spark_master="yarn")
    assert tables.scratch_path(cluster, "x").startswith("hdfs://shared/folder/x-")
    assert tables.scratch_dir(Session(spark_master="local[2]")) == tables.scratch_dir(Session(spark_master="local"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.scratch_dir(Session(spark_master="yarn"))


def test_corpus_of_two_formats(spark, tmp_path):
    (tmp_path / "a.txt").write_text("USER\thi\tACT\t1,2\n")
    (tmp_path / "b.txt").write_text("USER\tyo\tTAG\t5\nUSER\tOVERALL\t\t1\n")
    corpus = ingest_corpus(spark, {"SGD": (str(tmp_path / "a.txt"), "sgd"), "CCPE": (str(tmp_path / "b.txt"), "ccpe")})
    assert corpus.schema.fieldNames() == TURNS_SCHEMA.fieldNames()
    got = {(r["dataset"], r["turn_id"]): (r["dialog_act"], r["entity_tag"], r["label"], r["low_satisfaction"]) for r in corpus.collect()}
    assert got == {
        ("SGD", 1): ("ACT", None, "ACT", True),
        ("CCPE", 1): (None, "TAG", "TAG", False),
        ("CCPE", 2): (None, None, None, False),
    }
    assert build_corpus([corpus]).count() == 3


def test_staged_run_reuses_stages_and_exports(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def score(user, system):
        calls.add(1)
        return {"score": 1, "reason": "r"}

    def tag(snippet):
        return {"issues": ["LOOP"], "severity": "HIGH", "reason": "again"}

    def repair(description):
        return {"root_cause": "c", "system_prompt_snippet": "s", "guardrail_rules": ["g"]}

    rows = [r for c in range(8) for r in conversation(4, conv=c)]
    source = tables.write_table(spark.createDataFrame(rows, TURNS), str(tmp_path / "turns"))
    base = str(tmp_path / "run")
    models = Models(score, tag, repair, raw_inputs=True)
    with pytest.raises(FileNotFoundError, match="stage 3"):
        diagnose(spark, source, base, models, from_stage=3)
    diagnose(spark, source, base, models, to_stage=2, k=2, policy=QUICK)
    once = calls.value
    out = diagnose(spark, source, base, models, k=2, policy=QUICK)
    assert calls.value == once
    assert out["turn_topics"].count() == 32 and out["repairs"].count() == out["topic_summary"].count()
    board = dashboard_from(spark, base)
    assert board.turns.filter("satisfaction_source = 'llm' and satisfaction_score = 1").count() == 24
    lines = dashboard.export_dashboard(board, str(tmp_path / "lines"))
    counts = {name: spark.read.json(path).count() for name, path in lines.items()}
    paths = dashboard.export_dashboard(board, str(tmp_path / "board"), arrays=True)
    assert counts["topics"] == board.topics.count() and counts["turns"] == board.turns.count()
    topics = json.loads("\n".join(r["value"] for r in spark.read.text(paths["topics"]).collect()))
    assert [t["n_examples"] for t in topics] == sorted((t["n_examples"] for t in topics), reverse=True)
    assert "_n" not in topics[0] and topics[0]["low_satisfaction_rate"] == 1.0
    cases = json.loads("\n".join(r["value"] for r in spark.read.text(paths["sandbox_cases"]).collect()))
    assert cases[0]["repaired_system_prompt"].endswith("\n\ns")
    assert cases[0]["example_conversations"][0]["snippet"].startswith("User: t1\nUser: t2\nSystem: t3")
    with pytest.raises(ValueError, match="stages run from"):
        diagnose(spark, source, base, models, from_stage=4, to_stage=2)


def test_repairs_without_label_get_a_default(spark):
    summary = spark.createDataFrame([(7, 1, ["A"], ["t"], "r")], "topic_id int, n_examples long, top_issues array<string>, example_texts array<string>, example_reason string")
    row = repair_topics(summary, None, lambda p: {"root_cause": " x "}, policy=QUICK).first()
    assert (row["topic_label"], row["root_cause"], row["guardrail_rules"]) == ("Topic 7", "x", [])


def sorted_values(spark, values, parts=3):
    return spark.createDataFrame([(float(v),) for v in values], "v double").repartition(parts)


RANK_VALUES = {
    "one": [5.0], "two": [2.0, 1.0], "equal": [1.0] * 500, "spread": [float(i * 7919 % 3001) for i in range(3000)],
    "few": [float(i * 31 % 6) for i in range(2000)], "odd": [float("inf"), float("-inf"), 0.0, -0.5, 1e300],
    "tied": [0.0 if i % 2 else i / 7 for i in range(1500)],
}


@pytest.mark.parametrize("name, most", [*((n, 50_000) for n in RANK_VALUES), ("spread", 30), ("tied", 30), ("odd", 3)])
def test_ranks_against_sorting(spark, name, most):
    values = RANK_VALUES[name]
    n, ordered = len(values), sorted(values)
    ranks = sorted({0, n // 4, n // 2, n - 1})
    fractions = [(r + 0.5) / n for r in ranks]
    df = sorted_values(spark, values)
    around = df.agg(quantile_points(fractions).alias("q")).first()["q"]
    got = values_at_ranks(df, n, ranks, brackets(around, fractions, n), most)
    assert got == {r: (ordered[r], sum(x < ordered[r] for x in values)) for r in ranks}


def test_ranks_outside_their_brackets_are_found_all_the_same(spark):
    df = sorted_values(spark, range(1000))
    got = values_at_ranks(df, 1000, [10, 500, 990], [(400.0, 600.0), (700.0, 710.0)])
    assert {r: x.value for r, x in got.items()} == {10: 10.0, 500: 500.0, 990: 990.0}


def test_only_values_inside_the_brackets_are_moved(spark):
    df = spark.range(200_000).select(F.col("id").cast("double").alias("v"))
    around = df.agg(quantile_points([0.5]).alias("q")).first()["q"]
    (bracket,) = brackets(around, [0.5], 200_000)
    assert bracket[1] - bracket[0] < 200


def test_sample_of_rows_with_one_hot_key(spark):
    rows = [("D", 1, 1, "USER", f"same {i}") for i in range(300)] + [("D", 2, i, "USER", f"t{i}") for i in range(300)]
    df = spark.createDataFrame(rows, TURNS).repartition(4)
    order = sorted(rows, key=lambda r: (hashlib.md5(f"1|{r[0]}|{r[1]}|{r[2]}".encode()).hexdigest(), r[:3]))
    for n in (0, 1, 100, 301, 599, 600, 900):
        got = sorted((r["conv_id"], r["turn_id"]) for r in sample_rows(df, n, 1, KEY).collect())
        assert got == sorted(r[1:3] for r in order[:n])


def test_topic_summary_uses_hash_aggregates(spark):
    rows = [("D", c, t, c % 3, ["LOOP", "TONE_ISSUE"][: 1 + t % 2], f"x{c}", "why" if t == 2 else "") for c in range(30) for t in (1, 2)]
    df = spark.createDataFrame(rows, "dataset string, conv_id long, turn_id long, topic_id int, issues array<string>, text string, reason string")
    plan = executed_plan(summarize_topics(df))
    assert "SortAggregate" not in plan
    first = summarize_topics(df).orderBy("topic_id").first()
    assert (first["n_examples"], first["top_issues"], first["example_reason"]) == (20, ["LOOP", "TONE_ISSUE"], "why")


def test_a_turn_with_two_topics_gets_the_smallest(spark):
    turns = spark.createDataFrame([("D", 1, 1, "USER", "x")], TURNS)
    rows = spark.createDataFrame([("D", 1, 1, 7), ("D", 1, 1, 3)], "dataset string, conv_id long, turn_id long, topic_id int")
    labels = spark.createDataFrame([(7, "seven"), (3, "three")], "topic_id int, topic_label string")
    assert [r["topic_label"] for r in attach_topics(turns, rows, labels).collect()] == ["three"]


def test_tfidf_values_against_counting(spark):
    from pyspark.ml.feature import HashingTF

    texts = ["to be or not to be", "Be, as you are!", None, "", "question question question", "être ou ne pas être"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r["id"]: r["embedding"] for r in vectors.embed_texts(rows, features=1 << 16).collect()}
    index = HashingTF(numFeatures=1 << 16).indexOf
    bags = [collections.Counter(re.findall(r"\w+", (t or "").lower())) for t in texts]
    seen = collections.Counter(w for bag in bags for w in bag)
    for i, bag in enumerate(bags):
        want = {index(w): c * math.log((len(texts) + 1) / (seen[w] + 1)) for w, c in bag.items()}
        norm = math.sqrt(sum(x * x for x in want.values())) or 1.0
        assert {j: round(x, 5) for j, x in enumerate(got[i]) if x} == {j: round(x / norm, 5) for j, x in want.items()}


def staged(spark, tmp_path, texts, **how):
    rows = [("D", c, t, "USER" if t % 2 else "SYSTEM", f"{texts} {c} {t}") for c in range(12) for t in range(1, 5)]
    source = write_turns(spark.createDataFrame(rows, TURNS), str(tmp_path / "turns"), buckets=2)
    models = Models(
        lambda p: {"score": 1, "reason": "bad"}, lambda p: {"issues": ["LOOP"], "severity": "LOW"}, lambda p: {"root_cause": p[:9]}
    )
    return diagnose(spark, source, str(tmp_path / "run"), models, k=2, policy=QUICK, **how)


def built_at(tmp_path, name):
    return (tmp_path / "run" / name / "_SUCCESS").stat().st_mtime_ns


def test_stages_are_built_anew_when_input_or_settings_change(spark, tmp_path):
    staged(spark, tmp_path, "first", to_stage=2)
    before = {n: built_at(tmp_path, n) for n in ("satisfaction", "issues")}
    again = diagnose(spark, str(tmp_path / "turns"), str(tmp_path / "run"), Models(None, None, None), to_stage=2, policy=QUICK)
    assert {n: built_at(tmp_path, n) for n in before} == before and again["issues"].count() == 48
    out = staged(spark, tmp_path, "second", to_stage=2)
    assert all(r["text"].startswith("second") for r in out["issues"].collect())
    assert all(built_at(tmp_path, n) > before[n] for n in before)
    # Another model for the second stage: only that is built anew.
    scored = built_at(tmp_path, "satisfaction")
    models = Models(None, lambda p: {"issues": ["TONE_ISSUE"]}, None, tag_model="other")
    out = diagnose(spark, str(tmp_path / "turns"), str(tmp_path / "run"), models, to_stage=2, policy=QUICK)
    assert built_at(tmp_path, "satisfaction") == scored
    assert {x for r in out["issues"].collect() for x in r["issues"]} == {"TONE_ISSUE"}


def test_a_half_written_stage_is_neither_read_nor_reused(spark, tmp_path):
    staged(spark, tmp_path, "x", to_stage=3)
    tables.write_note(spark, str(tmp_path / "run/_stages/topics"), "unfinished")
    with pytest.raises(FileNotFoundError, match="unfinished"):
        diagnose(spark, str(tmp_path / "turns"), str(tmp_path / "run"), Models(None, None, None), 4, 4, policy=QUICK)
    before = built_at(tmp_path, "topic_summary")
    diagnose(spark, str(tmp_path / "turns"), str(tmp_path / "run"), Models(None, None, None), 1, 3, k=2, policy=QUICK)
    assert built_at(tmp_path, "topic_summary") > before
