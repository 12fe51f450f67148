"""Model calls: cache, retries, fallbacks, skew, and the two scoring stages."""

import json

import pytest
from plan_text import executed_plan
from pyspark.sql import functions as F

from turnlens.operators import annotate
from turnlens.operators.annotate import CallPolicy
from turnlens.operators.issues import tag_issues
from turnlens.operators.satisfaction import score_satisfaction
from turnlens.schemas import REPLIES_SCHEMA
from turnlens.operators.context import add_last_system_text, write_turns
from turnlens.sources.replies import (
    append_cache,
    compact_cache,
    import_cache_folder,
    import_cache_jsonl,
    latest,
    lookup,
    next_number,
    read_cache,
    stored_replies,
    usable,
)
from turnlens.sources.tables import _table_name, read_table

QUICK = CallPolicy(max_retries=1, base_sleep=0.0)
FALLBACK = CallPolicy(on_error="fallback", max_retries=2, base_sleep=0.0)


def requests(spark, pairs):
    return spark.createDataFrame([(i, k, p) for i, (k, p) in enumerate(pairs)], "turn_id long, request_key string, prompt string")


def counting(spark):
    calls = spark.sparkContext.accumulator(0)

    def fn(prompt):
        calls.add(1)
        return {"echo": prompt}

    return fn, calls


def test_second_run_calls_nothing_and_agrees(spark, tmp_path):
    fn, calls = counting(spark)
    rows = requests(spark, [("a", "A"), ("b", "B"), ("a", "A"), (None, None)])
    path = str(tmp_path / "cache")

    def run():
        out = annotate.annotate(rows, fn, "t", "m", path, QUICK)
        return {r["turn_id"]: (r["response_json"], r["source"]) for r in out.collect()}

    first, after_first = run(), calls.value
    assert after_first == 2
    assert {s for _, s in first.values()} == {"llm", None}
    second = run()
    assert calls.value == 2
    assert {i: r for i, (r, _) in second.items()} == {i: r for i, (r, _) in first.items()}
    assert {s for _, s in second.values()} == {"cache", None}


def test_using_the_result_twice_calls_the_model_once(spark):
    fn, calls = counting(spark)
    out = annotate.annotate(requests(spark, [("a", "A"), ("b", "B")]), fn, "t", "m", None, QUICK)
    out.collect()
    out.join(out.select("turn_id"), "turn_id").collect()
    assert calls.value == 2


def test_batches_ask_every_key_once(spark, tmp_path):
    fn, calls = counting(spark)
    rows = requests(spark, [(f"k{i % 20}", f"p{i % 20}") for i in range(60)])
    policy = CallPolicy(max_retries=1, base_sleep=0.0, commit_batches=3, parallelism=2)
    out = annotate.annotate(rows, fn, "t", "m", str(tmp_path / "c"), policy)
    assert out.filter(F.col("response_json").isNull()).count() == 0
    assert calls.value == 20


def test_cache_of_another_model_is_not_used(spark, tmp_path):
    fn, calls = counting(spark)
    rows, path = requests(spark, [("a", "A")]), str(tmp_path / "c")
    for model in ("m1", "m2", "m1"):
        annotate.annotate(rows, fn, "t", model, path, QUICK).collect()
    assert calls.value == 2


def cache_rows(spark, rows):
    full = [(k, "t", "m", r, None, s) for k, r, s in rows]
    return spark.createDataFrame(full, REPLIES_SCHEMA)


def test_newest_row_wins_and_broken_rows_are_misses(spark):
    cache = cache_rows(spark, [("a", '{"x":1}', 1), ("a", '{"x":2}', 2), ("b", "{}", 1), ("b", "{broken", 2)])
    assert [(r["request_key"], r["response_json"]) for r in usable(cache).collect()] == [("a", '{"x":2}')]
    rows = requests(spark, [("a", "A"), ("b", "B")])
    assert [r["request_key"] for r in annotate.cache_misses(rows, cache).collect()] == ["b"]
    assert [r["request_key"] for r in annotate.cache_hits(rows, cache).collect()] == ["a"]


def test_empty_cache_reads_as_empty_table(spark, tmp_path):
    assert read_cache(spark, str(tmp_path / "none")).count() == 0
    append_cache(cache_rows(spark, [("a", "{}", 1)]), str(tmp_path / "some"))
    assert read_cache(spark, str(tmp_path / "some")).count() == 1


def test_import_of_file_caches(spark, tmp_path):
    lines = tmp_path / "cache.jsonl"
    lines.write_text('{"key":"a","model":"m","score":1,"reason":"x"}\n\n{"key":"a","model":"m","score":2,"reason":"é"}\n')
    row = latest(import_cache_jsonl(spark, str(lines))).first()
    assert (row["request_key"], row["response_json"], row["model"]) == ("a", '{"score":2,"reason":"é"}', "m")
    folder = tmp_path / "files"
    folder.mkdir()
    (folder / "abc.json").write_text('{\n "score": 3}')
    (folder / "bad.json").write_text("{")
    imported = import_cache_folder(spark, str(folder), "t", "m")
    assert {r["request_key"] for r in imported.collect()} == {"abc", "bad"}
    assert [r["request_key"] for r in usable(imported).collect()] == ["abc"]


def failing_first(times):
    state = {"n": 0}

    def fn(prompt):
        state["n"] += 1
        if state["n"] <= times:
            raise TimeoutError("busy")
        return {"ok": state["n"]}

    return fn


def one_call(spark, fn, policy):
    return annotate.call_model(requests(spark, [("a", "A")]), fn, policy).collect()[0]


def test_retries_until_success(spark):
    row = one_call(spark, failing_first(2), CallPolicy(max_retries=3, base_sleep=0.0))
    assert row["response_json"] == '{"ok": 3}' and row["error"] is None


def test_failure_ends_the_run_and_loses_no_other_reply(spark, tmp_path):
    """The replies of a failed run are kept, so the second one asks only for the rest."""
    calls = spark.sparkContext.accumulator(0)
    rows, path = requests(spark, [(c, c.upper()) for c in "abcdef"]), str(tmp_path / "cache")
    policy = CallPolicy(max_retries=2, base_sleep=0.0)

    def model(broken):
        def fn(prompt):
            calls.add(1)
            if prompt == broken:
                raise TimeoutError("busy")
            return {"echo": prompt}

        return fn

    with pytest.raises(RuntimeError, match="1 model calls failed.*TimeoutError"):
        annotate.annotate(rows, model("C"), "t", "m", path, policy)
    assert calls.value == 7
    out = annotate.annotate(rows, model(None), "t", "m", path, policy)
    assert {r["source"] for r in out.filter("request_key <> 'c'").collect()} == {"cache"} and out.count() == 6
    assert calls.value == 8


def test_refused_replies_are_asked_again_and_not_taken_from_the_cache(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)
    rows, path = requests(spark, [("a", "A")]), str(tmp_path / "cache")

    def fn(prompt):
        calls.add(1)
        return {"score": 9}

    for run in (1, 2):
        policy = CallPolicy(on_error="fallback", max_retries=3, base_sleep=0.0)
        out = annotate.annotate(rows, fn, "t", "m", path, policy, valid=lambda r: r["score"] < 6).first()
        assert (out["response_json"], out["error"], calls.value) == ('{"score": 9}', None, 3 * run)


def test_rows_with_an_unknown_condition_stay(spark):
    rows = requests(spark, [("a", "A"), ("b", "B"), ("c", "C")]).withColumn("ask", F.when(F.col("request_key") == "a", True))
    out = annotate.annotate(rows, lambda p: {"x": 1}, "t", "m", None, QUICK, F.col("ask")).collect()
    assert sorted((r["request_key"] or "-", r["response_json"]) for r in out) == [("-", None), ("-", None), ("a", '{"x": 1}')]


def test_calls_of_one_task_at_a_time(spark):
    """Eight calls of a fifth of a second each take less than eight fifths with eight under way."""
    import time

    def slow(prompt):
        time.sleep(0.2)
        return {"t": time.time()}

    policy = CallPolicy(parallelism=1, concurrency=8)
    rows = annotate.call_model(requests(spark, [(c, c) for c in "abcdefgh"]), slow, policy).collect()
    times = [json.loads(r["response_json"])["t"] for r in rows]
    assert max(times) - min(times) < 0.8


def test_fallback_records_the_error(spark):
    row = one_call(spark, failing_first(5), FALLBACK)
    assert row["response_json"] is None and row["error"] == "TimeoutError"
    row = one_call(spark, lambda prompt: "not json", FALLBACK)
    assert row["response_json"] is None and row["error"] == "JSONDecodeError"


def test_unknown_error_policy(spark):
    with pytest.raises(ValueError, match="on_error"):
        annotate.call_model(requests(spark, [("a", "A")]), lambda p: {}, CallPolicy(on_error="ignore"))


def test_hot_request_is_split_by_adaptive_execution(spark, conf):
    """Most rows share one request: the join splits that partition instead of running it in one task."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "40000")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    n = 40_000
    hot = F.when(F.col("id") < n * 2 // 3, "hot").otherwise(F.concat(F.lit("k"), F.col("id")))
    rows = spark.range(0, n, 1, 8).select(
        F.col("id").alias("turn_id"), hot.alias("request_key"), hot.alias("prompt"), F.sha2(F.col("id").cast("string"), 256).alias("pad")
    )
    out = annotate.annotate(rows, lambda p: {"p": p}, "t", "m", None, QUICK)
    plan = executed_plan(out)
    assert "skew=true" in plan
    assert out.count() == n and out.filter("response_json is null").count() == 0


TURNS = "dataset string, conv_id long, turn_id long, speaker string, text string, is_overall boolean"


@pytest.fixture
def turns(spark):
    data = [
        ("D", 1, 1, "USER", " hello ", False),
        ("D", 1, 2, "SYSTEM", "hi", False),
        ("D", 1, 3, "USER", "bad", False),
        ("D", 1, 4, "USER", "OVERALL", True),
        ("D", 2, 1, "USER", "hello", False),
        ("D", 2, 2, "SYSTEM", None, False),
        ("D", 2, 3, "USER", None, False),
    ]
    return spark.createDataFrame(data, TURNS)


def by_turn(df, *columns):
    return {(r["conv_id"], r["turn_id"]): tuple(r[c] for c in columns) for r in df.collect()}


def test_scoring_stage(spark, turns):
    def score(user, system):
        return {"score": 1 if user.strip() == "bad" else 4, "reason": f"{user}/{system}"}

    scored = score_satisfaction(turns, score, raw_inputs=True, policy=QUICK)
    got = by_turn(scored, "satisfaction_score", "low_satisfaction", "satisfaction_source")
    assert got == {
        (1, 1): (4, False, "llm"),
        (1, 2): (None, False, None),
        (1, 3): (1, True, "llm"),
        (1, 4): (None, False, None),
        (2, 1): (4, False, "llm"),
        (2, 2): (None, False, None),
        (2, 3): (4, False, "llm"),
    }
    assert by_turn(scored, "last_system_text")[(1, 3)] == ("hi",)
    assert "system_text_only" not in scored.columns


def test_equal_requests_are_sent_once(spark, turns):
    calls = spark.sparkContext.accumulator(0)

    def score(prompt):
        calls.add(1)
        return {"score": 3, "reason": ""}

    score_satisfaction(turns, score, policy=QUICK).collect()
    assert calls.value == 3  # "hello" twice (stripped), "bad", and the null text


def test_strict_scoring_keeps_the_dataset_flag(spark, turns):
    rated = turns.withColumn("low_satisfaction", F.lit(True))
    scored = score_satisfaction(rated, lambda p: {"score": 9, "reason": "x"}, strict=True, policy=FALLBACK)
    got = by_turn(scored, "llm_satisfaction_score", "llm_satisfaction_reason", "low_satisfaction_llm", "low_satisfaction")
    assert got[(1, 1)] == (3, "LLM_ERROR: ValueError", False, True)
    assert got[(1, 2)] == (None, None, False, True)


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="turns is missing columns"):
        score_satisfaction(spark.range(1), lambda p: {}, policy=QUICK)
    with pytest.raises(ValueError, match="low_satisfaction"):
        tag_issues(spark.createDataFrame([], TURNS), lambda p: {}, policy=QUICK)


def test_tagging_stage(spark, turns):
    low = turns.withColumn("low_satisfaction", F.col("turn_id") == 3).withColumn("reason", F.lit("stale"))

    def tag(snippet):
        return {"issues": ["LOOP", "odd"], "severity": "high", "reason": snippet}

    got = by_turn(tag_issues(low, tag, raw_inputs=True, policy=QUICK), "issues", "severity", "reason")
    assert got[(1, 3)] == (["LOOP", "odd"], "HIGH", "Bot: hi\nUser: bad")
    assert got[(1, 1)] == ([], "NONE", "")
    assert got[(2, 3)] == (["LOOP", "odd"], "HIGH", "Bot: [No previous system turn available]\nUser:")


def test_no_low_turns_gives_defaults(spark, turns):
    none = turns.withColumn("low_satisfaction", F.lit(False))
    got = by_turn(tag_issues(none, lambda p: {}, policy=QUICK), "issues", "severity", "reason")
    assert set(map(str, got.values())) == {str(([], "NONE", ""))}


def parts_of(path):
    return sorted(p.name for p in path.iterdir() if p.name.startswith("part_id="))


def test_lookup_reads_the_folders_of_its_task_and_model_only(spark, tmp_path, conf):
    conf("spark.sql.adaptive.enabled", "false")
    path = str(tmp_path / "cache")
    append_cache(cache_rows(spark, [(f"k{i}", f'{{"x":{i}}}', 1) for i in range(50)]), path)
    asked = spark.createDataFrame([("k3",), ("k7",), ("none",)], "request_key string")
    found = lookup(asked, stored_replies(spark, path, "t", "m"))
    assert {r["request_key"]: r["response_json"] for r in found.collect()} == {"k3": '{"x":3}', "k7": '{"x":7}'}
    plan = executed_plan(found)
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "task" in filters and "model" in filters
    # The keys cut the stored rows before any of them is aggregated.
    assert plan.index("Aggregate") < plan.index("LeftSemi")
    assert lookup(asked, stored_replies(spark, path, "t", "other")).count() == 0


def test_compaction_keeps_the_newest_rows_and_unfinished_parts(spark, tmp_path):
    path = tmp_path / "cache"
    for seq, reply in ((1, '{"x":1}'), (2, '{"x":2}'), (3, "{broken")):
        append_cache(cache_rows(spark, [("a" if seq < 3 else "b", reply, seq), (f"only{seq}", "{}", seq)]), str(path))
    unfinished = path / "part_id=000000000009-x"
    unfinished.mkdir()
    (unfinished / "junk.parquet").write_text("not a table yet")
    before = sorted(tuple(r) for r in latest(read_cache(spark, str(path))).collect())
    assert compact_cache(spark, str(path)) == 3
    assert len(parts_of(path)) == 2 and unfinished.exists()
    rows = read_cache(spark, str(path)).collect()
    assert sorted(tuple(r) for r in rows) == before and len(rows) == 5
    assert compact_cache(spark, str(path)) == 1
    assert next_number(spark, str(path)) == 4


def test_same_key_of_two_tasks_survives_compaction(spark, tmp_path):
    path, rows = str(tmp_path / "cache"), cache_rows(spark, [("a", "{}", 1)])
    append_cache(rows, path)
    append_cache(rows.withColumn("task", F.lit("another")), path)
    compact_cache(spark, path)
    assert {r["task"] for r in read_cache(spark, path).collect()} == {"t", "another"}


def test_import_numbers_lines_over_files_and_splits(spark, tmp_path, conf):
    conf("spark.sql.files.maxPartitionBytes", "200")
    conf("spark.sql.files.openCostInBytes", "0")
    n = 0
    for name in ("a.jsonl", "b.jsonl"):
        lines = []
        for _ in range(30):
            lines.append(json.dumps({"key": f"k{n % 7}", "model": "m", "score": n, "reason": ""}))
            n += 1
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    rows = import_cache_jsonl(spark, str(tmp_path)).collect()
    assert sorted((r["seq"], json.loads(r["response_json"])["score"]) for r in rows) == [(i - 59, i) for i in range(60)]
    newest = latest(import_cache_jsonl(spark, str(tmp_path))).collect()
    assert {r["request_key"]: json.loads(r["response_json"])["score"] for r in newest} == {f"k{i % 7}": i for i in range(53, 60)}


def test_stages_compute_the_context_once(spark, turns, tmp_path):
    """The result of a stage reads a written context: no window is left in its plan."""
    scored = score_satisfaction(turns, lambda p: {"score": 1, "reason": ""}, policy=QUICK)
    assert "Window" not in executed_plan(scored)
    tagged = tag_issues(scored, lambda p: {"issues": ["LOOP"]}, policy=QUICK)
    assert "Window" not in executed_plan(tagged)
    low = turns.withColumn("low_satisfaction", F.lit(True))
    assert "Window" not in executed_plan(tag_issues(low, lambda p: {"issues": []}, policy=QUICK))


def test_stored_turns_are_read_without_a_shuffle(spark, tmp_path):
    rows = [("D", c, t, "SYSTEM" if t % 3 else "USER", f"{c}/{t}", False) for c in range(40) for t in range(5)]
    rows += [("D", 99, t, "SYSTEM", f"x{t}", False) for t in (1, 150_000, 250_000)] + [("D", None, 1, "USER", "n", False)]
    df = spark.createDataFrame(rows, TURNS)
    path = write_turns(df, str(tmp_path / "turns"), buckets=5)
    stored = read_table(spark, path)
    got = add_last_system_text(stored)
    want = add_last_system_text(df)
    assert sorted(map(str, got.drop("turn_block").collect())) == sorted(map(str, want.collect()))
    short = write_turns(df.filter("conv_id < 40"), str(tmp_path / "short"), buckets=5)
    assert "Exchange" not in executed_plan(add_last_system_text(read_table(spark, short)))
    # Another session finds the layout at the path.
    spark.sql("DROP TABLE " + _table_name(short))
    again = read_table(spark, short)
    assert "Exchange" not in executed_plan(add_last_system_text(again)) and again.count() == 200
    assert write_turns(df.limit(3), short, buckets=2) == short and read_table(spark, short).count() == 3
