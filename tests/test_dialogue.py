"""Dialogue files: hand-written lines, and split independence against a sequential reader."""

import random

import pytest
from pyspark.sql import functions as F

from turnlens.sources import dialogue
from turnlens.sources.dialogue import FORMATS, ingest, load_dialogue, parse_dialogue

LINES = [
    " ",
    "USER\thi\tINFORM\t3,3,2",
    "SYSTEM\thello",
    "USER\tOVERALL\t\t4,4,x",
    "  ",
    "",
    "SYSTEM",
    "USER\tbye\t\t3, 4,\textra",
]


def write(path, lines, end="\n"):
    path.write_bytes((end.join(lines) + end).encode("utf-8"))
    return str(path)


def rows(df, *columns):
    return [tuple(r) for r in df.orderBy("conv_id", "turn_id").select(*columns).collect()]


def sequential(lines, closes):
    """Reference counter: one pass, one line at a time."""
    out, conv, turn = [], 0, 0
    for line in lines:
        if not line.strip():
            if turn:
                conv, turn = conv + 1, 0
            continue
        turn += 1
        out.append((conv, turn, line))
        if closes and line.startswith("USER\tOVERALL"):
            conv, turn = conv + 1, 0
    return out


def test_sgd_lines(spark, tmp_path):
    df = load_dialogue(spark, write(tmp_path / "sgd.txt", LINES), "sgd")
    columns = ["conv_id", "turn_id", "speaker", "text", "dialog_act", "scores_raw", "scores", "is_overall"]
    assert rows(df, *columns) == [
        (0, 1, "USER", "hi", "INFORM", "3,3,2", [3, 3, 2], False),
        (0, 2, "SYSTEM", "hello", None, None, None, False),
        (0, 3, "USER", "OVERALL", None, "4,4,x", None, True),
        (1, 1, "SYSTEM", "", None, None, None, False),
        (1, 2, "USER", "bye", None, "3, 4,", None, False),
    ]


def test_overall_line_closes_a_ccpe_conversation(spark, tmp_path):
    without_blanks = [line for line in LINES if line.strip()]
    path = write(tmp_path / "c.txt", without_blanks)
    assert {r[0] for r in rows(load_dialogue(spark, path, "sgd"), "conv_id")} == {0}
    ccpe = load_dialogue(spark, path, "ccpe")
    assert rows(ccpe, "conv_id", "turn_id") == [(0, 1), (0, 2), (0, 3), (1, 1), (1, 2)]
    assert "entity_tag" in ccpe.columns
    both = write(tmp_path / "d.txt", LINES)
    assert {r[0] for r in rows(load_dialogue(spark, both, "ccpe"), "conv_id")} == {0, 1}


def test_formats_differ_in_scores_and_overall(spark, tmp_path):
    path = write(tmp_path / "m.txt", ["USER\tOVERALL\tact\t 3,4 "])
    mwoz = load_dialogue(spark, path, "mwoz").first()
    assert (mwoz["scores_raw"], mwoz["scores"], mwoz["is_overall"]) == (" 3,4 ", [3, 4], True)
    assert load_dialogue(spark, path, "sgd").first()["scores_raw"] == "3,4"
    assert load_dialogue(spark, path, "redial").first()["is_overall"] is False
    action = load_dialogue(spark, path, "redial_action").first()
    assert (action["scores_raw"], action["scores"], action["is_overall"]) == (None, None, False)


def test_crlf_and_unicode_blank_lines(spark, tmp_path):
    path = write(tmp_path / "w.txt", ["USER\ta", " 　", "USER\tb", "\x1c", "USER\tc"], end="\r\n")
    assert rows(load_dialogue(spark, path, "sgd"), "conv_id", "text") == [(0, "a"), (1, "b"), (2, "c")]


@pytest.mark.parametrize("fmt", ["sgd", "ccpe"])
@pytest.mark.parametrize("split_bytes", [60, 200, 100_000])
def test_numbering_does_not_depend_on_splits(spark, tmp_path, conf, fmt, split_bytes):
    rng = random.Random(split_bytes)
    pool = ["", " \t", "USER\tOVERALL", "USER\tu{}", "SYSTEM\ts{}", "SYSTEM\tlonger reply number {}"]
    lines = [rng.choice(pool).format(i) for i in range(400)]
    path = write(tmp_path / "random.txt", lines)
    conf("spark.sql.files.maxPartitionBytes", split_bytes)
    conf("spark.sql.files.openCostInBytes", "0")
    df = load_dialogue(spark, path, fmt)
    got = rows(df, "conv_id", "turn_id", "speaker", "text")
    want = sequential(lines, FORMATS[fmt].overall_closes)
    assert got == [(c, t, *line.split("\t")[:2]) for c, t, line in want]


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_numbering_does_not_depend_on_blocks(spark, tmp_path, monkeypatch, bits):
    rng = random.Random(bits)
    lines = [rng.choice(["", "USER\tOVERALL", "USER\tu{}", "SYSTEM\ts{}"]).format(i) for i in range(120)]
    monkeypatch.setattr(dialogue, "BLOCK_BITS", bits)
    df = load_dialogue(spark, write(tmp_path / "blocks.txt", lines), "ccpe")
    got = rows(df, "conv_id", "turn_id", "speaker", "text")
    assert got == [(c, t, *line.split("\t")[:2]) for c, t, line in sequential(lines, True)]


def test_conversation_longer_than_many_splits(spark, tmp_path, conf):
    lines = ["USER\tfirst", ""] + [f"USER\tline {i}" for i in range(300)] + ["", "USER\tlast"]
    conf("spark.sql.files.maxPartitionBytes", "100")
    conf("spark.sql.files.openCostInBytes", "0")
    df = load_dialogue(spark, write(tmp_path / "long.txt", lines), "sgd")
    counts = {r["conv_id"]: (r["n"], r["m"]) for r in df.groupBy("conv_id").agg(F.count("*").alias("n"), F.max("turn_id").alias("m")).collect()}
    assert counts == {0: (1, 1), 1: (300, 300), 2: (1, 1)}


def test_files_of_a_folder_are_numbered_on(spark, tmp_path):
    write(tmp_path / "a.txt", ["USER\ta1", "", "USER\ta2"])
    write(tmp_path / "b.txt", ["USER\tb1", "SYSTEM\tb2"])
    df = load_dialogue(spark, str(tmp_path), "sgd")
    assert rows(df, "conv_id", "turn_id", "text") == [(0, 1, "a1"), (1, 1, "a2"), (2, 1, "b1"), (2, 2, "b2")]


def test_blank_file_gives_no_turns(spark, tmp_path):
    assert load_dialogue(spark, write(tmp_path / "e.txt", ["", " "]), "sgd").count() == 0


def test_ingest_adds_dataset_mean_and_label(spark, tmp_path):
    row = ingest(spark, write(tmp_path / "i.txt", ["USER\thi\tACT\t2,3"]), "sgd", "SGD").first()
    assert (row["dataset"], row["satisfaction_mean"], row["label"]) == ("SGD", 2.5, "ACT")


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="unknown dialogue format"):
        load_dialogue(spark, "/nowhere", "xyz")


def test_lines_need_their_order_columns(spark):
    with pytest.raises(ValueError, match="lines is missing columns"):
        parse_dialogue(spark.createDataFrame([("a",)], "value string"), "sgd")
