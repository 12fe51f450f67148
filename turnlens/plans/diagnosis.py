"""The staged run: score, tag, cluster, repair, with every stage kept as a table."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from turnlens.operators.annotate import CallPolicy, ModelFn
from turnlens.operators.dashboard import Dashboard, build_dashboard
from turnlens.operators.issues import tag_issues
from turnlens.operators.repairs import repair_topics
from turnlens.operators.satisfaction import score_satisfaction
from turnlens.operators.topics import cluster_topics
from turnlens.operators.vectors import EmbedFn
from turnlens.sources.tables import (
    read_note,
    read_table,
    require_table,
    table_exists,
    table_state,
    write_note,
    write_table,
)

STAGES = ("satisfaction", "issues", "topics", "repairs")


@dataclass(frozen=True)
class Models:
    """The user's model functions and the model names that go into request keys.

    The functions take ready prompts, or with ``raw_inputs`` what the prompts are made
    from: user and last system text, snippet, topic description.
    """

    score: ModelFn
    tag: ModelFn
    repair: ModelFn
    embed: EmbedFn | None = None
    score_model: str = "default"
    tag_model: str = "default"
    repair_model: str = "default"
    raw_inputs: bool = False


@dataclass(frozen=True)
class Artifacts:
    """Where the stages keep their tables, under one base path."""

    base: str

    def path(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    @property
    def cache(self) -> str:
        return self.path("reply_cache")


#: Note of a stage whose tables are being written.
UNFINISHED = "unfinished"
#: The tables of each stage, in stage order.
TABLES = {
    "satisfaction": ("satisfaction",),
    "issues": ("issues",),
    "topics": ("topic_rows", "topic_summary", "turn_topics"),
    "repairs": ("repairs",),
}


class Manifest:
    """Notes beside the stage tables: from which input and with which settings a stage was finished.

    All tables of a stage are committed by its note, which is taken away before the first of them is
    written. Tables without any note were put there by somebody else and count as finished.
    """

    def __init__(self, spark: SparkSession, at: Artifacts):
        self.spark, self.at = spark, at

    def note(self, stage: str) -> str | None:
        return read_note(self.spark, self.at.path(f"_stages/{stage}"))

    def state(self, stage: str) -> str:
        """Changes whenever the stage is built anew."""
        note = self.note(stage)
        if note == UNFINISHED:
            raise FileNotFoundError(f"stage {stage} was left unfinished; run it again")
        tables = [self.at.path(name) for name in TABLES[stage]]
        return "+".join([note or "", *(table_state(self.spark, path) for path in tables)])

    def is_current(self, stage: str, fingerprint: str) -> bool:
        there = all(table_exists(self.spark, self.at.path(t)) for t in TABLES[stage])
        return there and self.note(stage) in (None, fingerprint)

    def build(self, stage: str, fingerprint: str, tables: Callable[[], tuple[DataFrame, ...]]) -> None:
        write_note(self.spark, self.at.path(f"_stages/{stage}"), UNFINISHED)
        for name, table in zip(TABLES[stage], tables()):
            write_table(table, self.at.path(name))
        write_note(self.spark, self.at.path(f"_stages/{stage}"), fingerprint)


def fingerprint(*parts: object) -> str:
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()


def diagnose(
    spark: SparkSession,
    turns_path: str,
    base: str,
    models: Models,
    from_stage: int = 1,
    to_stage: int = 4,
    skip_existing: bool = True,
    k: int | None = 6,
    strict: bool = False,
    policy: CallPolicy = CallPolicy(),
    k_range: tuple[int, int] = (4, 10),
) -> dict[str, DataFrame]:
    """Run stages ``from_stage`` to ``to_stage`` (1 score, 2 tag, 3 cluster, 4 repair).

    With ``skip_existing`` a finished stage is reused if its input and its settings are those it was
    built from; the model function stands for itself by its name in ``models``. A stage whose input
    is missing or unfinished raises ``FileNotFoundError``. Returns the tables of the stages run.
    """
    if not 1 <= from_stage <= to_stage <= len(STAGES):
        raise ValueError(f"stages run from 1 to {len(STAGES)}")
    at = Artifacts(base)
    manifest = Manifest(spark, at)

    def scored() -> tuple[DataFrame, ...]:
        turns = read_table(spark, turns_path)
        return (score_satisfaction(turns, models.score, models.score_model, at.cache, strict, policy, models.raw_inputs),)

    def tagged() -> tuple[DataFrame, ...]:
        turns = read_table(spark, at.path("satisfaction"))
        return (tag_issues(turns, models.tag, models.tag_model, at.cache, strict, policy, models.raw_inputs),)

    def clustered() -> tuple[DataFrame, ...]:
        turns = read_table(spark, at.path("issues"))
        return tuple(cluster_topics(turns, models.embed, k, strict=strict, k_range=k_range))

    def repaired() -> tuple[DataFrame, ...]:
        summary = read_table(spark, at.path("topic_summary"))
        turns = None if strict else read_table(spark, at.path("turn_topics"))
        return (
            repair_topics(
                summary, turns, models.repair, models.repair_model, at.cache, strict, policy, models.raw_inputs
            ),
        )

    settings = {
        "satisfaction": (scored, models.score_model, models.raw_inputs),
        "issues": (tagged, models.tag_model, models.raw_inputs),
        "topics": (clustered, k, list(k_range), models.embed is None),
        "repairs": (repaired, models.repair_model, models.raw_inputs),
    }
    out: dict[str, DataFrame] = {}
    for number in range(from_stage, to_stage + 1):
        stage = STAGES[number - 1]
        if number == 1:
            require_table(spark, turns_path, "stage 1")
            before = table_state(spark, turns_path)
        else:
            for name in TABLES[STAGES[number - 2]]:
                require_table(spark, at.path(name), f"stage {number}")
            before = manifest.state(STAGES[number - 2])
        tables, *parts = settings[stage]
        wanted = fingerprint(stage, before, strict, *parts)
        if not (skip_existing and manifest.is_current(stage, wanted)):
            manifest.build(stage, wanted, tables)
        out.update({name: read_table(spark, at.path(name)) for name in TABLES[stage]})
    return out


def dashboard_from(spark: SparkSession, base: str, strict: bool = False) -> Dashboard:
    """Dashboard tables from the finished stages; the run's own model score comes first."""
    at = Artifacts(base)
    tables = {n: require_table(spark, at.path(n), "dashboard") for n in ("issues", "topic_rows", "topic_summary", "repairs")}
    candidates = ("llm_satisfaction_score", "llm_score", "score") if strict else ("satisfaction_score",)
    return build_dashboard(
        tables["issues"], tables["topic_rows"], tables["topic_summary"], tables["repairs"], candidates
    )
