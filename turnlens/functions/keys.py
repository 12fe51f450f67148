"""Request keys for the response cache."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnlens.functions.text import ws_strip


def request_key(task: str, model: str, **texts: Column) -> Column:
    """sha256 of the canonical request: compact JSON, keys in order, texts stripped.

    Equal requests share a key whatever turn they come from, so one reply serves all.
    """
    fields = {"model": F.lit(model), "task": F.lit(task)}
    fields.update({name: ws_strip(F.coalesce(c, F.lit(""))) for name, c in texts.items()})
    payload = F.struct(*[fields[name].alias(name) for name in sorted(fields)])
    return F.sha2(F.to_json(payload), 256)


def turn_key(model: str, text: Column, last_system_text: Column) -> Column:
    """sha256 of turn identity, model and raw texts: one key per turn."""
    parts = [F.col("dataset"), F.col("conv_id"), F.col("turn_id"), F.lit(model), text, last_system_text]
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("|", *texts), 256)
