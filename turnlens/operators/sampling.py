"""Seeded samples whose picks depend on the key only, not on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlens.operators.ranks import brackets, quantile_points, values_at_ranks
from turnlens.schemas import CONV, SCORING_COLUMNS, require_columns


def hash_order(seed: int, *key: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]))


def sample_conversations(turns: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """All turns of ``n`` conversations (every turn when there are no more than ``n``)."""
    require_columns(turns, SCORING_COLUMNS, "turns")
    picked = turns.select(*CONV).distinct().orderBy(hash_order(seed, *CONV), *CONV).limit(n)
    return turns.join(picked, CONV, "left_semi")


def sample_rows(df: DataFrame, n: int, seed: int, key: list[str]) -> DataFrame:
    """The first ``n`` rows in hash order of ``key`` (all rows when there are no more than ``n``).

    The hash of the n-th row is found by ranks, and the rows below it are taken by a filter, where
    they are. Only rows with that very hash, of which perhaps not all are wanted, are ordered.
    """
    total = df.count()
    if total <= n:
        return df
    if n <= 0:
        return df.limit(0)
    order = hash_order(seed, *key)
    # The first 52 bits, which a double holds exactly.
    leading = F.conv(F.substring(order, 1, 13), 16, 10).cast("double")
    values, fraction = df.select(leading.alias("v")), [(n - 0.5) / total]
    around = values.agg(quantile_points(fraction).alias("q")).first()["q"]
    cut = values_at_ranks(values, total, [n - 1], brackets(around, fraction, total))[n - 1]
    at_cut = df.filter(leading == F.lit(cut.value)).orderBy(order, *key).limit(n - cut.below)
    return df.filter(leading < F.lit(cut.value)).union(at_cut)
