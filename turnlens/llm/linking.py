"""Groups of rows connected by verified links between rows that share a key.

Rows that share a key are not compared with each other in pairs. Each key names its smallest row,
and every row is compared with that one, which finds most links at little cost. Then every key
is gone through until no two of its rows are both of different groups and uncompared. What rows
say of themselves, such as their length, is compared inside the join that lets them meet. Rows
meet their representatives in a join that adaptive execution can split, so a key that a third of
all rows share is no single task there; only the searches for keys
that occur once and for keys of several groups see all rows of a key in one task.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlens.llm.common import Scratch
from turnlens.llm.shared_keys import Keys, listed, shared_keys


def _undecided(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """key, id, group, most: the entries of keys that hold several groups, and the group with most rows of the key."""
    # Moved once, to their keys: all that follows is by key, with one row of each on the other side.
    grouped = entries.join(groups, "id").select("key", "id", "group").repartition("key")
    keys = grouped.groupBy("key").agg(F.min("group").alias("least"), F.max("group").alias("last")).filter("least < last")
    apart = grouped.join(keys.select("key"), "key", "left_semi")
    sizes = apart.groupBy("key", "group").agg(F.count(F.lit(1)).alias("n"))
    return apart.join(sizes.groupBy("key").agg(F.max_by("group", F.struct("n", "group")).alias("most")), "key")


def _representatives(entries: DataFrame, choices: int, marks: list[str]) -> DataFrame:
    """key, rep, rep_group and rep_<mark>: up to ``choices`` rows of each key, none of the key's largest group."""
    share = F.pmod(F.xxhash64("id", "key"), F.lit(choices))
    named = entries.filter("group <> most").groupBy("key", share).agg(F.min(F.struct("id", "group", *marks)).alias("x"))
    return named.select(
        "key", F.col("x.id").alias("rep"), F.col("x.group").alias("rep_group"), *[F.col(f"x.{m}").alias(f"rep_{m}") for m in marks]
    )


def may_be_similar(similarity: float, longs: int) -> Column:
    """Condition on n and the sketch (s0, s1, ..., of ``parities``) of two rows that all similar ones fulfil.

    A changed word turns two bits at most and an added one a single bit, and as many are added as lengths differ.
    """
    longer, apart = F.greatest("n", "rep_n"), F.abs(F.col("n") - F.col("rep_n"))
    bits = sum((F.bit_count(F.col(f"s{i}").bitwiseXOR(F.col(f"rep_s{i}"))) for i in range(longs)), F.lit(0))
    most = F.floor((1.0 - similarity) * longer + 1e-6)
    return (apart <= most) & (bits <= 2 * most - apart)


def verified_groups(
    rows: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    may: Column | None = None,
    marked: DataFrame | None = None,
    choices: int = 256,
    keyed: Callable[[pa.RecordBatch], Keys] = listed,
) -> DataFrame:
    """id, root: the groups of rows (id, keys) that verified links connect; others are left out.

    ``keyed``, if given, makes the keys of rows that have other columns instead of keys.
    ``marked``, if given, has id and the marks of the rows that count; other rows are left out.

    ``verify`` takes distinct pairs (a, b), a < b, that share a key and returns those that match.
    ``may`` is a condition on the marks of a row, ``n`` say, and of the one it meets, ``rep_n``,
    that all matching pairs fulfil; it is part of the join, so no other pair is ever written.

    First every row meets the smallest row of each of its keys. Then all rows of keys that hold
    several groups, each member of a group among them, go on: the rows outside the largest group
    of a key meet every row of the key that is of another group, ``choices`` at a time and ever
    more, until no key holds two rows of different groups that have not met. No likeness is
    taken for granted but that of one group, and no row is dropped for the size of its key.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark)
    marked = rows.select("id") if marked is None else marked
    marks = [c for c in marked.columns if c != "id"]
    may = F.lit(True) if may is None else may
    roots: DataFrame | None = None
    tried: DataFrame | None = None

    def link(met: DataFrame) -> None:
        nonlocal roots, tried
        ordered = met.select(F.least("id", "rep").alias("a"), F.greatest("id", "rep").alias("b")).distinct()
        if tried is not None:
            ordered = ordered.join(tried, ["a", "b"], "left_anti")
        ordered = scratch.pin(ordered, "pairs")
        tried = ordered if tried is None else tried.union(ordered)
        links = scratch.pin(verify(ordered).select("a", "b"), "links")
        if not links.isEmpty():
            roots = components(links if roots is None else links.union(roots.select("id", "root")))

    def meet(entries: DataFrame, reps: DataFrame, apart: Column) -> DataFrame:
        own, other = entries.alias("own"), reps.withColumnRenamed("key", "rep_key")
        return own.join(other, (F.col("own.key") == F.col("rep_key")) & apart & may).select("id", "rep")

    def groups() -> DataFrame:
        if roots is None:
            return marked.select("id", F.col("id").alias("group"))
        return marked.select("id").join(roots, "id", "left").select("id", F.coalesce("root", "id").alias("group"))

    held = Scratch(spark)
    met = held.pin(shared_keys(rows, keyed), "met")
    first = met.select("rep", F.explode("ids").alias("id")).filter("id <> rep").distinct().join(marked, "id")
    other = marked.select(F.col("id").alias("rep"), *[F.col(m).alias(f"rep_{m}") for m in marks])
    link(first.join(other, "rep").filter(may))
    # The two rows of other keys have met.
    entries = met.filter("several").select("key", F.explode("ids").alias("id"))
    while True:
        before, held = held, Scratch(spark)
        entries = _undecided(entries, groups())
        entries = held.pin(entries.join(marked, "id") if marks else entries, "entries")
        before.drop()
        if entries.isEmpty():
            break
        reps = held.pin(_representatives(entries, choices, marks), "reps")
        link(meet(entries, reps, F.col("group") != F.col("rep_group")))
        # A representative has met every row of its key.
        entries = entries.select("key", "id").join(reps.select(F.col("rep").alias("id"), "key"), ["id", "key"], "left_anti")
        choices *= 64
    held.drop()
    if roots is None:
        scratch.drop()
        return rows.select("id", F.col("id").alias("root")).limit(0)
    kept = Scratch(spark).pin(roots, "groups")
    scratch.drop()
    return kept


def components(links: DataFrame) -> DataFrame:
    """id, root: each linked row (a, b) with the smallest id of its connected group.

    Large-star and small-star rounds; every round is a pair of partial aggregations and joins,
    written to the shared folder, until no link changes.
    """
    spark = links.sparkSession
    scratch = Scratch(spark)
    a, b = links.columns
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges = scratch.pin(edges, "edges")
    while not _stars(edges):
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: neighbours above a row point to the row's smallest neighbour.
        large = both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: neighbours below a row, and the row, point to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v"))
        )
        edges = scratch.pin(small.filter("u <> v").distinct(), "edges")
    # The last table is the result; those before it go.
    scratch.drop(keep=1)
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))


def _stars(edges: DataFrame) -> bool:
    """Whether every row points to one row only, which points to none."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("in")).union(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("in"))
    )
    degrees = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return degrees.filter((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("in") > 0))).isEmpty()
