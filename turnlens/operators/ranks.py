"""Exact values at given ranks of a number column, by narrowing brackets.

Approximate quantiles bracket each wanted rank. One aggregate then counts the values outside the
brackets as a few sums and the values inside by themselves, so only those inside are moved. Where
too many are left inside, or a rank lies outside its bracket after all, the same is done again
within that part of the values. Approximation decides how much is read, never the result.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlens.sources.tables import pin

#: Relative rank error of the quantiles is 1 in so many.
ACCURACY = 10_000
#: Distances from a wanted fraction at which brackets may end: twice the error, and a wide one.
NARROW, WIDE = 2 / ACCURACY, 0.02
#: Different values inside a bracket that the driver may hold.
MOST_INSIDE = 50_000


class Ranked(NamedTuple):
    value: float
    #: How many values are smaller.
    below: int


def quantile_points(fractions: list[float], column: str = "v") -> Column:
    """An array of four approximate quantiles around each fraction, for :func:`brackets`."""
    points = [min(1.0, max(0.0, f + d)) for f in fractions for d in (-WIDE, -NARROW, NARROW, WIDE)]
    return F.expr(f"percentile_approx({column}, array({', '.join(f'{p!r}D' for p in points)}), {ACCURACY})")


def brackets(quantiles: list[float], fractions: list[float], n: int) -> list[tuple[float, float]]:
    """Disjoint intervals, in order, that most likely hold the ranks next to the fractions of n values."""
    found = []
    for i, fraction in enumerate(fractions):
        far_low, low, high, far_high = quantiles[4 * i : 4 * i + 4]
        reach = next((d for d in (NARROW, WIDE) if d * n >= 4), None)
        if reach is None:
            return [(-math.inf, math.inf)]
        low, high = (low, high) if reach == NARROW else (far_low, far_high)
        found.append((low if fraction > reach else -math.inf, high if fraction < 1 - reach else math.inf))
    merged: list[tuple[float, float]] = []
    for low, high in sorted(found):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def _within(part: int, inside: list[tuple[float, float]]) -> Column:
    """Values of one part: an interval, or what lies between two."""
    v, at = F.col("v"), part // 2
    if part % 2:
        return (v >= F.lit(inside[at][0])) & (v <= F.lit(inside[at][1]))
    above = v > F.lit(inside[at - 1][1]) if at else F.lit(True)
    return above & (v < F.lit(inside[at][0])) if at < len(inside) else above


def values_at_ranks(
    values: DataFrame, n: int, ranks: list[int], inside: list[tuple[float, float]], most: int = MOST_INSIDE
) -> dict[int, Ranked]:
    """The value at each 0-based rank of ``values`` (a double column v without nulls or NaN), and how many are smaller."""
    v = F.col("v")
    # Parts 0, 2, 4... lie between the intervals, parts 1, 3, 5... are the intervals.
    part = F.lit(0)
    for low, high in inside:
        part = part + (v > F.lit(high)).cast("int") * 2 + ((v >= F.lit(low)) & (v <= F.lit(high))).cast("int")
    marked = values.select(part.alias("part"), "v")
    kept = F.when(F.col("part") % 2 == 1, v).alias("v")
    counted = pin(marked.select("part", kept).groupBy("part", "v").agg(F.count(F.lit(1)).alias("n")), "ranks")
    sizes = counted.groupBy("part").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("different")).collect()
    found: dict[int, Ranked] = {}
    start = 0
    for number, size, different in sorted(tuple(r) for r in sizes):
        own = [r - start for r in ranks if start <= r < start + size]
        if own and number % 2 == 1 and different <= most:
            rows = sorted(tuple(r) for r in counted.filter(F.col("part") == number).select("v", "n").collect())
            below = 0
            for value, times in rows:
                found.update({start + r: Ranked(value, start + below) for r in own if below <= r < below + times})
                below += times
        elif own:
            some = values.filter(_within(number, inside))
            fractions = [(r + 0.5) / size for r in own]
            quantiles = some.agg(quantile_points(fractions).alias("q")).first()["q"]
            narrower = brackets(quantiles, fractions, size)
            if size > most and narrower == [(-math.inf, math.inf)]:
                narrower = [(q, q) for q in sorted(set(quantiles))]
            deeper = values_at_ranks(some, size, own, narrower, most if size > 4 * most else max(most, size))
            found.update({start + r: Ranked(x.value, start + x.below) for r, x in deeper.items()})
        start += size
    return found
