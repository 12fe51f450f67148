"""Edit similarity of two sequences by a banded bit-parallel alignment."""

from __future__ import annotations

import numpy as np


def edit_distance(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Levenshtein distance, exact up to ``most``; any larger value means more than ``most``.

    Python integers hold one column of the alignment matrix as bits. Matches farther from the
    diagonal than ``most`` are masked out: no alignment of at most ``most`` edits uses them.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > most:
        return most + 1
    # The common start and end cost nothing.
    n = len(a)
    differ = np.flatnonzero(a != b[:n])
    first = int(differ[0]) if len(differ) else n
    a, b = a[first:], b[first:]
    n = len(a)
    differ = np.flatnonzero(a[::-1] != b[::-1][:n]) if n else np.empty(0)
    last = int(differ[0]) if len(differ) else n
    a, b = a[: n - last], b[: len(b) - last]
    if not len(a):
        return len(b)
    n = len(a)
    where: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        where[x] = where.get(x, 0) | (1 << i)
    full, top = (1 << n) - 1, 1 << (n - 1)
    band = (1 << (2 * most + 1)) - 1
    up, down, distance = full, 0, n
    left = len(b)
    for j, x in enumerate(b.tolist()):
        left -= 1
        low = j - most
        match = where.get(x, 0) & ((band << low) if low >= 0 else (band >> -low))
        diagonal = (((match & up) + up) ^ up) | match | down
        plus = down | ~(diagonal | up) & full
        minus = up & diagonal
        if plus & top:
            distance += 1
        elif minus & top:
            distance -= 1
        if distance - left > most:
            return most + 1
        plus = (plus << 1 | 1) & full
        minus = (minus << 1) & full
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
    return distance


def similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Edit similarity, 1 - distance / longer length, of at least ``threshold``."""
    longer = max(len(a), len(b))
    if longer == 0:
        return True
    most = int((1.0 - threshold) * longer + 1e-9)
    return edit_distance(a, b, most) <= most
