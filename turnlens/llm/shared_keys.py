"""Keys that several rows share, found without a Spark row for each key.

Keys are dealt by their hash to slices. Each task packs the keys of some tens of thousands of rows
into one block a slice, sorted, and the blocks of a slice meet in one task, which
sorts them. Only keys that two rows or more have become rows of a table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from turnlens.llm.hashing import mix

#: Row ids and their keys, one each.
Keys = tuple[np.ndarray, np.ndarray]

#: Slices of the keys, as bits of their hash; 32 more bits tell the keys of a slice apart.
SLICE_BITS = 11

#: Bits of the number of keys that are packed at once.
BLOCK_BITS = 20


def listed(batch: pa.RecordBatch) -> Keys:
    """The distinct keys of rows (id, keys)."""
    lists = batch.column(1)
    ids = np.repeat(batch.column(0).to_numpy(), np.diff(lists.offsets.to_numpy()) if len(lists) else 0)
    return ids, lists.flatten().to_numpy()


def planes(values: np.ndarray) -> np.ndarray:
    """The bytes of numbers, all first ones first: those of little variety compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)


def packed(ids: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    """slice, least, block: ids above the smallest one and distances between keys, by slice."""
    places = np.arange(len(keys)).astype(np.uint64)
    ordered = np.sort(mix(keys.view(np.uint64), 83) >> np.uint64(64 - 32 - SLICE_BITS) << np.uint64(BLOCK_BITS) | places)
    ids = ids[(ordered & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)]
    which, low = (ordered >> np.uint64(32 + BLOCK_BITS)).astype(np.int32), (ordered >> np.uint64(BLOCK_BITS)).astype(np.uint32)
    first = np.flatnonzero(np.concatenate(([True], which[1:] != which[:-1])))
    apart = np.diff(low, prepend=np.uint32(0))
    apart[first] = low[first]
    least = int(ids.min())
    parts = [*planes(apart), *planes((ids - least).view(np.uint64))]
    ends = np.append(first[1:], len(which))
    made = [b"".join([part[a:b] for part in parts]) for a, b in zip(first.tolist(), ends.tolist())]
    columns = [pa.array(which[first]), pa.array(np.full(len(first), least)), pa.array(made, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["slice", "least", "block"])


def unpacked(least: int, block: bytes) -> Keys:
    """ids and keys of a block."""
    parts = np.frombuffer(block, np.uint8).reshape(12, -1)
    apart, above = (np.ascontiguousarray(x.T).view(kind)[:, 0] for x, kind in ((parts[:4], np.uint32), (parts[4:], np.int64)))
    return above + least, np.cumsum(apart, dtype=np.uint32)


def blocks(rows: DataFrame, keyed: Callable[[pa.RecordBatch], Keys]) -> DataFrame:
    """The packed keys of rows."""

    def flush(held: list[Keys]) -> Iterator[pa.RecordBatch]:
        ids, keys = (np.concatenate(x) for x in zip(*held))
        for first in range(0, len(ids), 1 << BLOCK_BITS):
            yield packed(ids[first : first + (1 << BLOCK_BITS)], keys[first : first + (1 << BLOCK_BITS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Keys] = []
        size = 0
        for whole in batches:
            for first in range(0, len(whole), 1000):
                made = keyed(whole.slice(first, 1000))
                if size and size + len(made[0]) > 1 << BLOCK_BITS:
                    yield from flush(held)
                    held, size = [], 0
                held.append(made)
                size += len(made[0])
        if size:
            yield from flush(held)

    return rows.mapInArrow(run, "slice int, least long, block binary")


#: Rows of a key in one row of the result.
IDS_AT_ONCE = 1 << 10


def shared_keys(rows: DataFrame, keyed: Callable[[pa.RecordBatch], Keys] = listed) -> DataFrame:
    """key, rep, several, ids: of keys of two rows or more the smallest row, whether there are more than two, and all rows.

    ``rows`` are what ``keyed`` takes; a row that is given more than once counts once. Keys are
    returned as hashes, those of many rows in several parts.
    """

    def shared(number: int, held: list[Keys]) -> pa.RecordBatch:
        ids, keys = (np.concatenate(x) for x in zip(*held))
        ordered = np.sort(keys.astype(np.uint64) << np.uint64(32) | np.arange(len(keys)).astype(np.uint64))
        keys, ids = (ordered >> np.uint64(32)).astype(np.uint32), ids[(ordered & np.uint64(0xFFFFFFFF)).astype(np.int64)]
        same = keys[1:] == keys[:-1]
        some = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        keys, ids = keys[some], ids[some]
        order = np.lexsort((ids, keys))
        keys, ids = keys[order], ids[order]
        new = np.concatenate((np.ones(min(1, len(keys)), bool), (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])))
        keys, ids = keys[new], ids[new]
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
        counts = np.diff(np.append(first, len(keys)))
        inside = np.repeat(counts > 1, counts)
        keys, ids, counts = keys[inside], ids[inside], counts[counts > 1]
        first = np.cumsum(counts) - counts
        cuts = np.flatnonzero((np.arange(len(keys)) - np.repeat(first, counts)) % IDS_AT_ONCE == 0)
        of = np.searchsorted(first, cuts, "right") - 1
        named = (np.int64(number) << np.int64(32)) | keys[cuts].astype(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.append(cuts, len(keys)).astype(np.int32)), pa.array(ids))
        columns = [pa.array(named), pa.array(ids[first][of]), pa.array(counts[of] > 2), lists]
        return pa.RecordBatch.from_arrays(columns, ["key", "rep", "several", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = -1, []
        for batch in batches:
            for x, least, block in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if x != number and held:
                    yield shared(number, held)
                    held = []
                number = x
                held.append(unpacked(least, block))
        if held:
            yield shared(number, held)

    dealt = blocks(rows, keyed).repartition("slice").sortWithinPartitions("slice")
    return dealt.mapInArrow(run, "key long, rep long, several boolean, ids array<long>")
