"""Rows that carry many hashed entries, for shuffles that Spark deals by part.

An entry is a hash with some numbers.  A task sorts what it has by part and
sends one row per part with the entries as byte strings: far fewer rows than
entries.  Entries of one hash meet in one part; a task merges equal hashes
before it sends them, so a frequent hash has one entry per task and not one
per occurrence.  There is a part for every shuffle partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def part_count(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def deal(packed: DataFrame, parts: int) -> DataFrame:
    """Every part in a partition of its own; parts are ranges of hashes and so even."""
    return packed.repartitionById(parts, F.col("part").cast("int"))


def parts_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Equal ranges of the hashes' upper 32 bits."""
    return (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def split_rows(part: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, list[bytes]]]:
    """(part, bytes of each column) in the order of the parts; entries keep their order."""
    order = np.argsort(part, kind="stable")
    sorted_part = part[order]
    cuts = np.flatnonzero(np.diff(sorted_part)) + 1
    bounds = np.concatenate([[0], cuts, [len(part)]])
    moved = [c[order] for c in columns]
    for low, high in zip(bounds[:-1], bounds[1:]):
        if high > low:
            yield int(sorted_part[low]), [c[low:high].tobytes() for c in moved]


def gather(batches: list[pa.Array], dtype) -> np.ndarray:
    """The entries of binary cells, one after the other."""
    if not batches:
        return np.zeros(0, dtype)
    return np.concatenate([np.frombuffer(cell.as_buffer(), dtype=dtype) for column in batches for cell in column if cell.is_valid] or [np.zeros(0, dtype)])


def group_starts(sorted_values: np.ndarray) -> np.ndarray:
    """First index of each run of equal values."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1])


def ascending(keys: np.ndarray) -> np.ndarray:
    """The stable order of whole numbers from 0 on: their upper bits are sorted with their places below them."""
    keys = keys.astype(np.uint64, copy=False)
    bits = np.uint64(max(len(keys) - 1, 0).bit_length())
    exact = not len(keys) or int(keys.max()) < 1 << (64 - int(bits))
    packed = (keys if exact else keys >> bits) << bits
    packed |= np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    packed &= (np.uint64(1) << bits) - np.uint64(1)
    order = packed.view(np.int64)
    if not exact:
        moved = keys[order]
        if (moved[1:] < moved[:-1]).any():
            order = order[np.argsort(moved, kind="stable")]
    return order


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, ascending, and the place among them of each value."""
    order = ascending(values)
    moved = values[order]
    heads = group_starts(moved)
    first = np.zeros(len(values), np.int64)
    first[heads[1:]] = 1
    place = np.empty(len(values), np.int64)
    place[order] = np.cumsum(first)
    return moved[heads], place
