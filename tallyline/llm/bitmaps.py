"""Bitmaps of hashes, of fixed size whatever the number of hashes.

Tasks use them to leave out what cannot match before anything is shuffled; a
join decides afterwards.  A bitmap that fills up leaves out less, and changes
no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BITS = 1 << 25
_ROWS = 1 << 10  # a bitmap travels in so many rows
SCHEMA = "row long, bits binary"


def _bits(hashes: np.ndarray) -> np.ndarray:
    return ((hashes.astype(np.uint64) >> np.uint64(20)) % np.uint64(BITS)).astype(np.int64)


def _batch(rows, cells) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(cells, pa.binary())], names=["row", "bits"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packed = np.zeros(BITS // 8, np.uint8)
    for batch in batches:
        bits = _bits(batch.column(0).to_numpy())
        np.bitwise_or.at(packed, bits >> 3, (128 >> (bits & 7)).astype(np.uint8))
    rows = packed.reshape(_ROWS, -1)
    some = np.flatnonzero(rows.any(axis=1))
    yield _batch(some, [rows[i].tobytes() for i in some])


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for row, cell in zip(batch.column("row").to_pylist(), batch.column("bits")):
            bits = np.frombuffer(cell.as_buffer(), np.uint8)
            held[row] = held[row] | bits if row in held else bits
    yield _batch(list(held), [b.tobytes() for b in held.values()])


def bitmap_of(hashes: DataFrame) -> np.ndarray:
    """The bitmap of a table's only column, 64-bit hashes; BITS / 8 bytes reach the driver."""
    united = hashes.mapInArrow(_pack, SCHEMA).repartition("row").mapInArrow(_unite, SCHEMA)
    whole = np.zeros((_ROWS, BITS // 8 // _ROWS), np.uint8)
    for row, bits in united.collect():
        whole[row] = np.frombuffer(bits, np.uint8)
    return whole.ravel()


def maybe_in(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = _bits(hashes)
    return (bitmap[bits >> 3] >> (7 - (bits & 7)).astype(np.uint8)) & 1 == 1
