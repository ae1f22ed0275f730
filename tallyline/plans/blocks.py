"""Packed rows in a shared folder, for tasks that read them out of order.

A block is one file: the lengths of its rows, then their numbers.  A group of
rows of other types is one file too, an Arrow stream.  Tasks write files under
names of their own, so a repeated or lost task does no harm; only the names
that Spark returns are used.  A mounted folder's files are mapped into memory,
those of another store are read through its own reader.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import shuffles_dropped


def _mounted(folder: str) -> str | None:
    parsed = urlparse(folder)
    return unquote(parsed.path) if parsed.scheme in ("", "file") else None


def write_file(folder: str, data: bytes, name: str = "") -> str:
    """The name of the file, one of its own unless it is given."""
    name = name or uuid.uuid4().hex
    mounted = _mounted(folder)
    if mounted is not None:
        os.makedirs(mounted, exist_ok=True)
        with open(f"{mounted}/{name}", "wb") as out:
            out.write(data)
    else:
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        with store.open_output_stream(f"{path}/{name}") as out:
            out.write(data)
    return name


def read_file(folder: str, name: str) -> np.ndarray:
    mounted = _mounted(folder)
    if mounted is not None:
        return np.memmap(f"{mounted}/{name}", mode="r", dtype=np.uint8)
    store, path = fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{path}/{name}") as source:
        return np.frombuffer(source.read(), np.uint8)


def write_parts(folder: str, parts: Sequence[bytes]) -> str:
    """One file of several parts, ahead of which are the places where they begin and the last one ends."""
    places = np.cumsum([8 * (len(parts) + 1), *map(len, parts)]).astype("<i8")
    return write_file(folder, b"".join([places.tobytes(), *parts]))


def read_parts(folder: str, name: str, numbers: Sequence[int]) -> list[bytes]:
    """Some parts of a file; the others are not read."""
    mounted = _mounted(folder)
    if mounted is not None:
        with open(f"{mounted}/{name}", "rb", buffering=0) as source:
            return _some_parts(lambda n, at: os.pread(source.fileno(), n, at), numbers)
    store, path = fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{path}/{name}") as source:
        return _some_parts(source.read_at, numbers)


def _some_parts(read: Callable, numbers: Sequence[int]) -> list[bytes]:
    def whole(n: int, at: int) -> bytes:
        data = read(n, at)
        while len(data) < n:  # a call may return less
            more = read(n - len(data), at + len(data))
            if not more:
                raise EOFError("a file of parts ends early")
            data += more
        return data

    places = [np.frombuffer(whole(16, 8 * i), "<i8").tolist() for i in numbers]
    return [whole(end - first, first) for first, end in places]


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one block come together and in order."""
        block, rows, done = None, [], []

        def end_block() -> None:
            if rows:
                lengths = np.array([len(r) for r in rows], "<i4")
                data = np.concatenate(rows).astype("<i4")
                done.append((block, write_file(folder, np.array([len(rows)], "<i4").tobytes() + lengths.tobytes() + data.tobytes())))
                rows.clear()

        for batch in batches:
            for b, numbers in zip(batch.column(0).to_pylist(), batch.column(1)):
                if b != block:
                    end_block()
                    block = b
                rows.append(numbers.values.to_numpy() if numbers.is_valid else np.zeros(0, np.int64))
        end_block()
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate((pa.int64(), pa.string()))], names=["block", "file"])

    return write


def write_blocks(rows: DataFrame, position: str, numbers: str, folder: str, size: int) -> list[str]:
    """Stores arrays of numbers, ``size`` to a block; the files by the number of their block.

    Positions run from 0 on without gaps.  The driver sees a name per block.
    """
    blocks = rows.select(F.expr(f"{position} div {size}").alias("block"), position, F.col(numbers).cast("array<long>").alias("numbers"))
    in_order = blocks.repartition("block").sortWithinPartitions("block", position).select("block", "numbers")
    written = {r["block"]: r["file"] for r in in_order.mapInArrow(_writer(folder), "block long, file string").collect()}
    return [written[b] for b in range(len(written))]


class Blocks:
    """The rows of the blocks in a folder, opened when they are first read."""

    def __init__(self, folder: str, files: list[str]):
        self.folder, self.files = folder, files
        self._open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def row(self, block: int, place: int) -> np.ndarray:
        if block not in self._open:
            data = read_file(self.folder, self.files[block]).view("<i4")
            n = int(data[0])
            self._open[block] = np.concatenate([[0], np.cumsum(data[1 : n + 1])]), data[n + 1 :]
        ends, numbers = self._open[block]
        return numbers[ends[place] : ends[place + 1]]


def _group_writer(folder: str, by: Sequence[str], make: Callable | None):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one group come together."""
        group, held, done = (), [], []

        def end_group() -> None:
            if held:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    for rows in held:
                        out.write_batch(rows)
                done.append((*group, write_file(folder, memoryview(sink.getvalue()))))
                held.clear()

        for batch in make(batches) if make else batches:
            if not batch.num_rows:
                continue
            keys, rows = np.stack([batch.column(c).to_numpy() for c in by]), batch.drop_columns(by)
            for low, high in pairwise([0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]):
                if group != (here := tuple(keys[:, low].tolist())):
                    end_group()
                    group = here
                held.append(rows.slice(low, high - low))
        end_group()
        types = [pa.int64()] * len(by) + [pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(types)], names=[*by, "file"])

    return write


def write_groups(
    rows: DataFrame, by: Sequence[str], folder: str, make: Callable | None = None, order: Sequence[str] = ()
) -> dict[tuple[int, ...], str]:
    """Stores each group of rows, which one task holds at a time; the files by the whole numbers that tell the groups apart.

    ``make`` may change the rows, as in mapInArrow, once they are dealt.  The
    driver sees a name per group.
    """
    by = list(by)
    dealt = rows.repartition(*by).sortWithinPartitions(*by, *order)
    with shuffles_dropped(rows.sparkSession):
        written = dealt.mapInArrow(_group_writer(folder, by, make), ", ".join([*(f"{c} long" for c in by), "file string"])).collect()
    return {tuple(r[:-1]): r["file"] for r in written}


def read_group(folder: str, file: str) -> pa.RecordBatch:
    """The rows of a group, without what told it apart."""
    return pa.ipc.open_stream(pa.py_buffer(read_file(folder, file))).read_all().combine_chunks().to_batches()[0]
